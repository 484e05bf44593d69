"""Best-fit packing by linear grouping.

Only how many pieces have which length decides the packing, and there are at most ``capacity``
lengths, so it is planned on that histogram. Large lengths are split into groups of equal cardinality
and rounded up to the largest of their group, which leaves few sizes. Configurations, that is
multisets of sizes that fit a sequence, are chosen one after another for the best fill that the
remaining demand allows. Real pieces then take the places of their group, and small pieces go where
they leave the least room. The plan is a table of runs: so many pieces of one length, from one rank
on, lie at one offset of consecutive sequences. Pieces are ranked within their length and joined with
it. A run ends where a length or a stretch of alike sequences ends, so the size of the plan follows
the capacity, not the number of pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envstream.llm.common import lean, written
from envstream.llm.pieces import PieceEncoder, slices
from envstream.llm.units import ragged


RUN = ("run_length", "first_rank", "n", "first_sequence", "offset")


@dataclass(frozen=True)
class Rules:
    capacity: int = 2048
    separator: int = 0
    #: Lengths above this share of the capacity are grouped; the rest is fitted into the gaps.
    large: float = 1 / 8
    groups: int = 256


class Plan:
    """Runs (length, first rank, pieces, first sequence, offset) for a histogram of lengths."""

    def __init__(self, counts: dict[int, int], rules: Rules = Rules()):
        self.rules, self.capacity = rules, rules.capacity
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        #: Stretches of sequences with so much room, by the room.
        self.rooms: list[list[tuple[int, int]]] = [[] for _ in range(self.capacity + 1)]
        edge = int(self.capacity * rules.large)
        lengths = sorted((n for n, many in counts.items() if many), reverse=True)
        self._large([(n, counts[n]) for n in lengths if n > edge])
        for n in lengths:
            if n <= edge:
                self._best_fit(n, counts[n])

    def _large(self, lengths: list[tuple[int, int]]) -> None:
        total = sum(many for _, many in lengths)
        share = -(-total // self.rules.groups) if total else 1
        queues: list[list[list[int]]] = []  # per group: [length, next rank, left]
        filled = share
        for n, many in lengths:
            rank = 0
            while many:
                if filled == share:
                    queues.append([])
                    filled = 0
                taken = min(many, share - filled)
                queues[-1].append([n, rank, taken])
                rank, many, filled = rank + taken, many - taken, filled + taken
        sizes = [queue[0][0] for queue in queues]
        demand = [sum(left for _, _, left in queue) for queue in queues]
        while any(demand):
            chosen = self._configuration(sizes, demand)
            times = min(demand[i] // k for i, k in chosen.items())
            self._use(chosen, times, queues)
            for i, k in chosen.items():
                demand[i] -= k * times

    def _configuration(self, sizes: list[int], demand: list[int]) -> dict[int, int]:
        """Best fill that holds the largest size left, each group at most as often as it has pieces."""
        first = next(i for i, d in enumerate(demand) if d)
        room = self.capacity - sizes[first]
        #: For each fill that can be reached, the group added last and the fill before.
        reached: dict[int, tuple[int, int]] = {0: (-1, -1)}
        for i in range(first, len(sizes)):
            spare = demand[i] - (i == first)
            base = list(reached)
            for _ in range(min(spare, room // sizes[i])):
                step = [f for f in base if f + sizes[i] <= room and f + sizes[i] not in reached]
                for f in step:
                    reached[f + sizes[i]] = (i, f)
                base = [f + sizes[i] for f in step]
                if not base:
                    break
        chosen, fill = {first: 1}, max(reached)
        while fill:
            group, fill = reached[fill]
            chosen[group] = chosen.get(group, 0) + 1
        return chosen

    def _use(self, chosen: dict[int, int], times: int, queues: list[list[list[int]]]) -> None:
        stretches = [(self.sequences, times, 0)]
        self.sequences += times
        for group, repeats in sorted(chosen.items()):
            for _ in range(repeats):
                after = []
                for start, n, used in stretches:
                    while n:
                        run = queues[group][0]
                        taken = min(n, run[2])
                        self.runs.append((run[0], run[1], taken, start, used))
                        after.append((start, taken, used + run[0]))
                        run[1], run[2] = run[1] + taken, run[2] - taken
                        if not run[2]:
                            queues[group].pop(0)
                        start, n = start + taken, n - taken
                stretches = after
        for start, n, used in stretches:
            self.rooms[self.capacity - used].append((start, n))

    def _best_fit(self, length: int, many: int) -> None:
        rank, room = 0, length
        while many:
            while room <= self.capacity and not self.rooms[room]:
                room += 1
            if room > self.capacity:
                opened = -(-many // (self.capacity // length))
                self.rooms[self.capacity].append((self.sequences, opened))
                self.sequences += opened
                room = self.capacity
            start, n = self.rooms[room].pop()
            taken = min(many, n)
            self.runs.append((length, rank, taken, start, self.capacity - room))
            if taken < n:
                self.rooms[room].append((start + taken, n - taken))
            self.rooms[room - length].append((start, taken))
            rank, many = rank + taken, many - taken
            room = max(length, min(room, room - length))


def _cut(ids: np.ndarray, edges: np.ndarray, rules: Rules) -> tuple[np.ndarray, ...]:
    """Document, piece, start and length of every piece; documents end with the separator."""
    size = np.diff(edges) + 1
    pieces = -(-size // rules.capacity)
    first = size - (pieces - 1) * rules.capacity
    document = np.repeat(np.arange(len(size)), pieces)
    piece = ragged(np.zeros(len(size), np.int64), pieces)
    start = np.where(piece == 0, 0, first[document] + (piece - 1) * rules.capacity)
    return document, piece, start, np.where(piece == 0, first[document], rules.capacity)


def pieces(docs: DataFrame, vocabulary: str, rules: Rules = Rules()) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and its task and place there.

    ``place`` counts the pieces of one length within one task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(shared.value)
        seen = np.zeros(rules.capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for part, texts in slices(batches, 1):
            ids, edges = encoder.encode(texts)
            document, piece, start, length = _cut(ids, edges, rules)
            # The separator is put behind every document.
            flat = np.insert(ids, edges[1:], rules.separator).astype("<u4")
            at = edges[document] + document + start
            crc = [zlib.crc32(flat[a:a + n]) for a, n in zip(at, length)]
            order = np.argsort(length, kind="stable")
            many = np.bincount(length, minlength=rules.capacity + 1)
            place = np.empty(len(length), np.int64)
            place[order] = ragged(seen[np.flatnonzero(many)], many[many > 0])
            seen += many
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(pa.array(document)), pa.array(piece.astype(np.int32)),
                pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                pa.array(np.full(len(length), task, np.int32)), pa.array(place)], names=names)

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"]
    return rows.mapInArrow(lean(run), f"doc_id {kind}, piece int, start long, length long, "
                                      "ids_crc32 long, task int, place long")


def pack(docs: DataFrame, vocabulary_file: str, rules: Rules = Rules()) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is a piece that holds the separator alone. Only documents longer than the
    capacity are cut; their first piece takes what the full ones leave. Repeated rows and null ids
    are packed one by one; columns other than doc_id and text are not looked at. An empty table gives
    an empty result. ``vocabulary_file`` is read on the driver.
    """
    with open(vocabulary_file, encoding="utf-8") as source:
        found = written(pieces(docs, source.read(), rules), "pieces")
    by_task = found.groupBy("task", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task")
    before = by_task.select("task", "length", (F.sum("n").over(earlier) - F.col("n")).alias("before"))
    counts = found.groupBy("length").agg(F.count("*").alias("n"))  # a row per length: bounded
    plan = Plan({row.length: row.n for row in counts.collect()}, rules)
    columns = np.array(plan.runs, np.int64).reshape(-1, len(RUN)).T
    runs = docs.sparkSession.createDataFrame(pa.table(dict(zip(RUN, columns))))
    ranked = found.join(before, ["task", "length"]).withColumn("rank", F.col("before") + F.col("place"))
    inside = (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("first_rank")) & (
        F.col("rank") < F.col("first_rank") + F.col("n"))
    return ranked.join(F.broadcast(runs), inside).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset")
