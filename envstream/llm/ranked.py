"""Ranked lexical search: term at a time over short lists, document at a time over long ones.

Documents are indexed in blocks, one after another as the scan gives them, so no list is ever gathered
in one place; only terms that some query asks for are held. A block is searched for one query like
this. The short lists are added up term by term into accumulators, which then are one more list: its
documents in order, with sums and a bound. Together with the long lists it is walked in document
order. Every list has a bound for each window of documents; a window whose bounds together don't reach
the score to beat is skipped. Within a window, lists whose bounds together don't reach that score
cannot bring in a document. They are only probed, from the largest bound down, for documents that can
still make it. The score to beat is that of the k-th best document so far, over all blocks of a task,
or the k-th best accumulator, whichever is higher.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envstream.llm.common import written
from envstream.llm.pieces import slices
from envstream.llm.units import offsets_of

#: Documents of a block, and of a window within it. Neither changes a result.
BLOCK_ROWS, WINDOW = 16_384, 512
#: Lists of at most this share of a block's documents are short.
SHORT = 1 / 64
#: Bytes of query text searched for in one go: what a task holds of the queries.
PART_BYTES = 16 << 20
#: Groups of tasks whose findings meet first.
SALTS = 64

# Letters and digits of ASCII, A to Z in lower case, and all else beyond ASCII make terms.
_FOLDED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, and how many each text has."""
    texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or offsets[0] == offsets[-1]:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    data = texts.buffers()[2].slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes().translate(_FOLDED)
    folded = pa.StringArray.from_buffers(
        len(texts), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(data))
    parts = pc.ascii_split_whitespace(folded)
    flat = parts.flatten()
    full = pc.not_equal(pc.binary_length(flat), 0)
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    return flat.filter(full), np.bincount(
        owner[full.to_numpy(zero_copy_only=False)], minlength=len(texts))


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array([values], pa.list_(kind))


def index(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """Blocks of documents with their lists for the terms of the vocabulary.

    ``documents`` and ``occurrences`` count all documents with a term and all their terms. ``doc_id`` and
    ``n`` describe those documents that occur in a list, ``term`` and ``held`` the lists in order,
    ``posting`` and ``tf`` their members, by place in the block.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows = 0

        def made() -> pa.RecordBatch:
            doc_id = pa.concat_arrays([x[0] for x in held])
            n = np.concatenate([x[1] for x in held])
            moved = offsets_of(np.array([len(x[1]) for x in held]))
            row = np.concatenate([x[2] + by for x, by in zip(held, moved)])
            term, tf = (np.concatenate([x[i] for x in held]) for i in (3, 4))
            used = np.unique(row)
            order = np.lexsort((row, term))
            names, lengths = np.unique(term, return_counts=True)
            return pa.RecordBatch.from_arrays([
                pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(used)], pa.int32()), doc_id.take(pa.array(used))),
                _lists(n[used], pa.int64()), _lists(names, pa.int32()), _lists(lengths, pa.int32()),
                _lists(np.searchsorted(used, row[order]), pa.int32()), _lists(tf[order], pa.int64())],
                names=["documents", "occurrences", "doc_id", "n", "term", "held", "posting", "tf"])

        for part, texts in slices(batches, 1):
            found, n = terms(texts)
            size = max(1, len(shared.value))
            at = pc.index_in(found, value_set=shared.value)
            known = at.is_valid().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(n)), n)[known]
            key, tf = np.unique(
                row * size + at.drop_null().to_numpy(zero_copy_only=False), return_counts=True)
            held.append((part.column(0), n, key // size, key % size, tf))
            rows += len(n)
            if rows >= BLOCK_ROWS:
                yield made()
                held, rows = [], 0
        if held:
            yield made()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        run, "documents long, occurrences long, doc_id array<long>, n array<long>, term array<int>, "
             "held array<int>, posting array<int>, tf array<long>")


@dataclass
class Found:
    """Best documents of one query so far."""

    score: np.ndarray
    doc_id: np.ndarray
    #: Whether the row has no doc_id; such rows come last among equal scores.
    unnamed: np.ndarray

    @classmethod
    def nothing(cls) -> Found:
        return cls(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))

    def with_more(self, score: np.ndarray, doc_id: np.ndarray, unnamed: np.ndarray, k: int) -> Found:
        parts = zip((self.score, self.doc_id, self.unnamed), (score, doc_id, unnamed))
        score, doc_id, unnamed = (np.concatenate(x) for x in parts)
        best = np.lexsort((doc_id, unnamed, -score))[:k]
        return Found(score[best], doc_id[best], unnamed[best])

    def to_beat(self, k: int) -> int:
        """A score below it, or of 0, can't be among the k best."""
        return max(1, int(self.score[-1])) if len(self.score) >= k else 1


class Block:
    """The lists of a block, with the contribution of every posting and bounds per window."""

    def __init__(self, rows: int, term: np.ndarray, held: np.ndarray, posting: np.ndarray,
                 contribution: np.ndarray):
        self.rows, self.posting, self.contribution = rows, posting, contribution
        self.edges = offsets_of(held)
        self.place = {t: i for i, t in enumerate(term.tolist())}
        self.starts = np.arange(0, max(rows, 1) + WINDOW, WINDOW)
        self.short = held <= max(1, rows * SHORT)
        self._windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def members(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        some = slice(self.edges[i], self.edges[i + 1])
        return self.posting[some], self.contribution[some]

    def bounded(self, rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each window starts in a list, and its largest value there."""
        cuts = np.searchsorted(rows, self.starts)
        bounds = np.zeros(len(cuts) - 1, np.int64)
        full = np.flatnonzero(np.diff(cuts))
        if len(full):
            bounds[full] = np.maximum.reduceat(values, cuts[full])
        return cuts, bounds

    def windows(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self._windows:
            self._windows[i] = self.bounded(*self.members(i))
        return self._windows[i]

    def accumulated(self, lists: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Sums over short lists: the documents in order, and what they have together."""
        parts = [self.members(i) for i in lists]
        rows = np.concatenate([p[0] for p in parts])
        order = np.argsort(rows, kind="stable")
        rows, values = rows[order], np.concatenate([p[1] for p in parts])[order]
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        return rows[first], np.add.reduceat(values, first)


def search_block(block: Block, query: list[int], found: Found, doc_id: np.ndarray, unnamed: np.ndarray,
                 k: int) -> Found:
    """The k best of what was found and of the block."""
    present = [block.place[t] for t in query if t in block.place]
    short = [i for i in present if block.short[i]]
    lists = [(*block.members(i), *block.windows(i)) for i in present if not block.short[i]]
    beat = found.to_beat(k)
    if short:
        rows, sums = block.accumulated(short)
        lists.append((rows, sums, *block.bounded(rows, sums)))
        if len(sums) >= k:
            beat = max(beat, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
    if not lists:
        return found
    bounds = np.stack([x[3] for x in lists])
    total = bounds.sum(axis=0)
    for window in np.flatnonzero(total >= beat).tolist():
        if total[window] < beat:
            continue
        base = int(block.starts[window])
        order = np.argsort(bounds[:, window], kind="stable")
        reach = np.cumsum(bounds[order, window])
        probed = int(np.searchsorted(reach, beat))  # lists that together stay below the score to beat
        scores = np.zeros(WINDOW, np.int64)
        for at in order[probed:].tolist():
            rows, values, cuts, _ = lists[at]
            some = slice(cuts[window], cuts[window + 1])
            scores[rows[some] - base] += values[some]
        left = np.flatnonzero(scores)
        for step in range(probed - 1, -1, -1):
            left = left[scores[left] + reach[step] >= beat]
            if not len(left):
                break
            rows, values, cuts, _ = lists[order[step]]
            rows, values = (x[cuts[window]:cuts[window + 1]] for x in (rows, values))
            if len(rows):
                near = np.minimum(np.searchsorted(rows, left + base), len(rows) - 1)
                hit = rows[near] == left + base
                scores[left[hit]] += values[near[hit]]
        left = left[scores[left] >= beat]
        if len(left):
            found = found.with_more(scores[left], doc_id[left + base], unnamed[left + base], k)
            beat = max(beat, found.to_beat(k))
    return found


def _searched(blocks: DataFrame, queries: list[list[int]], weights: np.ndarray, documents: int,
              occurrences: int, k: int) -> DataFrame:
    """query, task, doc_id, score: the k best documents per query and task."""
    shared = blocks.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        found = [Found.nothing() for _ in queries]
        for batch in batches:
            for at in range(batch.num_rows):
                ids, *columns = (batch.column(i)[at].values for i in range(6))
                n, term, held, posting, tf = (
                    x.to_numpy(zero_copy_only=False).astype(np.int64) for x in columns)
                if not len(posting):
                    continue
                m = 100 - 50 + (50 * n * documents) // occurrences
                contribution = np.repeat(weights[term], held) * (
                    (1_000_000_000 * tf) // (1000 * tf + 20 * m[posting]))
                block = Block(len(n), term, held, posting, contribution)
                unnamed = ids.is_null().to_numpy(zero_copy_only=False)
                doc_id = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
                found = [search_block(block, query, one, doc_id, unnamed, k)
                         for query, one in zip(queries, found)]
        task = TaskContext.get().partitionId()
        for query, one in enumerate(found):
            if len(one.score):
                size = len(one.score)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(size, query, np.int32)), pa.array(np.full(size, task, np.int32)),
                    pa.array(one.doc_id, mask=one.unnamed), pa.array(one.score)],
                    names=["query", "task", "doc_id", "score"])

    return blocks.select("doc_id", "n", "term", "held", "posting", "tf").mapInArrow(
        run, "query int, task int, doc_id long, score long")


def _ranked(found: DataFrame, k: int, *keys: str | Column) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").isNull(), "doc_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _part(docs: DataFrame, texts: list[str], k: int) -> DataFrame:
    """query (place in ``texts``), rank, doc_id, score."""
    found, counts = terms(pa.array(texts, pa.string()))
    named = found.dictionary_encode()
    places = np.split(named.indices.to_numpy(zero_copy_only=False), np.cumsum(counts)[:-1])
    queries = [np.unique(x).tolist() for x in places]
    blocks = written(index(docs, named.dictionary), "search-blocks", parquet_block_size=str(16 << 20))
    totals = blocks.agg(F.sum("documents").alias("documents"), F.sum("occurrences").alias("occurrences")).first()
    documents, occurrences = totals.documents or 0, totals.occurrences or 0
    held = blocks.select(F.explode(F.arrays_zip("term", "held")).alias("x")).groupBy("x.term").agg(
        F.sum("x.held").alias("df"))
    weights = np.zeros(max(1, len(named.dictionary)), np.int64)
    for row in held.collect():  # at most the terms of the queries
        weights[row.term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * row.df + 1)))
    best = _searched(blocks, queries, weights, documents, occurrences, k)
    fewer = _ranked(best, k, "query", F.pmod("task", F.lit(SALTS))).drop("rank")
    return _ranked(fewer, k, "query").select("query", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents with a score above 0 for every item.

    Equal scores rank by ascending doc_id, rows without one last. Every row of ``docs`` is a document of
    its own, repeated ones too, and every row of ``items`` is answered; items with equal texts are
    searched for once. Null and empty texts, and those without a term, have no results. Columns other
    than doc_id, text and item_id are not looked at; empty tables give an empty result.
    """
    spark = docs.sparkSession
    asked = written(items.select("item_id", F.col("text").cast("string").alias("text")).where(
        F.col("text").isNotNull()).withColumn("text_key", F.sha1("text")), "search-items")
    texts = asked.select("text_key", "text").dropDuplicates(["text_key"])
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0]
    answers = spark.createDataFrame([], "text_key string, rank int, doc_id long, score long")
    parts = 1 + size // PART_BYTES if size else 0
    part = F.pmod(F.xxhash64("text_key"), F.lit(parts)) if parts else F.lit(0)
    for number in range(parts):
        rows = texts.where(part == number).orderBy("text_key").collect()  # PART_BYTES or so
        if rows:
            keys = spark.createDataFrame([(i, row.text_key) for i, row in enumerate(rows)],
                                         "query int, text_key string")
            found = _part(docs, [row.text for row in rows], k).join(keys, "query")
            answers = answers.union(found.select("text_key", "rank", "doc_id", "score"))
    return asked.join(answers, "text_key").select("item_id", "rank", "doc_id", "score")
