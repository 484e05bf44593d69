"""Nearest neighbours by an inverted file and an adaptive scan over dimensions.

Vectors are rotated at random, so the first d of D squared coordinate differences estimate the whole
distance. Within each probed list they are read in blocks of columns. After every block a hypothesis
test compares the partial distance with the distance that the k-th best inner product so far stands
for, |q|^2 + |c|^2 - 2 s, and abandons the candidates that are too far with high probability. What
survives is scored exactly, on the original vectors in double precision, and raises the value to beat for
the next list. A list whose centre and radius bound all its inner products below it is not read at all.

The test is linear in the partial inner product: one side is that, the other a number of the query plus
one of the candidate. So a block of columns costs one matrix product, in single precision with a margin
for its rounding, while many pairs are left, and is read pair by pair once few are.

The lists come from k-means over a bounded sample on the driver; every row is then put into its list.
Lists are dealt to blocks of about ``BLOCK_ROWS`` candidates, and a long list is split over several.
A first pass over the nearest lists of every query finds the inner product to beat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envstream.llm.common import written

BLOCK_ROWS, QUERY_ROWS = 8_192, 4_096
#: Share of pairs left below which columns are read pair by pair; doesn't change a result.
FEW = 0.1


@dataclass(frozen=True)
class Search:
    k: int = 20
    #: Rows that the lists are fitted on, and the most lists made; the square root of the rows else.
    sample: int = 20_000
    max_lists: int = 1024
    #: Share of the lists that each query probes. Embeddings without clusters need most of them.
    probe: float = 0.75
    #: Width of the test: larger abandons later and misses less.
    epsilon: float = 2.1
    columns: int = 16
    seed: int = 42


def usable(rows: DataFrame, id_name: str, vector_name: str) -> DataFrame:
    """vec_id and v (doubles) of the rows that take part.

    Left out are vectors that are null or zero, hold a null or a number that isn't finite, or have
    another length than most vectors.
    """
    v = F.col(vector_name).cast("array<double>")
    kept = rows.select(F.col(id_name).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (
            F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    kept = written(kept, "vectors")
    sizes = kept.groupBy(F.size("v").alias("d")).count()
    usual = sizes.orderBy(F.desc("count"), "d").first()
    return kept.where(F.size("v") == (usual.d if usual else 0))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres ** 2).sum(axis=1) / 2
    return np.concatenate([np.argmin(half - points[i:i + 4096] @ centres.T, axis=1)
                           for i in range(0, len(points), 4096)] or [np.zeros(0, np.int64)])


def _centres(sample: np.ndarray, lists: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)].copy()
    for _ in range(10):
        at = _nearest(sample, centres)
        n = np.bincount(at, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, at, sample)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _rotation(size: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


@dataclass
class Layout:
    """Where lists lie: list i fills ``parts[i]`` blocks from ``first[i]`` on."""

    counts: np.ndarray
    first: np.ndarray
    parts: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Layout:
        first, parts, block, room = [], [], 0, BLOCK_ROWS
        for n in counts.tolist():
            if n > room and room < BLOCK_ROWS:
                block, room = block + 1, BLOCK_ROWS
            first.append(block)
            parts.append(max(1, -(-n // BLOCK_ROWS)))
            if parts[-1] > 1:
                block, room = block + parts[-1], BLOCK_ROWS
            else:
                room -= n
        return cls(counts, np.array(first), np.array(parts))


def _in_lists(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = _nearest(_matrix(batch.column(1)), shared.value).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(at)], names=["vec_id", "v", "list"])

    return rows.mapInArrow(run, "vec_id long, v array<double>, list int")


def _routed(queries: DataFrame, centres: np.ndarray, layout: Layout, search: Search,
            first_pass: bool) -> DataFrame:
    """A row per query and block: block, query_id, v, lists (those to probe there), beat."""
    shared = queries.sparkSession.sparkContext.broadcast((centres, vars(layout)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, layout = shared.value[0], Layout(**shared.value[1])
        probes = 1 if first_pass else max(1, round(search.probe * len(centres)))
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(-(_matrix(batch.column(1)) @ centres.T), axis=1, kind="stable")
            # As many lists as are asked for, and more while they hold too few candidates.
            held = np.cumsum(layout.counts[order], axis=1)
            enough = (held < search.k + 1).sum(axis=1) + 1
            asked = np.minimum(np.maximum(probes, enough), len(centres))
            row, block, lists = [], [], []
            for i, n in enumerate(asked.tolist()):
                by_block: dict[int, list[int]] = {}
                for one in order[i, :n].tolist():
                    for part in range(layout.parts[one]):
                        by_block.setdefault(int(layout.first[one]) + part, []).append(one)
                row += [i] * len(by_block)
                block += by_block
                lists += by_block.values()
            some = pa.array(row)
            yield pa.RecordBatch.from_arrays([
                pa.array(block, pa.int32()), batch.column(0).take(some), batch.column(1).take(some),
                pa.array(lists, pa.list_(pa.int32())), batch.column(2).take(some)],
                names=["block", "query_id", "v", "lists", "beat"])

    return queries.mapInArrow(
        run, "block int, query_id long, v array<double>, lists array<int>, beat double")


class Side:
    """Vectors of one side, with their rotated columns and sums of squares up to the end of each block.

    Columns and squares are those of the vectors times ``scale``, which makes single precision enough.
    """

    def __init__(self, vectors: np.ndarray, rotation: np.ndarray, search: Search, scale: float = 1.0):
        self.exact, size = vectors, vectors.shape[1]
        turned = (vectors * scale) @ rotation
        self.ends = [*range(search.columns, size, search.columns), size]
        squares = np.cumsum(turned ** 2, axis=1)
        self.squares = np.stack([squares[:, end - 1] for end in self.ends], axis=1)
        self.turned = turned.astype(np.float32)

    def part(self, some: np.ndarray | slice) -> Side:
        made = object.__new__(Side)
        made.exact, made.squares, made.turned = self.exact[some], self.squares[some], self.turned[some]
        made.ends = self.ends
        return made


def adaptive_scan(queries: Side, candidates: Side, beat: np.ndarray,
                  search: Search) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, inner product) of the pairs that the tests leave. ``beat`` is scaled as well."""
    size = queries.ends[-1]
    far = 1e30  # for queries without a value to beat yet
    all_q, all_c = queries.squares[:, -1], candidates.squares[:, -1]
    margin = 1e-5 * (1 + all_q + all_c.max(initial=0))
    at = products = None
    start = 0
    for block, end in enumerate(queries.ends):
        wide = 1.0 if end == size else (1 + search.epsilon / np.sqrt(end)) ** 2 * end / size
        # |q - c|^2 up to here against its limit times wide, solved for the product up to here.
        least = (queries.squares[:, block] - (all_q - 2 * np.maximum(beat, -far)) * wide) / 2 - margin
        other = (candidates.squares[:, block] - all_c * wide) / 2
        q, c = queries.turned[:, start:end], candidates.turned[:, start:end]
        if at is None or len(at[0]) > FEW * len(beat) * len(all_c):
            dense = q @ c.T if products is None else products + q @ c.T
            enough = dense - other.astype(np.float32) >= least.astype(np.float32)[:, None]
            if at is not None:
                kept = np.zeros(enough.shape, bool)
                kept[at] = True
                enough &= kept
            at, products = np.nonzero(enough), dense
            found = dense[at]
        else:
            found = found + np.einsum("ij,ij->i", q[at[0]], c[at[1]])
            kept = found - other[at[1]] >= least[at[0]]
            at, found = (at[0][kept], at[1][kept]), found[kept]
            products = None
        if len(at[0]) <= FEW * len(beat) * len(all_c):
            products = None
        start = end
    return at[0], at[1], np.einsum("ij,ij->i", queries.exact[at[0]], candidates.exact[at[1]])


def _raised(best: np.ndarray, q: np.ndarray, score: np.ndarray) -> None:
    """Puts new scores among the best ones of each query, which stay sorted, best first."""
    order = np.lexsort((-score, q))
    q, score = q[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    k = best.shape[1]
    some = place < k
    rows, inverse = np.unique(q[some], return_inverse=True)
    both = np.full((len(rows), 2 * k), -np.inf)
    both[:, :k] = best[rows]
    both[inverse, k + place[some]] = score[some]
    best[rows] = -np.sort(-both, axis=1)[:, :k]


def _scanned(routed: DataFrame, stored: DataFrame, query_parts: int, rotation: np.ndarray,
             search: Search) -> DataFrame:
    """query_id, vec_id, score: at most k rows per query and block."""
    shared = routed.sparkSession.sparkContext.broadcast(rotation)

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty
        order = np.argsort(left["list"].to_numpy(), kind="stable")
        offered, asked = _matrix(left["v"])[order], _matrix(right["v"])
        scale = 1 / max(np.abs(offered).max(), np.abs(asked).max())
        candidates = Side(offered, shared.value, search, scale)
        queries = Side(asked, shared.value, search, scale)
        ids, query_ids = left["vec_id"].to_numpy()[order], right["query_id"].to_numpy()
        lists, edges = np.unique(left["list"].to_numpy()[order], return_index=True)
        edges = np.append(edges, len(ids))
        probed = np.stack([np.isin(lists, some) for some in right["lists"].to_pylist()])
        beat, lengths = right["beat"].to_numpy().copy(), np.sqrt((asked ** 2).sum(axis=1))
        best = np.full((len(query_ids), search.k), -np.inf)
        found = []
        for at in range(len(lists)):
            members = slice(edges[at], edges[at + 1])
            vectors = candidates.exact[members]
            centre = vectors.mean(axis=0)
            radius = np.sqrt(((vectors - centre) ** 2).sum(axis=1).max())
            most = queries.exact @ centre + lengths * radius
            asking = np.flatnonzero(probed[:, at] & (most >= beat - 1e-9 * (1 + np.abs(most))))
            if not len(asking):
                continue
            q, c, score = adaptive_scan(
                queries.part(asking), candidates.part(members), beat[asking] * scale * scale, search)
            q = asking[q]
            c = c + edges[at]
            other = ids[c] != query_ids[q]
            q, c, score = q[other], c[other], score[other]
            if len(q):
                found.append((q, c, score))
                _raised(best, q, score)
                beat = np.maximum(beat, best[:, -1])
        if not found:
            return empty
        q, c, score = (np.concatenate(x) for x in zip(*found))
        kept = score >= beat[q]
        q, c, score = q[kept], c[kept], score[kept]
        order = np.lexsort((ids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        some = np.arange(len(q)) - np.searchsorted(q, q) < search.k
        return pa.table([query_ids[q[some]], ids[c[some]], score[some]],
                        names=["query_id", "vec_id", "score"])

    empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                      "score": pa.array([], pa.float64())})
    part = F.pmod(F.xxhash64("query_id"), F.lit(query_parts)).cast("int")
    asked = routed.withColumn("query_part", part)
    offered = stored.withColumn("query_part", F.explode(
        F.sequence(F.lit(0), F.lit(query_parts - 1))))
    return offered.groupBy("block", "query_part").cogroup(
        asked.groupBy("block", "query_part")).applyInArrow(
        scan, "query_id long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def search_all(rows: DataFrame, every: int = 20, search: Search = Search(), id_name: str = "vec_id",
               vector_name: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``, candidates all rows with another id. Rows
    with a null id, and vectors that ``usable`` leaves out, take no part. A query id that occurs twice
    asks once, with its first vector in order. With no more than k candidates all are found. Columns
    other than the two named are not looked at; an empty table gives an empty result.
    """
    vectors = usable(rows, id_name, vector_name).where(F.col("vec_id").isNotNull())
    spark, total = vectors.sparkSession, vectors.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = vectors.orderBy(F.xxhash64("vec_id", F.lit(search.seed))).limit(search.sample)
    points = _matrix(sample.select("v").toArrow()["v"])
    centres = _centres(points, min(search.max_lists, max(1, round(total ** 0.5))), search.seed)
    rotation = _rotation(points.shape[1], search.seed)
    listed = written(_in_lists(vectors, centres), "lists")
    counts = np.zeros(len(centres), np.int64)
    for row in listed.groupBy("list").count().collect():  # at most max_lists rows
        counts[row["list"]] = row["count"]
    layout = Layout.of(counts)
    placing = spark.createDataFrame(
        [(i, int(a), int(b)) for i, (a, b) in enumerate(zip(layout.first, layout.parts))],
        "list int, first int, parts int")
    stored = listed.join(F.broadcast(placing), "list").select(
        "vec_id", "v", "list",
        (F.col("first") + F.pmod(F.xxhash64("vec_id", "v"), F.col("parts"))).cast("int").alias("block"))
    asking = listed.where(F.col("vec_id") % every == 0).groupBy(
        F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    asking = written(asking, "queries")
    query_parts = max(1, -(-asking.count() // QUERY_ROWS))

    def scanned(queries: DataFrame, first_pass: bool) -> DataFrame:
        routed = _routed(queries, centres, layout, search, first_pass)
        return _scanned(routed, stored, query_parts, rotation, search)

    free = asking.withColumn("beat", F.lit(float("-inf")))
    known = _best(scanned(free, True), search.k).groupBy("query_id").agg(
        F.min("score").alias("least"), F.count("*").alias("n"))
    known = written(known.where(F.col("n") == search.k).select("query_id", "least"), "beaten")
    beat = asking.join(known, "query_id", "left").select(
        "query_id", "v", F.coalesce("least", F.lit(float("-inf"))).alias("beat"))
    return _best(scanned(beat, False), search.k).select("query_id", "rank", "vec_id", "score")
