"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Entries become whole numbers, so sums are exact. Every task adds up the products of its centred rows
and sends one matrix; the sum, as wide as the vectors, is factored on the driver. The scatter is
P L L' P', where L stops at the rank. Rotations from the right make the columns of L orthogonal and
leave L L' as it is: then the squared norms of the columns are the eigenvalues, and the columns,
normalised and put back in order, the components. The scatter itself is never diagonalised, and small
eigenvalues keep their relative precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import written

SCALE, SHIFT = 64, 1_000_000
#: Entries beyond are taken as this; doubles count in whole numbers up to it.
LARGEST = 1 << 53
#: A pivot below this share of the largest one is rounding, and ends the factor.
NOTHING = 1e-13
_LONG = 1 << 63


def usable(rows: DataFrame, id_name: str = "vec_id", vector_name: str = "embedding") -> DataFrame:
    """vec_id and x (longs) of the rows that take part.

    Left out are vectors that are null, hold a null or a number that isn't finite, or have another
    length than most vectors (the smaller length, if two are as frequent).
    """
    v = F.col(vector_name).cast("array<double>")
    kept = rows.select(F.col(id_name).alias("vec_id"), v.alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (
            F.abs(c) < float("inf"))))
    far = float(LARGEST)
    whole = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(far)), F.lit(-far))) + SHIFT)
    kept = written(kept.select("vec_id", whole.alias("x")), "whole-vectors")
    usual = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return kept.where(F.size("x") == (usual.d if usual else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(rows: DataFrame, name: str, kind: str) -> list:
    """Sum per position of an array column: as many numbers as the arrays are long."""
    found = rows.select(F.posexplode(name).alias("at", "value")).groupBy("at").agg(
        F.sum(F.col("value").cast(kind)).alias("s"))
    return [row.s for row in sorted(found.collect())]


def scatter(rows: DataFrame, name: str, centre: np.ndarray) -> np.ndarray:
    """Sum of (v - centre)(v - centre)' over an array column."""
    shared = rows.sparkSession.sparkContext.broadcast(centre)
    size = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                apart = _matrix(batch.column(0)) - shared.value
                total += apart.T @ apart
        for i in range(size):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size - i, i, np.int32)), pa.array(np.arange(i, size, dtype=np.int32)),
                 pa.array(total[i, i:])], names=["i", "j", "s"])

    # One matrix per task comes in, and one in all goes out.
    found = rows.select(name).mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(
        F.sum("s").alias("s"))
    made = np.zeros((size, size))
    for row in found.collect():
        made[row.i, row.j] = made[row.j, row.i] = row.s
    return made


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order) with matrix[order][:, order] = factor @ factor.T; factor is as wide as the rank."""
    rest = matrix.astype(float).copy()
    size = len(rest)
    order, factor = np.arange(size), np.zeros((size, size))
    least = NOTHING * max(rest.diagonal().max(initial=0), 0)
    for step in range(size):
        pivot = step + int(np.argmax(rest.diagonal()[step:]))
        if rest[pivot, pivot] <= least:
            return factor[:, :step], order
        swap, back = [step, pivot], [pivot, step]
        rest[swap], order[swap], factor[swap] = rest[back], order[back], factor[back]
        rest[:, swap] = rest[:, back]
        column = rest[step:, step] / np.sqrt(rest[step, step])
        factor[step:, step] = column
        rest[step:, step:] -= np.outer(column, column)
    return factor, order


def one_sided_jacobi(factor: np.ndarray, turns: int = 60) -> np.ndarray:
    """The factor times rotations that make its columns orthogonal to double precision."""
    a = factor.copy()
    width = a.shape[1]
    # Rounds of disjoint pairs, as in a round-robin; a column without partner sits out.
    ring = list(range(width + width % 2))
    rounds = []
    for _ in range(len(ring) - 1):
        pairs = [(min(p, q), max(p, q)) for p, q in zip(ring[:len(ring) // 2], ring[::-1])]
        rounds.append(np.array([p for p in pairs if p[1] < width], np.int64).reshape(-1, 2).T)
        ring = [ring[0], ring[-1], *ring[1:-1]]
    for _ in range(turns):
        turned = False
        for p, q in rounds:
            left, right = a[:, p], a[:, q]
            alpha, beta = (left ** 2).sum(axis=0), (right ** 2).sum(axis=0)
            gamma = (left * right).sum(axis=0)
            askew = np.abs(gamma) > 1e-15 * np.sqrt(alpha * beta)
            if not askew.any():
                continue
            turned = True
            zeta = (beta - alpha)[askew] / (2 * gamma[askew])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            cosine = np.ones(len(p))
            sine = np.zeros(len(p))
            cosine[askew] = 1 / np.hypot(1, t)
            sine[askew] = cosine[askew] * t
            a[:, p], a[:, q] = cosine * left - sine * right, sine * left + cosine * right
        if not turned:
            break
    return a


def components(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above rounding, falling, and their unit vectors as columns."""
    factor, order = pivoted_cholesky(matrix)
    turned = one_sided_jacobi(factor)
    values = (turned ** 2).sum(axis=0)
    falling = np.argsort(-values, kind="stable")
    falling = falling[values[falling] > 0]
    vectors = np.empty((len(matrix), len(falling)))
    vectors[order] = turned[:, falling] / np.sqrt(values[falling])
    return values[falling], vectors


def deviations(x: np.ndarray, sums: list[int], n: int) -> list[int | None]:
    """Sum over dimensions of (n * x - S) ** 2 per row, exact; none where it needs more than a long."""
    rounded = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    apart = (x - rounded).astype(float)
    size = ((n * np.abs(apart) + n) ** 2).sum(axis=1)
    small = size < _LONG // 2
    out: list[int | None] = [None] * len(x)
    exact = ((n * (x[small] - rounded) - rest) ** 2).sum(axis=1)
    for at, value in zip(np.flatnonzero(small).tolist(), exact.tolist()):
        out[at] = value
    for at in np.flatnonzero(~small).tolist():
        value = sum((n * v - s) ** 2 for v, s in zip(x[at].tolist(), sums))
        out[at] = value if value < _LONG else None
    return out


def whitened(rows: DataFrame, most: int = 32, id_name: str = "vec_id",
             vector_name: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error per row and component.

    Components are numbered by falling eigenvalue, ``most`` at most; directions without any variance
    have none, as nothing can be divided by their root. So equal vectors, a single one and an empty
    table give an empty result. ``identity_error`` is measured on the whitened values, in a pass of its own.
    Rows with null or repeated ids are rows like others; columns other than the two named are not
    looked at. Entries beyond 2 ** 53 after scaling are taken as that, and a deviation that no long
    holds is null.
    """
    vectors = usable(rows, id_name, vector_name)
    spark, n = vectors.sparkSession, vectors.count()
    kind = vectors.schema["vec_id"].dataType.simpleString()
    empty = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
             "identity_error double")
    sums = [int(s) for s in _sums(vectors, "x", "decimal(38,0)")] if n else []
    if not sums:
        return spark.createDataFrame([], empty)
    mean = np.array([s / n for s in sums])
    covariance = scatter(vectors, "x", mean) / n
    values, directions = components(covariance)
    values, directions = values[:most], directions[:, :most]
    if not len(values):
        return spark.createDataFrame([], empty)
    explained = (values / covariance.trace()).tolist()
    shared = spark.sparkContext.broadcast((sums, mean, directions / np.sqrt(values)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, mean, scaled = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            made = (x - mean) @ scaled
            edges = np.arange(len(x) + 1, dtype=np.int32) * made.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviations(x, sums, n), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(edges), pa.array(made.reshape(-1)))],
                names=["vec_id", "deviation", "w"])

    found = written(vectors.mapInArrow(
        run, f"vec_id {kind}, deviation long, w array<double>"), "whitened-vectors")
    centre = np.array(_sums(found, "w", "double")) / n
    error = float(np.abs(scatter(found, "w", centre) / n - np.eye(len(values))).max())
    shares = F.array(*[F.lit(x) for x in explained])
    return found.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
