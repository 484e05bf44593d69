"""Connected components of a graph, by rounds of large-star and small-star.

Every round hangs the neighbours of each node below its least neighbour. Only the least one per node
is computed, with partial results on the map side, and joined back, so no neighbourhood is gathered
in one place. Each round reads what the round before wrote to the shared folder. Whether another one is
needed is asked first, by one aggregate over the ends of the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import written


def _each(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """(u, v) rows, one of every given pair of columns for each row, from one read of the rows."""
    made = [F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs]
    return rows.select(F.explode(F.array(*made)).alias("pair")).select("pair.*")


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v) rows with the least of u and all its v."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges from the larger node to the smaller one, no more than before; some may come repeatedly."""
    return _with_least(_each(edges, ("u", "v"), ("v", "u"))).where(F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges lead from the larger node to the smaller one."""
    return _each(_with_least(edges), ("v", "m"), ("u", "m"))


def _clean(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs below one node at most, and that one below none: a round changes nothing."""
    up, down = [F.struct(F.col(c).alias("node"), F.lit(n).alias("up")) for c, n in (("u", 1), ("v", 0))]
    ends = edges.select(F.explode(F.array(up, down)).alias("end"))
    met = ends.groupBy("end.node").agg(F.sum("end.up").alias("up"), F.min("end.up").alias("least"))
    # A node with an edge up and one down, or with two up.
    return met.where((F.col("up") > 0) & ((F.col("up") > 1) | (F.col("least") == 0))).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge, but the roots; root is the least node it reaches.

    ``edges`` has two columns of longs. Loops and repeated edges do no harm.
    """
    a, b = edges.columns
    now = written(_clean(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    while not _are_stars(now):
        now = written(_clean(_small_star(_large_star(now))), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
