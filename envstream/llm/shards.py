"""Sharding by proportional stratified interleaving.

The rows of every source are shuffled by a seeded hash and ranked. Sorting all rows by the fractional
rank, (rank - 1/2) / rows of the source, deals every source out evenly over the whole order, so any
stretch of it holds the mixture of the corpus. The order is cut into shards whose row counts differ by
one at most.

A rank over a source, or a position over the table, is the number of rows in earlier slices plus the
place within the slice. Slices are cut on the hash and on the fractional rank, which are both spread
evenly, so no task sorts more than its even share, however large a source is. Only built-in functions
are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envstream.llm.common import written

HASH_DIGITS = 3          # hexadecimal: 4096 slices per source
POSITION_SLICES = 16384  # a power of two, so that multiplying by it is exact


def _ranked(rows: DataFrame) -> DataFrame:
    """Adds ``rank`` from 1 within the source, and ``in_source``, its rows."""
    rows = rows.withColumn("slice", F.substring("shuffle", 1, HASH_DIGITS))
    before = Window.partitionBy("stratum").orderBy("slice")
    offsets = rows.groupBy("stratum", "slice").agg(F.count("*").alias("n")).select(
        "stratum", "slice", (F.sum("n").over(before) - F.col("n")).alias("offset"),
        F.sum("n").over(Window.partitionBy("stratum")).alias("in_source"))
    place = Window.partitionBy("stratum", "slice").orderBy("shuffle", "doc_id", "text_crc32", "size")
    return rows.withColumn("place", F.row_number().over(place)).join(
        offsets, ["stratum", "slice"]).withColumn("rank", F.col("offset") + F.col("place"))


def _positioned(ranked: DataFrame) -> DataFrame:
    """Adds ``position`` from 0 in the order of the fractional rank, and ``total``, all rows."""
    share = ((F.col("rank") - F.lit(0.5)) / F.col("in_source")).alias("share")
    rows = ranked.select("doc_id", "size", "text_crc32", "stratum", "shuffle", share).withColumn(
        "part", F.floor(F.col("share") * POSITION_SLICES).cast("int"))
    # At most POSITION_SLICES rows, whatever the input, so one task may add them up.
    before = Window.partitionBy(F.lit(0)).orderBy("part")
    offsets = rows.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", (F.sum("n").over(before) - F.col("n")).alias("offset"),
        F.sum("n").over(Window.partitionBy(F.lit(0))).alias("total"))
    place = Window.partitionBy("part").orderBy(
        "share", "stratum", "shuffle", "doc_id", "text_crc32", "size")
    return rows.withColumn("place", F.row_number().over(place)).join(
        F.broadcast(offsets), "part").withColumn(
        "position", F.col("offset") + F.col("place") - 1)


def assign(docs: DataFrame, shards: int = 8, seed: int = 42) -> DataFrame:
    """doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null).

    Size is the UTF-8 length of the text plus 1; a null text has none. A null source is a source of
    its own. Copies and repeated rows are placed one by one, next to each other where even the hash
    agrees; rows alike in all of doc_id, source and text are interchangeable, so a repeated run gives
    the same result. Columns other than doc_id, text and source are not looked at; an empty table
    gives an empty result.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = written(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("stratum"),
        F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary")).alias("shuffle")), "shards")
    placed = _positioned(_ranked(rows))
    shard = F.expr(f"position * {shards} div total")
    start = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("position") - start).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
