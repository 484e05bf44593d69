"""Parquet table writes: layer append and merge by natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream import contracts
from envstream.operators import dedup
from envstream.sources import files, tables


def append_layer(rows: DataFrame, table: contracts.TableContract, root: str, merge_id: str,
                 balanced: bool = True) -> None:
    """Appends a batch to a layer, once: the same batch under the same ``merge_id`` adds nothing.

    The id is the last partition column on disk, and the write replaces the partitions of its own id
    only. Rebalancing on the partition columns gives every partition few files, and still splits a
    partition that is much larger than the rest. It costs a shuffle; without it every task writes a file
    for each partition that it has rows of, which is dearer for records of many days.
    """
    path = f"{root}/{table.location}"
    rows = rows.select(*table.schema.fieldNames())
    if balanced:
        rows = rows.hint("rebalance", *table.partitions)
    rows.withColumn(contracts.BATCH_COLUMN, F.lit(merge_id)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*table.stored_partitions).parquet(path)
    files.make_dirs(rows.sparkSession, path)
    rows.sparkSession.catalog.refreshByPath(path)


def replace_days(rows: DataFrame, table: contracts.TableContract, root: str, days: Sequence[str]) -> None:
    """Writes the rows of the given days anew; days without rows leave the table."""
    spark = rows.sparkSession
    (partition,) = table.partitions
    path = f"{root}/{table.location}"
    rows.select(*table.schema.fieldNames()).hint("rebalance", partition).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    there = {row[0] for row in rows.select(F.col(partition).cast("string")).distinct().collect()}
    for day in sorted(set(days) - there):
        files.delete(spark, f"{path}/{partition}={day}")
    spark.catalog.refreshByPath(path)


def merge_by_key(batch: DataFrame, table: contracts.TableContract, root: str,
                 key: Sequence[str], merge_id: str, order: Sequence[Column] = (),
                 keep: Column | None = None) -> None:
    """Insert or replace rows by natural key, rewriting only the days the batch touches.

    Within a key the larger ``order`` wins, then the batch over the table. Rows for which
    ``keep`` is not true leave the table. The touched days are read by their paths, merged with the
    batch into a staging folder, and written from there with dynamic partition overwrite. A repeated
    ``merge_id`` writes the staged days again, so no day is lost; an id must not come back with other
    rows.
    """
    spark = batch.sparkSession
    (partition,) = table.partitions
    path = f"{root}/{table.location}"
    staging = f"{root}/_merging/{table.location}/{merge_id}"
    kept = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    if not files.exists(spark, f"{staging}/_SUCCESS"):
        rows = dedup.latest_by(batch.select(*table.schema.fieldNames()), key, *order).persist()
        try:
            days = [row[0] for row in rows.select(F.col(partition).cast("string")).distinct().collect()]
            current = tables.read_folders(spark, path, table, days)
            merged = dedup.merge_rows(current, rows, key, *order)
            merged.select(*table.schema.fieldNames(), kept.alias("_kept")).write.mode(
                "overwrite").parquet(staging)
        finally:
            rows.unpersist()
    staged = spark.read.parquet(staging)
    staged.filter("_kept").drop("_kept").hint("rebalance", partition).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    emptied = staged.groupBy(partition).agg(F.max("_kept").alias("some")).filter(~F.col("some"))
    for row in emptied.select(F.col(partition).cast("string")).collect():  # days of this batch
        files.delete(spark, f"{path}/{partition}={row[0]}")
    spark.catalog.refreshByPath(path)
    files.delete(spark, staging)
