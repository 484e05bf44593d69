"""Duplicate removal and latest-row selection.

Batch forms aggregate instead of ranking: the map side keeps one row per key, so a key that holds
a large share of the input never has to be sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream import rules
from envstream.functions import keys


def _unpack(best: DataFrame, columns: Sequence[str]) -> DataFrame:
    return best.select(*[F.col("_best")[c].alias(c) for c in columns])


def _extreme(rows: DataFrame, key: Sequence[Column], order: Sequence[Column], pick) -> DataFrame:
    """One row per key: the smallest or largest by ``order``, then by the remaining columns."""
    ranked = F.struct(
        *[o.alias(f"_order{i}") for i, o in enumerate(order)], *[F.col(c) for c in rows.columns])
    best = rows.groupBy(*[k.alias(f"_key{i}") for i, k in enumerate(key)]).agg(
        pick(ranked).alias("_best"))
    return _unpack(best, rows.columns)


def latest_by(rows: DataFrame, key: Sequence[str], *order: Column) -> DataFrame:
    """Row with the largest ``order`` per key; a missing order value loses. Batch only."""
    return _extreme(rows, [F.col(k) for k in key], order, F.max)


def earliest_by(rows: DataFrame, key: Sequence[str], *order: Column) -> DataFrame:
    """Row with the smallest ``order`` per key; a missing order value wins. Batch only."""
    return _extreme(rows, [F.col(k) for k in key], order, F.min)


def merge_rows(current: DataFrame, newer: DataFrame, key: Sequence[str],
               *order: Column) -> DataFrame:
    """Rows of both tables, one per key: the larger ``order`` wins, then the newer table."""
    both = current.withColumn("_newer", F.lit(0)).unionByName(newer.withColumn("_newer", F.lit(1)))
    return latest_by(both, key, *order, F.col("_newer")).drop("_newer")


def _deduplicate(rows: DataFrame, key: Column, delay: str) -> DataFrame:
    if rows.isStreaming:
        return (
            rows.withWatermark("event_time", delay)
            .withColumn("dedup_key", key)
            .dropDuplicatesWithinWatermark(["dedup_key"])
            .drop("dedup_key")
        )
    return _extreme(rows, [key], [F.col("event_time")], F.min)


def dedup_air(rows: DataFrame, delay: str = rules.WATERMARK_DELAY) -> DataFrame:
    """One row per message id, or per city, pollutant and time where the id is missing.

    A stream forgets a key once the watermark passes the delay, so duplicates further apart than
    the delay are both kept there.
    """
    return _deduplicate(rows, keys.air_dedup_key(), delay)


def dedup_weather(rows: DataFrame, delay: str = rules.WATERMARK_DELAY) -> DataFrame:
    """As ``dedup_air``; the fallback key adds the source and the three measurements."""
    return _deduplicate(rows, keys.weather_dedup_key(), delay)
