"""Tumbling averages in one or several granularities."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream import contracts, rules
from envstream.functions import levels, times


def steady_average(column: str) -> Column:
    """Average of decimal readings that does not depend on the order in which tasks add them up.

    Sums of doubles do, in their last digit, and it decides where a threshold is met exactly. So up to six
    decimals are added as such, and what a reading has beyond them, mostly nothing, as doubles.
    """
    value = F.col(column)
    # Too large or not a number: no decimal part, and all of it beyond.
    decimal = F.when(value.isNotNull(), F.coalesce(
        value.try_cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)")))
    beyond = F.avg(value - decimal.cast("double"))
    return F.sum(decimal).cast("double") / F.nullif(F.count(decimal), F.lit(0)) + beyond


def _tumbling(rows: DataFrame, duration: str, keys: Sequence[str],
              measures: Sequence[Column]) -> DataFrame:
    return (
        rows.groupBy(F.window("event_time", duration), *keys)
        .agg(*measures)
        .withColumns({
            "window_start": F.col("window.start"), "window_end": F.col("window.end"),
            "window_duration": F.lit(duration)})
        .drop("window")
    )


def windows_of(rows: DataFrame, durations: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Every row with its window of each duration, and the named columns."""
    choices = F.array(*[
        F.struct(F.lit(d).alias("label"), F.lit(times.duration_seconds(d)).alias("seconds"))
        for d in durations])
    return (
        rows.withColumn("duration", F.explode(choices))
        .withColumn("window_start", times.bucket_start(F.col("event_time"), F.col("duration.seconds")))
        .select(
            "window_start", F.timestamp_micros(F.unix_micros("window_start") + F.col(
                "duration.seconds").cast("bigint") * 1_000_000).alias("window_end"),
            F.col("duration.label").alias("window_duration"), *columns)
    )


def _all_durations(rows: DataFrame, durations: Sequence[str], keys: Sequence[str],
                   measures: Sequence[Column]) -> DataFrame:
    """Every granularity from one read and one shuffle.

    Each row meets its window of every duration before the aggregation, and the map side folds
    them at once; a union of one aggregation per duration would read the input that many times.
    """
    choices = F.array(*[
        F.struct(F.lit(d).alias("label"), F.lit(times.duration_seconds(d)).alias("seconds"))
        for d in durations])
    start = times.bucket_start(F.col("event_time"), F.col("duration.seconds"))
    return (
        rows.withColumn("duration", F.explode(choices))
        .withColumns({
            "window_start": start, "window_duration": F.col("duration.label"),
            "window_seconds": F.col("duration.seconds")})
        .groupBy("window_start", "window_duration", "window_seconds", *keys)
        .agg(*measures)
        .withColumn("window_end", F.timestamp_micros(
            F.unix_micros("window_start") + F.col("window_seconds").cast("bigint") * 1_000_000))
    )


def _together(rows: DataFrame, durations: Sequence[str], keys: Sequence[str],
              measures: Sequence[Column]) -> DataFrame:
    """Every granularity of a stream from one aggregation.

    Windows of all lengths are labels below the shortest window that holds whole ones of each, whose time
    the state follows. A window's state so leaves with that one.
    """
    outer = lcm(*map(times.duration_seconds, durations))
    columns = [c for c in rows.columns if c not in keys and c != "event_time"]
    labelled = windows_of(rows, durations, ["event_time", *keys, *columns])
    return labelled.groupBy(
        F.window("event_time", f"{outer} seconds"), "window_start", "window_end", "window_duration", *keys,
    ).agg(*measures).drop("window")


def _rollup(rows: DataFrame, durations: Sequence[str], keys: Sequence[str],
            measures: Sequence[Column], together: bool) -> DataFrame:
    if rows.isStreaming and together:
        return _together(rows, durations, keys, measures)
    if rows.isStreaming:
        # To emit each window when it closes, the state has to follow its own time.
        parts = [_tumbling(rows, d, keys, measures) for d in durations]
        return reduce(DataFrame.unionByName, parts)
    return _all_durations(rows, durations, keys, measures)


def air_averages(rows: DataFrame, durations: Sequence[str] = rules.WINDOW_DURATIONS,
                 together: bool = False) -> DataFrame:
    """Average value per window, city and pollutant.

    ``together`` is for streams in update mode, where windows come out at every change: all lengths share
    one aggregation then, and with it one source and one deduplication.
    """
    averages = _rollup(
        rows, durations, ["city", "parameter"], [steady_average("value").alias("rolling_avg")], together)
    return averages.select(
        "window_start", "window_end", "city", "parameter", "rolling_avg", "window_duration")


def weather_averages(rows: DataFrame, durations: Sequence[str] = rules.WINDOW_DURATIONS,
                     together: bool = False) -> DataFrame:
    """Average temperature, humidity and wind speed per window and city; see ``air_averages``."""
    averages = _rollup(rows, durations, ["city"], [
        F.avg("temperature_c").alias("avg_temperature"),
        F.avg("humidity_pct").alias("avg_humidity"),
        F.avg("wind_speed_ms").alias("avg_wind_speed"),
    ], together)
    return averages.select(*contracts.WEATHER_METRIC_COLUMNS)


def with_status(averages: DataFrame) -> DataFrame:
    status = levels.status_level(F.col("parameter"), F.col("rolling_avg"))
    return averages.withColumn("status", status).select(*contracts.AIR_METRIC_COLUMNS)


def with_window_date(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("window_date", F.to_date("window_start"))
