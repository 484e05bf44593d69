"""Sorting parsed rows into rejects and clean observations.

A comparison with a missing measurement, or of an unsupported pollutant, is neither true nor
false: such rows are neither rejected nor kept. ``dispositions`` counts them, and
``strict=True`` rejects them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from envstream.functions import levels, times, units

_NOT_IN_SILVER = ("raw_value", "event_time_raw", "corrupt_record")


def _air_in_range() -> Column:
    return levels.pollutant_in_range(F.col("parameter"), F.col("value"))


def _air_supported() -> Column:
    return levels.is_supported_pollutant(F.col("parameter"))


def air_reject_reason(strict: bool = False) -> Column:
    """First reason that applies, or null."""
    reason = (
        F.when(F.col("corrupt_record").isNotNull(), "corrupt_json")
        .when(F.col("event_time").isNull(), "missing_event_time")
        .when(F.col("value").isNull(), "missing_value")
        .when(F.col("city").isNull(), "missing_city")
        .when(_air_supported() & ~_air_in_range(), "invalid_range")
    )
    if strict:
        reason = reason.when(
            ~F.coalesce(_air_supported(), F.lit(False)), "unsupported_parameter")
    return reason


def weather_reject_reason(strict: bool = False, strict_units: bool = False) -> Column:
    in_range = levels.weather_in_range()
    reason = (
        F.when(F.col("corrupt_record").isNotNull(), "corrupt_json")
        .when(F.col("event_time").isNull(), "missing_event_time")
        .when(F.col("city").isNull(), "missing_city")
        .when(~in_range, "invalid_range")
    )
    if strict:
        reason = reason.when(in_range.isNull(), "missing_measurement")
    if strict_units:
        known = units.has_known_units(
            F.col("temperature_unit"), F.col("wind_unit"), F.col("humidity_unit"))
        reason = reason.when(~known, "unknown_unit")
    return reason


def _rejects(parsed: DataFrame, reason: Column, middle: list[Column],
             rejected_at: datetime | None) -> DataFrame:
    moment = F.current_timestamp() if rejected_at is None else times.literal(rejected_at)
    return (
        parsed.withColumn("reject_reason", reason)
        .filter(F.col("reject_reason").isNotNull())
        .select(
            "raw_value", "corrupt_record", "event_time_raw", *middle, "reject_reason",
            moment.cast("timestamp").alias("rejected_at"))
        .withColumn("reject_date", F.to_date("rejected_at"))
    )


def air_rejects(parsed: DataFrame, rejected_at: datetime | None = None,
                strict: bool = False) -> DataFrame:
    middle = [F.col("value").cast("double").alias("value_raw"), F.col("city").alias("city_raw")]
    return _rejects(parsed, air_reject_reason(strict), middle, rejected_at)


def weather_rejects(parsed: DataFrame, rejected_at: datetime | None = None,
                    strict: bool = False, strict_units: bool = False) -> DataFrame:
    return _rejects(
        parsed, weather_reject_reason(strict, strict_units), [F.col("city").alias("city_raw")],
        rejected_at)


def text_of_rejects(parsed: DataFrame, reason: Column) -> DataFrame:
    """Parsed rows that carry their raw text only where there is a reason to reject them."""
    return parsed.withColumn("raw_value", F.when(reason.isNotNull(), F.col("raw_value")))


def usable(parsed: DataFrame, *required: str) -> DataFrame:
    """Rows that parsed and carry every required field, without the raw columns."""
    return (
        parsed.filter(F.col("corrupt_record").isNull())
        .dropna(subset=list(required))
        .drop(*_NOT_IN_SILVER)
    )


def usable_air(parsed: DataFrame) -> DataFrame:
    # ``isNotNull`` rather than dropna on the number, which would also drop NaN.
    return usable(parsed, "event_time", "city").filter(F.col("value").isNotNull())


def usable_weather(parsed: DataFrame, strict_units: bool = False) -> DataFrame:
    rows = usable(parsed, "event_time", "city")
    if strict_units:
        rows = rows.filter(units.has_known_units(
            F.col("temperature_unit"), F.col("wind_unit"), F.col("humidity_unit")))
    return rows


def plausible_air(rows: DataFrame) -> DataFrame:
    return rows.filter(_air_supported()).filter(_air_in_range())


def plausible_weather(rows: DataFrame) -> DataFrame:
    return rows.filter(levels.weather_in_range())


def with_event_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_date", F.to_date("event_time"))


def air_disposition(parsed: DataFrame) -> DataFrame:
    """Adds ``disposition``: kept, a reject reason, or why the row silently drops out."""
    reason = F.coalesce(
        air_reject_reason(),
        F.when(~F.coalesce(_air_supported(), F.lit(False)), "dropped_unsupported_parameter"),
        F.lit("kept"))
    return parsed.withColumn("disposition", reason)


def weather_disposition(parsed: DataFrame) -> DataFrame:
    reason = F.coalesce(
        weather_reject_reason(),
        F.when(levels.weather_in_range().isNull(), "dropped_null_measurement"),
        F.lit("kept"))
    return parsed.withColumn("disposition", reason)


def observe_dispositions(rows: DataFrame, name: str | Observation,
                         dispositions: Sequence[str]) -> DataFrame:
    """Counts dispositions on the side while the rows pass, also in a stream's progress."""
    counts = [
        F.count(F.when(F.col("disposition") == d, 1)).alias(d) for d in dispositions]
    return rows.observe(name, *counts)


def count_dispositions(rows: DataFrame) -> DataFrame:
    """Rows per city and disposition."""
    return rows.groupBy("city", "disposition").agg(F.count("*").alias("rows"))
