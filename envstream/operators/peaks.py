"""Peak detection over windowed averages, and the state it carries between batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream import contracts
from envstream.functions import levels
from envstream.operators import dedup, series

KEY = list(contracts.SERIES_KEY)


def with_previous_average(metrics: DataFrame) -> DataFrame:
    """Adds prev_rolling_avg, the average of the window before in the same series."""
    rows = series.with_previous(metrics, KEY, "window_start", ["window_end"], ["rolling_avg"])
    return rows.withColumn("prev_rolling_avg", F.col("previous.rolling_avg")).drop("previous")


def flag_peaks(rows: DataFrame) -> DataFrame:
    """Adds delta and is_peak to rows that carry prev_rolling_avg."""
    return rows.withColumn("delta", F.col("rolling_avg") - F.col("prev_rolling_avg")).withColumn(
        "is_peak", levels.is_peak(F.col("parameter"), F.col("delta")))


def detect_peaks(metrics: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Compares each window with the one before it in its series.

    The first window of a series takes its predecessor from ``state`` (one row per series) if
    that is strictly earlier, so a window never meets an earlier average of itself.
    """
    rows = with_previous_average(metrics)
    if state is not None:
        # No hint: the state has a row per series and may be large, so its size decides.
        known = state.select(
            *KEY, F.col("prev_rolling_avg").alias("_state_avg"),
            F.col("prev_window_start").alias("_state_start"))
        earlier = F.when(F.col("_state_start") < F.col("window_start"), F.col("_state_avg"))
        rows = rows.join(known, KEY, "left").withColumn(
            "prev_rolling_avg", F.coalesce("prev_rolling_avg", earlier)
        ).drop("_state_avg", "_state_start")
    return flag_peaks(rows).select(*contracts.PEAKS.fieldNames())


def latest_state(metrics: DataFrame) -> DataFrame:
    """Newest window of every series, in the columns of the state table."""
    newest = dedup.latest_by(
        metrics.select(*KEY, "rolling_avg", "window_start"), KEY, F.col("window_start"))
    return newest.select(
        *KEY, F.col("rolling_avg").alias("prev_rolling_avg"),
        F.col("window_start").alias("prev_window_start"))


def merge_state(state: DataFrame, newer: DataFrame) -> DataFrame:
    """Newest window per series of two state tables; of equal windows the newer table wins."""
    return dedup.merge_rows(state, newer, KEY, F.col("prev_window_start"))


def window_ends(metrics: DataFrame) -> DataFrame:
    """First and last window of every series on each day."""
    columns = list(metrics.columns)
    at = F.struct(F.col("window_start"), *[F.col(c) for c in columns if c != "window_start"])
    ends = metrics.groupBy(*[F.col(c).alias(f"_{c}") for c in (*KEY, "window_date")]).agg(
        F.array_distinct(F.array(F.min(at), F.max(at))).alias("ends"))
    return ends.select(F.explode("ends").alias("end")).select(*[f"end.{c}" for c in columns])


def with_neighbours(metrics: DataFrame, ends: DataFrame) -> DataFrame:
    """The windows, marked as changed, with the first and last ones of other days in their series."""
    columns = list(contracts.AIR_METRIC_COLUMNS)
    near = ends.join(metrics.select(*KEY).distinct(), KEY, "left_semi")
    return metrics.select(*columns, F.lit(True).alias("_changed")).unionByName(
        near.select(*columns, F.lit(False).alias("_changed")))


def peaks_of_changes(merged: DataFrame) -> DataFrame:
    """Peaks result of the windows that changed or whose predecessor did."""
    rows = series.with_previous(
        merged, KEY, "window_start", ["window_end"], ["rolling_avg", "_changed"])
    touched = F.col("_changed") | F.coalesce(F.col("previous._changed"), F.lit(False))
    compared = rows.filter(touched).withColumn("prev_rolling_avg", F.col("previous.rolling_avg"))
    return flag_peaks(compared).select(*contracts.PEAKS.fieldNames())
