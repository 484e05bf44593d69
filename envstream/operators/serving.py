"""Dashboard panels and reports over the metric tables.

Time bounds are arguments. Where the table has a ``window_date`` partition column the bounds are
repeated on it, since the optimizer cannot infer them from ``window_start``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream import rules
from envstream.functions import text, times
from envstream.operators import dedup

ACTIVE_SPAN = "10 minutes"
DAY_SPAN = "24 hours"


@dataclass(frozen=True)
class PanelFilter:
    """Time range of the dashboard and the patterns of its four variables."""

    time_from: datetime
    time_to: datetime
    city: str = ".*"
    parameter: str = ".*"
    window_duration: str = ".*"
    status: str = ".*"

    def apply(self, metrics: DataFrame, span: str | None = None) -> DataFrame:
        """Rows in the range, and within ``span`` before its end if given."""
        start = self.time_from
        if span is not None:
            start = max(start, self.time_to - times.delta(span))
        rows = metrics.filter(F.col("window_start").between(
            times.literal(start), times.literal(self.time_to)))
        if "window_date" in metrics.columns:
            rows = rows.filter(F.col("window_date").between(
                F.lit(start.date()), F.lit(self.time_to.date())))
        for name in ("city", "parameter", "window_duration", "status"):
            rows = rows.filter(text.matches_filter(F.col(name), getattr(self, name)))
        return rows


def _with_status(metrics: DataFrame, panel: PanelFilter, span: str | None,
                 *statuses: str) -> DataFrame:
    return panel.apply(metrics, span).filter(F.col("status").isin(*statuses))


def _label(*columns: str) -> Column:
    return F.concat_ws(" / ", *columns)


def _as_double(column: str = "*") -> Column:
    return F.count(column).cast("double")


def active_count(metrics: DataFrame, panel: PanelFilter, status: str) -> DataFrame:
    return _with_status(metrics, panel, ACTIVE_SPAN, status).agg(_as_double().alias("value"))


def cities_impacted(metrics: DataFrame, panel: PanelFilter) -> DataFrame:
    rows = _with_status(metrics, panel, ACTIVE_SPAN, "DANGER", "WARNING")
    return rows.agg(F.count_distinct("city").cast("double").alias("value"))


def _danger_pairs(metrics: DataFrame, panel: PanelFilter, span: str, label: str) -> DataFrame:
    rows = _with_status(metrics, panel, span, "DANGER")
    return rows.groupBy(_label("city", "parameter").alias(label)).agg(
        _as_double().alias("danger_count"))


def worst_offender(metrics: DataFrame, panel: PanelFilter) -> DataFrame:
    """City and pollutant with most active DANGER windows, or a default row when there is none.

    A global aggregate always returns one row, so the default needs no second read.
    """
    pairs = _danger_pairs(metrics, panel, ACTIVE_SPAN, "metric")
    worst = pairs.agg(F.min(F.struct(
        (-F.col("danger_count")).alias("rank"), F.col("metric"))).alias("w"))
    return worst.select(
        times.literal(panel.time_to).alias("time"),
        F.coalesce("w.metric", F.lit(rules.NO_DANGER_LABEL)).alias("metric"),
        F.coalesce(-F.col("w.rank"), F.lit(0.0)).alias("value"))


def recent_alerts(metrics: DataFrame, panel: PanelFilter,
                  limit: int = rules.RECENT_ALERTS_LIMIT) -> DataFrame:
    rows = _with_status(metrics, panel, ACTIVE_SPAN, "DANGER")
    return (
        rows.orderBy(F.col("window_start").desc(), "city", "parameter", "window_duration")
        .limit(limit)
        .select(
            "window_start", "window_end", "city", "parameter",
            F.round("rolling_avg", 2).alias("rolling_avg"), "status", "window_duration")
    )


def active_pairs(metrics: DataFrame, panel: PanelFilter,
                 limit: int = rules.TOP_PAIRS_LIMIT) -> DataFrame:
    pairs = _danger_pairs(metrics, panel, ACTIVE_SPAN, "city_parameter")
    return pairs.orderBy(F.col("danger_count").desc(), "city_parameter").limit(limit)


def top_offenders(metrics: DataFrame, panel: PanelFilter,
                  limit: int = rules.TOP_PAIRS_LIMIT) -> DataFrame:
    pairs = _danger_pairs(metrics, panel, DAY_SPAN, "offender")
    return pairs.orderBy(F.col("danger_count").desc(), "offender").limit(limit)


def status_trend(metrics: DataFrame, panel: PanelFilter, step: str) -> DataFrame:
    """Alerting windows per time step, city and status."""
    rows = _with_status(metrics, panel, None, "WARNING", "DANGER")
    bucket = times.bucket_start(F.col("window_start"), times.duration_seconds(step))
    return rows.groupBy(bucket.alias("time"), _label("city", "status").alias("metric")).agg(
        _as_double().alias("value")).orderBy("time", "metric")


def last_danger(metrics: DataFrame, panel: PanelFilter) -> DataFrame:
    """Last DANGER window of every city in the last day; ties go to the later names."""
    rows = _with_status(metrics, panel, DAY_SPAN, "DANGER").select(
        "city", F.col("window_start").alias("last_danger_at"), "parameter",
        F.round("rolling_avg", 2).alias("rolling_avg"), "window_duration")
    return dedup.latest_by(
        rows, ["city"], F.col("last_danger_at"), F.col("parameter"), F.col("window_duration"))


def filter_values(metrics: DataFrame, column: str) -> DataFrame:
    """Choices of one dashboard variable, sorted."""
    return metrics.select(column).distinct().orderBy(column)


def filter_choices(metrics: DataFrame,
                   columns: Sequence[str] = ("city", "parameter", "window_duration", "status"),
                   ) -> DataFrame:
    """Choices of all dashboard variables from one read of the table.

    Equal combinations fold before they are taken apart, so few rows are multiplied.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).alias("choice")) for c in columns])
    combinations = metrics.select(*columns).distinct()
    return combinations.select(F.explode(pairs).alias("p")).select("p.*").distinct()


def average_by_city_and_parameter(metrics: DataFrame, limit: int | None = None) -> DataFrame:
    """Average per city and pollutant, sorted; a chart may ask for the first ``limit`` rows."""
    averages = metrics.groupBy("city", "parameter").agg(
        F.avg("rolling_avg").alias("avg_rolling_avg"))
    ordered = averages.orderBy("city", "parameter")
    return ordered if limit is None else ordered.limit(limit)


def latest_windows(metrics: DataFrame, limit: int = rules.PREVIEW_LIMIT) -> DataFrame:
    """Newest windows for display, with a full tie-break."""
    others = [c for c in metrics.columns if c != "window_start"]
    return metrics.orderBy(F.col("window_start").desc(), *others).limit(limit)


def latest_peaks(results: DataFrame, limit: int = rules.PREVIEW_LIMIT) -> DataFrame:
    """Newest peaks for display, in the columns of the debug table, with a full tie-break."""
    columns = ["window_start", "window_end", "city", "parameter", "rolling_avg", "status", "delta",
               "is_peak", "window_duration"]
    return latest_windows(results.filter("is_peak").select(*columns), limit)


def with_coordinates(metrics: DataFrame, cities: DataFrame) -> DataFrame:
    """Adds latitude and longitude; a city outside the dimension gets none."""
    return metrics.join(cities.select("city", "latitude", "longitude"), "city", "left")


def within_retention(metrics: DataFrame, now: datetime,
                     days: int = rules.RETENTION_DAYS) -> DataFrame:
    """Rows younger than the retention period."""
    oldest = now - times.delta(f"{days} days")
    rows = metrics.filter(F.col("window_start") >= times.literal(oldest))
    if "window_date" in metrics.columns:
        rows = rows.filter(F.col("window_date") >= F.lit(oldest.date()))
    return rows
