"""foreachBatch callbacks. All writes are keyed or named after their batch, so a repeated batch is harmless."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream import contracts
from envstream.operators import serving, windows
from envstream.sinks import metrics as prepare
from envstream.sinks.tables import append_layer, merge_by_key

ServingWriter = Callable[[DataFrame, int], None]


def _merge_id(batch: DataFrame, batch_id: int) -> str:
    """Names a batch of one run: a query that starts over gets another id from the engine."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query or 'batch'}-{batch_id:012d}"


class AirMetricsBatch:
    """Fans a batch of changed windows out to gold, the revisions for peaks, and the serving table."""

    def __init__(self, root: str, serving_writer: ServingWriter | None = None, preview: bool = False,
                 with_revisions: bool = True):
        self.root, self.serving_writer, self.preview = root, serving_writer, preview
        self.with_revisions = with_revisions

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        changed = batch.select(*contracts.AIR_METRIC_COLUMNS).persist()
        try:
            if changed.isEmpty():
                return
            merge_id = _merge_id(batch, batch_id)
            merge_by_key(
                windows.with_window_date(changed), contracts.GOLD_AIR, self.root,
                contracts.AIR_METRIC_KEY, merge_id)
            if self.with_revisions:
                append_layer(
                    changed.withColumn("revision", F.lit(batch_id).cast("bigint")),
                    contracts.REVISIONS_AIR, self.root, merge_id, balanced=False)
            if self.serving_writer is not None:
                self.serving_writer(prepare.prepare_air(changed), batch_id)
            if self.preview:
                serving.latest_windows(changed).show(truncate=False)
        finally:
            changed.unpersist()


class PeaksBatch:
    """Merges a batch of peaks results: rows that are peaks stay, others leave the table."""

    def __init__(self, root: str, preview: bool = False):
        self.root, self.preview = root, preview

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        found = batch.select(*contracts.PEAKS.fieldNames()).persist()
        try:
            if found.isEmpty():
                return
            merge_by_key(
                windows.with_window_date(found), contracts.GOLD_PEAKS, self.root,
                contracts.AIR_METRIC_KEY, _merge_id(batch, batch_id), keep=F.col("is_peak"))
            if self.preview:
                serving.latest_peaks(found).show(truncate=False)
        finally:
            found.unpersist()


class WeatherMetricsBatch:
    """Writes a batch of changed weather windows to the serving table."""

    def __init__(self, serving_writer: ServingWriter, preview: bool = False):
        self.serving_writer, self.preview = serving_writer, preview

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        changed = batch.select(*contracts.WEATHER_METRIC_COLUMNS).persist()
        try:
            if changed.isEmpty():
                return
            self.serving_writer(prepare.prepare_weather(changed), batch_id)
            if self.preview:
                serving.latest_windows(changed).show(truncate=False)
        finally:
            changed.unpersist()


def table_writer(table: contracts.TableContract, root: str, key: Sequence[str]) -> ServingWriter:
    """Serving writer that merges into a lakehouse table partitioned by window date."""

    def write(rows: DataFrame, batch_id: int) -> None:
        merge_by_key(
            windows.with_window_date(rows), table, root, key, _merge_id(rows, batch_id))

    return write
