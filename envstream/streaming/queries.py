"""Starting the queries of the flows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from envstream import contracts, rules
from envstream.operators import windows
from envstream.plans.flows import AirFlow, WeatherFlow
from envstream.sources import files
from envstream.streaming import state
from envstream.streaming.batches import (
    AirMetricsBatch, PeaksBatch, ServingWriter, WeatherMetricsBatch,
)

#: Tasks that share a partition of a layer within a batch, each with a file of its own.
PARTITION_TASKS = 4


@dataclass(frozen=True)
class StreamSettings:
    """Where layers and checkpoints live, and when batches run.

    ``available_now`` processes what is there and ends: for backfills and tests. A run with new
    checkpoints starts over; one with the same ones resumes.
    """

    root: str
    checkpoints: str
    trigger_interval: str = rules.TRIGGER_INTERVAL
    available_now: bool = False
    delay: str = rules.WATERMARK_DELAY
    preview: bool = False
    clean_revisions: bool = False

    def fresh(self, run: str) -> StreamSettings:
        return replace(self, checkpoints=f"{self.checkpoints}/{run}")

    def prepared(self, writer: DataStreamWriter, name: str) -> DataStreamWriter:
        writer = writer.option("checkpointLocation", f"{self.checkpoints}/{name}")
        if self.available_now:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=self.trigger_interval)


def start_layer(rows: DataFrame, table: contracts.TableContract,
                settings: StreamSettings) -> StreamingQuery:
    """Appends a stream to its layer; the engine's file sink writes every row exactly once.

    Rows are dealt by partition first, each over ``PARTITION_TASKS`` tasks. Else every task would write a file
    for each day that it has rows of, and a batch over many days tasks times days of them.
    """
    rows = rows.select(*table.schema.fieldNames())
    if table.partitions:
        share = F.pmod(F.xxhash64(*rows.columns), F.lit(PARTITION_TASKS))
        rows = rows.repartition(*table.partitions, share)
    if table.appended:
        rows = rows.withColumn(contracts.BATCH_COLUMN, F.lit("stream"))
    writer = (
        rows.writeStream.outputMode("append")
        .format("parquet").option("path", f"{settings.root}/{table.location}")
        .partitionBy(*table.stored_partitions)
    )
    return settings.prepared(writer, table.name).start()


def start_batches(rows: DataFrame, callback, name: str,
                  settings: StreamSettings, output_mode: str = "update") -> StreamingQuery:
    writer = rows.writeStream.outputMode(output_mode).foreachBatch(callback)
    return settings.prepared(writer, name).start()


def start_publishing(records: DataFrame, servers: str, topic: str, name: str,
                     settings: StreamSettings) -> StreamingQuery:
    """Publishes a stream of keyed records. Needs the Kafka connector on the class path."""
    writer = records.writeStream.outputMode("append").format("kafka").option(
        "kafka.bootstrap.servers", servers).option("topic", topic)
    return settings.prepared(writer, name).start()


def start_console(rows: DataFrame, name: str, settings: StreamSettings) -> StreamingQuery:
    """Prints changed windows. It keeps its own state, so prefer ``preview`` beside a sink."""
    writer = rows.writeStream.outputMode("update").format("console").option("truncate", "false")
    return settings.prepared(writer, name).start()


def start_air(flow: AirFlow, settings: StreamSettings,
              serving_writer: ServingWriter | None = None) -> list[StreamingQuery]:
    """Bronze, rejects and silver as they come, and one query for everything windowed.

    ``start_peaks`` goes on from the revisions that it writes.
    """
    metrics = AirMetricsBatch(settings.root, serving_writer, settings.preview)
    return [
        start_layer(flow.bronze, contracts.BRONZE_AIR, settings),
        start_layer(flow.rejects, contracts.REJECTS_AIR, settings),
        start_layer(flow.silver, contracts.SILVER_AIR, settings),
        start_batches(flow.live_metrics, metrics, "air_metrics", settings),
    ]


def start_peaks(spark: SparkSession, settings: StreamSettings,
                durations: Sequence[str] = rules.WINDOW_DURATIONS) -> StreamingQuery:
    """Peaks of the windows that ``start_air`` revises, beside it or after it.

    Revisions are deleted once they were processed, if ``settings`` say so.
    """
    path = f"{settings.root}/{contracts.REVISIONS_AIR.location}"
    files.make_dirs(spark, path)
    reader = spark.readStream.schema(StructType([
        *contracts.REVISIONS_AIR.schema.fields, StructField(contracts.BATCH_COLUMN, StringType())]))
    if settings.clean_revisions:
        reader = reader.option("cleanSource", "delete")
    rows = state.peak_rows(reader.parquet(path), settings.delay, durations)
    with state.keyed_store(spark):
        return start_batches(
            rows, PeaksBatch(settings.root, settings.preview), "air_peaks", settings)


def start_changes(readings: DataFrame, callback, name: str, settings: StreamSettings,
                  key: Sequence[str], time_column: str, tie_break: Sequence[str],
                  compared: Sequence[str], ttl: str = rules.CHANGE_STATE_TTL) -> StreamingQuery:
    """Hands on the readings that bring something new; see ``state.changed_readings``."""
    rows = state.changed_readings(readings, key, time_column, tie_break, compared, ttl)
    with state.keyed_store(readings.sparkSession, data_only=settings.available_now):
        return start_batches(rows, callback, name, settings, "append")


def start_weather(flow: WeatherFlow, settings: StreamSettings,
                  serving_writer: ServingWriter | None = None) -> list[StreamingQuery]:
    """As ``start_air``; gold holds final windows, and the serving table every revision."""
    queries = [
        start_layer(flow.bronze, contracts.BRONZE_WEATHER, settings),
        start_layer(flow.rejects, contracts.REJECTS_WEATHER, settings),
        start_layer(flow.silver, contracts.SILVER_WEATHER, settings),
        start_layer(
            windows.with_window_date(flow.metrics), contracts.GOLD_WEATHER, settings),
    ]
    if serving_writer is not None:
        callback = WeatherMetricsBatch(serving_writer, settings.preview)
        queries.append(start_batches(flow.live_metrics, callback, "weather_metrics", settings))
    return queries


def run_until_any_ends(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Waits for the first of the queries to end, stops the others, and raises its error."""
    def all_active() -> bool:
        return all(query.isActive for query in queries)

    try:
        while all_active():
            # Earlier ends of other queries must not count, and one from here on must.
            spark.streams.resetTerminated()
            if all_active():
                spark.streams.awaitAnyTermination()
        for query in queries:
            if query.exception() is not None:
                raise query.exception()
    finally:
        for query in queries:
            query.stop()


def run_to_end(queries: list[StreamingQuery]) -> None:
    """Waits for ``available_now`` queries."""
    for query in queries:
        query.awaitTermination()
