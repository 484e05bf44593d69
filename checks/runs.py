"""Write-and-read-back runs behind the registered table, catalog and stream queries."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import feed
from envstream import contracts
from envstream.functions import times
from envstream.operators import parse, peaks, windows
from envstream.plans import backfill, flows
from envstream.session import work_dir
from envstream.sinks import catalog
from envstream.sinks import tables as sinks
from envstream.sources import streams
from envstream.sources import tables as sources
from envstream.streaming import queries
from envstream.streaming.batches import AirMetricsBatch, table_writer

CUT = datetime(2024, 1, 16)
WEEKS = [datetime(2024, 1, day) for day in (8, 16, 23)]
FAR = datetime(2099, 1, 1)
LIVE_WEATHER = contracts.TableContract(
    "weather_metrics", "serving/weather_metrics", contracts.GOLD_WEATHER.schema, ("window_date",))
TABLES = {
    ("air", "bronze"): contracts.BRONZE_AIR, ("air", "silver"): contracts.SILVER_AIR,
    ("air", "rejects"): contracts.REJECTS_AIR, ("weather", "silver"): contracts.SILVER_WEATHER,
    ("weather", "rejects"): contracts.REJECTS_WEATHER,
}


def _read(spark: SparkSession, root: str, table: contracts.TableContract) -> DataFrame:
    return sources.read_or_empty(spark, f"{root}/{table.location}", table.schema)


def overlapping_merges(spark: SparkSession, metrics: DataFrame, middle: datetime) -> DataFrame:
    """Gold after one batch with everything, a revision of its first half, and that one again."""
    root = work_dir(spark, "gold-merge")
    everything = windows.with_window_date(metrics)
    revised = everything.filter(F.col("window_start") < times.literal(middle)).withColumn(
        "rolling_avg", F.col("rolling_avg") + 1)
    for merge_id, batch in (("0", everything), ("1", revised), ("1", revised)):
        sinks.merge_by_key(
            batch, contracts.GOLD_AIR, root, contracts.AIR_METRIC_KEY, merge_id)
    return _read(spark, root, contracts.GOLD_AIR)


def merged_peaks(spark: SparkSession, metrics: DataFrame) -> DataFrame:
    """Peaks of all windows, then a revision that turns those of one city into no peaks."""
    root = work_dir(spark, "peaks-merge")
    found = windows.with_window_date(peaks.detect_peaks(metrics))
    calmed = found.withColumn("is_peak", F.col("is_peak") & (F.col("city") != "Paris"))
    for merge_id, batch in (("0", found), ("1", calmed)):
        sinks.merge_by_key(
            batch, contracts.GOLD_PEAKS, root, contracts.AIR_METRIC_KEY, merge_id,
            keep=F.col("is_peak"))
    return _read(spark, root, contracts.GOLD_PEAKS)


def lakehouse(spark: SparkSession, sf_dir: str) -> str:
    root = work_dir(spark, "lakehouse")
    backfill.write_air(feed.raw_air(spark, sf_dir), root, "0")
    backfill.write_weather(feed.raw_weather(spark, sf_dir), root, "0")
    return root


def repeated_backfill(spark: SparkSession, sf_dir: str) -> str:
    """The lakehouse from two air batches and one weather batch, each of them loaded twice.

    Deliveries of a message and readings of a window fall into both air batches.
    """
    root = work_dir(spark, "backfill")
    records = feed.raw_air(spark, sf_dir)
    first = F.col("offset") % 3 == 0
    for merge_id, batch in (("0", records.filter(first)), ("1", records.filter(~first))):
        for _ in range(2):
            backfill.write_air(batch, root, merge_id)
    for _ in range(2):
        backfill.write_weather(feed.raw_weather(spark, sf_dir), root, "0")
    return root


def displacing_backfill(spark: SparkSession, sf_dir: str) -> str:
    """Air batches of which the second has messages of the first with other, earlier times.

    The second comes twice, and then the first once more.
    """
    root = work_dir(spark, "displaced")
    records = feed.air_records(spark, sf_dir)
    again = F.col("offset") % 2 == 1
    moved = parse.raw_envelope(feed.air_records(spark, sf_dir, moved=True))
    first = parse.raw_envelope(records.filter(~again))
    second = moved.filter(again)
    for merge_id, batch in (("0", first), ("1", second), ("1", second), ("0", first)):
        backfill.write_air(batch, root, merge_id)
    return root


def displaced(spark: SparkSession, sf_dir: str, table: contracts.TableContract) -> DataFrame:
    return _read(spark, displacing_backfill(spark, sf_dir), table)


def backfilled(spark: SparkSession, sf_dir: str, table: contracts.TableContract) -> DataFrame:
    return _read(spark, repeated_backfill(spark, sf_dir), table)


def repeated_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = f"lakehouse_{uuid.uuid4().hex}"
    catalog.register(spark, repeated_backfill(spark, sf_dir), database)
    catalog.sync_partitions(spark, database)
    return catalog.table_counts(spark, database)


def registered_database(spark: SparkSession, sf_dir: str) -> str:
    """Tables that are registered before anything is written; each batch adds its partitions."""
    database, root = f"lakehouse_{uuid.uuid4().hex}", work_dir(spark, "registered")
    catalog.register(spark, root, database)
    backfill.write_air(feed.raw_air(spark, sf_dir), root, "0", database=database)
    backfill.write_weather(feed.raw_weather(spark, sf_dir), root, "0", database=database)
    return database


def retained_counts(spark: SparkSession, sf_dir: str, now: datetime, days: int) -> DataFrame:
    """Rows of the gold tables after the expired days were dropped."""
    database = registered_database(spark, sf_dir)
    gold = (contracts.GOLD_AIR, contracts.GOLD_PEAKS, contracts.GOLD_WEATHER)
    for table in gold:
        catalog.drop_expired(spark, table, now, database, days)
    return catalog.table_counts(spark, database, gold)


_GOLD: dict[tuple[str, str], str] = {}


def gold_table(spark: SparkSession, sf_dir: str, metrics: DataFrame) -> DataFrame:
    """The metrics as a gold table by day, written once per session and read back."""
    name = (spark.sparkContext.applicationId, sf_dir)
    if name not in _GOLD:
        root = work_dir(spark, "gold")
        sinks.replace_days(windows.with_window_date(metrics), contracts.GOLD_AIR, root, [])
        _GOLD[name] = root
    return _read(spark, _GOLD[name], contracts.GOLD_AIR)


def _halves(records: DataFrame) -> list[DataFrame]:
    early = F.col("timestamp") < times.literal(CUT)
    return [records.filter(early), records.filter(~early)]


def _settings(root: str) -> queries.StreamSettings:
    return queries.StreamSettings(root, f"{root}/_checkpoints", available_now=True)


def _stream_halves(spark: SparkSession, records: DataFrame, root: str, start,
                   late_half: bool = False) -> None:
    """Writes one half of the records, runs the queries to the end, and again for the other.

    The second run resumes from the checkpoints of the first.
    """
    halves = _halves(records)
    for half in reversed(halves) if late_half else halves:
        half.write.mode("append").parquet(f"{root}/_incoming")
        queries.run_to_end(start(streams.file_stream(spark, f"{root}/_incoming")))


def _flow(spark: SparkSession, sf_dir: str, kind: str):
    if kind == "air":
        return feed.air_records(spark, sf_dir), flows.AirFlow
    return feed.weather_records(spark, sf_dir), flows.WeatherFlow


def streamed_layer(spark: SparkSession, sf_dir: str, kind: str, layer: str) -> DataFrame:
    root = work_dir(spark, f"stream-{layer}")
    records, flow = _flow(spark, sf_dir, kind)
    table = TABLES[kind, layer]

    def start(raw):
        return [queries.start_layer(getattr(flow(raw), layer), table, _settings(root))]

    _stream_halves(spark, records, root, start)
    return _read(spark, root, table)


def streamed_final_windows(spark: SparkSession, sf_dir: str, kind: str,
                           late_half: bool = False) -> DataFrame:
    """Gold of a stream in append mode: windows the watermark has closed."""
    root = work_dir(spark, "stream-windows")
    records, flow = _flow(spark, sf_dir, kind)
    table = contracts.GOLD_AIR if kind == "air" else contracts.GOLD_WEATHER

    def start(raw):
        rows = windows.with_window_date(flow(raw).metrics)
        return [queries.start_layer(rows, table, _settings(root))]

    _stream_halves(spark, records, root, start, late_half)
    return _read(spark, root, table)


def streamed_metrics(spark: SparkSession, sf_dir: str,
                     table: contracts.TableContract) -> DataFrame:
    """Gold or peaks after the complete set of air-quality queries."""
    root = work_dir(spark, "stream-metrics")
    records, flow = _flow(spark, sf_dir, "air")
    _stream_halves(
        spark, records, root, lambda raw: queries.start_air(flow(raw), _settings(root)))
    return _read(spark, root, table)


def streamed_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peaks from keyed state, week by week, both queries resumed from their checkpoints each time."""
    root = work_dir(spark, "stream-peaks")
    records, flow = _flow(spark, sf_dir, "air")
    for week in _between(records, "timestamp", WEEKS):
        week.write.mode("append").parquet(f"{root}/_incoming")
        raw = streams.file_stream(spark, f"{root}/_incoming")
        queries.run_to_end([queries.start_batches(
            flow(raw).live_metrics, AirMetricsBatch(root), "air_metrics", _settings(root))])
        queries.run_to_end([queries.start_peaks(spark, _settings(root))])
    return _read(spark, root, contracts.GOLD_PEAKS)


def _between(rows: DataFrame, column: str, cuts: Sequence[datetime]) -> list[DataFrame]:
    """The rows before the first cut, from there to the second, and so on."""
    at = [times.literal(cut) for cut in cuts]
    first = [rows.filter(F.col(column) < at[0])]
    inner = [rows.filter((F.col(column) >= a) & (F.col(column) < b)) for a, b in zip(at, at[1:])]
    return [*first, *inner, rows.filter(F.col(column) >= at[-1])]


def streamed_weather_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving table after the complete set of weather queries."""
    root = work_dir(spark, "stream-weather")
    records, flow = _flow(spark, sf_dir, "weather")
    writer = table_writer(LIVE_WEATHER, root, contracts.WEATHER_METRIC_KEY)
    _stream_halves(
        spark, records, root,
        lambda raw: queries.start_weather(flow(raw), _settings(root), writer))
    return _read(spark, root, LIVE_WEATHER)


def _changes(spark: SparkSession, batches: Sequence[DataFrame], key: Sequence[str],
             tie_break: Sequence[str], compared: Sequence[str], ttl: str, pause: float = 0) -> DataFrame:
    """Readings that the change-only stream hands on from the batches, resumed after each."""
    root = work_dir(spark, "stream-changes")
    schema = batches[0].schema

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/kept/batch={batch_id}")

    for batch in batches:
        batch.write.mode("append").parquet(f"{root}/_incoming")
        stream = spark.readStream.schema(schema).parquet(f"{root}/_incoming")
        queries.run_to_end([queries.start_changes(
            stream, write, "changes", _settings(root), key, "event_time", tie_break, compared, ttl)])
        time.sleep(pause)
    return spark.read.schema(schema).parquet(f"{root}/kept/*")


def streamed_changes(spark: SparkSession, readings: DataFrame, key: Sequence[str],
                     tie_break: Sequence[str], compared: Sequence[str]) -> DataFrame:
    """Readings handed on by two change-only streams, named by ``ttl``.

    One remembers for long: it gets the weeks one after another, each with the second deliveries of the
    week before, and in the first week a reading from the far future. The other forgets at once: it
    gets all first deliveries, and after a pause all of them again.
    """
    again = F.col("delivery") == 1
    newest = readings.groupBy().agg(F.max_by(F.struct(*readings.columns), "event_id").alias("r"))
    future = newest.select("r.*").withColumn("event_time", times.literal(FAR))
    weeks = _between(readings, "event_time", WEEKS)
    nothing = readings.filter(F.lit(False))
    batches = [week.filter(~again).unionByName(before.filter(again))
               for week, before in zip([*weeks, nothing], [nothing, *weeks])]
    batches[0] = batches[0].unionByName(future.withColumn("delivery", F.lit(0)))
    known = _changes(spark, batches, key, tie_break, compared, "1 day")
    once = readings.filter(~again)
    forgotten = _changes(spark, [once, once], key, tie_break, compared, "1 second", pause=1.5)
    return known.withColumn("ttl", F.lit("long")).unionByName(
        forgotten.withColumn("ttl", F.lit("short")))
