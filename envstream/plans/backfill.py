"""Building the lakehouse layers from raw batches.

Layers are appended once per batch id. Gold comes from silver, not from the batch alone, so batches may
share windows and messages, and a batch may be repeated. A message counts with the earliest of its
readings, whichever batch brought it. An index tells in which reading a message was met before: it is
kept in buckets by message id, and a batch opens its own buckets only. Readings that give way are
noted by their day. So a batch knows every window that it changes, also those that lose a reading, and
computes them anew from the silver readings of their days.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from envstream import contracts, rules
from envstream.functions import keys, times
from envstream.operators import dedup, peaks, windows
from envstream.plans.flows import AirFlow, WeatherFlow
from envstream.sinks import catalog
from envstream.sinks import tables as sinks
from envstream.sources import tables as sources

#: Buckets of the index of readings; a table keeps the number it began with.
BUCKETS = 32


@dataclass(frozen=True)
class Kind:
    """What a flow's gold is made of."""

    name: str
    silver: contracts.TableContract
    gold: contracts.TableContract
    series: tuple[str, ...]
    measured: tuple[str, ...]
    average: str
    dedup_key: Callable[[], Column]
    averages: Callable[[DataFrame, Sequence[str]], DataFrame]  # of readings without duplicates

    @property
    def key(self) -> list[str]:
        return ["window_start", "window_end", *self.series, "window_duration"]

    @property
    def index(self) -> contracts.TableContract:
        return contracts.reading_index(self.name, ", ".join(f"{c} string" for c in self.series))

    @property
    def displaced(self) -> contracts.TableContract:
        return contracts.displaced_readings(self.name)


def _air_averages(rows: DataFrame, durations: Sequence[str]) -> DataFrame:
    return windows.with_status(windows.air_averages(rows, durations))


AIR = Kind(
    "air", contracts.SILVER_AIR, contracts.GOLD_AIR, ("city", "parameter"), ("value",),
    "rolling_avg", keys.air_dedup_key, _air_averages)
WEATHER = Kind(
    "weather", contracts.SILVER_WEATHER, contracts.GOLD_WEATHER, ("city",),
    ("source", "temperature_c", "humidity_pct", "wind_speed_ms"), "avg_temperature",
    keys.weather_dedup_key, windows.weather_averages)


def _around(days: Sequence[str], durations: Sequence[str]) -> list[str]:
    """The days and those that a window over one of them may reach into."""
    reach = -(-max(map(times.duration_seconds, durations)) // 86_400)
    return sorted({str(date.fromisoformat(day) + timedelta(days=step))
                   for day in days for step in range(-reach, reach + 1)})


def _values(rows: DataFrame, column: str) -> list[str]:
    return [row[0] for row in rows.select(F.col(column).cast("string")).distinct().collect()]


def _displaced_readings(batch: DataFrame, kind: Kind, root: str, merge_id: str) -> DataFrame | None:
    """Time and series of readings that the batch displaces, held, if any; updates index and notes.

    ``batch`` has the named readings' ``dedup_key``, and null for others: these are told by their time,
    so they displace nothing. Times alone are compared over the whole index, by key. Readings are looked
    up for keys of several times only, which are few or none, so that mostly no other shuffle is needed.
    """
    spark = batch.sparkSession
    place = ["event_time", *kind.series]
    bucket = F.pmod(F.xxhash64("dedup_key"), F.lit(BUCKETS)).cast("int")
    named = batch.filter(F.col("dedup_key").isNotNull())
    first = named.groupBy("dedup_key", *kind.series).agg(F.min("event_time").alias("event_time"))
    sinks.append_layer(first.withColumn("bucket", bucket), kind.index, root, merge_id)
    buckets = _values(named.select(bucket.alias("bucket")), "bucket")  # at most BUCKETS
    known = sources.read_folders(spark, f"{root}/{kind.index.location}", kind.index, buckets)
    every = known.select("dedup_key", *place, F.lit(False).alias("_brought")).unionByName(
        named.select("dedup_key", *place, F.lit(True).alias("_brought")))
    earliest = every.groupBy("dedup_key").agg(
        F.min("event_time").alias("earliest"), F.max("event_time").alias("_latest"),
        F.max("_brought").alias("_brought"))
    moved = earliest.filter(F.col("_brought") & (F.col("earliest") < F.col("_latest"))).select(
        "dedup_key", "earliest").persist()
    # Counted first, so that the size of what is held decides how the readings are looked up.
    if moved.count() == 0:
        moved.unpersist()
        return None
    lost = every.join(moved, "dedup_key").filter(F.col("event_time") > F.col("earliest")).select(
        "dedup_key", *place).distinct().persist()
    sinks.append_layer(
        lost.select("dedup_key", "event_time", F.to_date("event_time").alias("event_date")).distinct(),
        kind.displaced, root, merge_id)
    moved.unpersist()
    return lost


def counting_readings(readings: DataFrame, gone: DataFrame, key: Column) -> DataFrame:
    """The earliest of the readings of every key, unless it is among those that are gone.

    All readings of a message but its earliest are gone, and all gone ones of a day lie among the readings
    of the day. So when the earliest at hand is gone, the later ones are too, and one aggregate does
    for both.
    """
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in readings.schema.fields
               if f.name != "event_time"]
    both = readings.select("*", key.alias("_key"), F.lit(True).alias("_there")).unionByName(
        gone.select("event_time", *nothing, F.col("dedup_key").alias("_key"), F.lit(False).alias("_there")))
    first = dedup.earliest_by(both, ["_key"], F.col("event_time"), F.col("_there"))
    return first.filter("_there").select(*readings.columns)


def _touched_windows(readings: DataFrame, kind: Kind, durations: Sequence[str]) -> DataFrame:
    """Keys and days of the windows that the readings fall into, in all lengths."""
    return windows.with_window_date(
        windows.windows_of(readings, durations, kind.series).select(*kind.key)).distinct()


def _write_gold(silver: DataFrame, kind: Kind, root: str, merge_id: str,
                durations: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Merges all windows that a batch of silver readings changes; returns their keys and days."""
    spark = silver.sparkSession
    has_id = F.length(F.coalesce("message_id", F.lit(""))) > 0
    batch = silver.select("event_time", *kind.series, F.when(has_id, kind.dedup_key()).alias("dedup_key"))
    lost = _displaced_readings(batch, kind, root, merge_id)
    changed = batch if lost is None else batch.unionByName(lost)
    touched = _touched_windows(changed, kind, durations).persist()
    days = _values(touched, "window_date")
    if lost is not None:
        lost.unpersist()
    read = _around(days, durations)
    readings = sources.read_folders(spark, f"{root}/{kind.silver.location}", kind.silver, read)
    gone = sources.read_folders(spark, f"{root}/{kind.displaced.location}", kind.displaced, read)
    count = counting_readings(
        readings.select("event_time", "message_id", *kind.series, *kind.measured), gone, kind.dedup_key())
    found = kind.averages(count, durations)
    # A window that lost its last reading has no averages, and leaves.
    revised = touched.join(found, kind.key, "left")
    sinks.merge_by_key(
        revised, kind.gold, root, kind.key, merge_id, keep=F.col(kind.average).isNotNull())
    return touched, days


def _write_peaks(touched: DataFrame, days: list[str], root: str, merge_id: str) -> None:
    """Compares the windows of the touched days again, and the first one after them per series.

    Of other days only the first and last windows are read, from a table of their own.
    """
    spark = touched.sparkSession
    key = list(contracts.AIR_METRIC_KEY)
    gold = sources.read_folders(spark, f"{root}/{contracts.GOLD_AIR.location}", contracts.GOLD_AIR, days)
    sinks.replace_days(peaks.window_ends(gold), contracts.WINDOW_ENDS_AIR, root, days)
    found = windows.with_window_date(peaks.peaks_of_changes(peaks.with_neighbours(
        gold, window_ends(spark, root, days))))
    emptied = touched.join(gold.select(*key), key, "left_anti")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in contracts.GOLD_PEAKS.schema.fields
               if f.name not in (*key, "window_date")]
    sinks.merge_by_key(
        found.unionByName(emptied.select(*key, "window_date", *nothing)), contracts.GOLD_PEAKS, root, key,
        merge_id, keep=F.col("is_peak"))


def window_ends(spark: SparkSession, root: str, days: Sequence[str]) -> DataFrame:
    """First and last windows of every series on each day but the given ones."""
    ends = contracts.WINDOW_ENDS_AIR
    others = ~F.col("window_date").isin([date.fromisoformat(day) for day in days])
    return sources.read_or_empty(spark, f"{root}/{ends.location}", ends.schema, others)


def _write(silver: DataFrame, kind: Kind, root: str, merge_id: str, durations: Sequence[str],
           database: str | None) -> None:
    touched, days = _write_gold(silver, kind, root, merge_id, durations)
    tables = [kind.gold]
    if days and kind is AIR:
        _write_peaks(touched, days, root, merge_id)
        tables.append(contracts.GOLD_PEAKS)
    if database is not None:
        for table in tables:
            kept = sources.read_folders(silver.sparkSession, f"{root}/{table.location}", table, days)
            catalog.add_partitions(kept, table, database)
    touched.unpersist()


@contextmanager
def _appended(flow: AirFlow | WeatherFlow, tables: Sequence[contracts.TableContract], root: str,
              merge_id: str, database: str | None) -> Iterator[DataFrame]:
    """Appends bronze, rejects and silver; gives the silver rows, held until the end.

    Messages are parsed once, and held without the text of those that are no rejects. Nothing reads
    bronze and rejects here, so they are written beside what is made of silver; rejects wait until silver
    has filled what is held. Both are complete, or their error is raised, when the block ends.
    """
    def append(rows: DataFrame, table: contracts.TableContract) -> None:
        sinks.append_layer(rows, table, root, merge_id)
        if database is not None:
            catalog.add_partitions(rows, table, database, merge_id)

    bronze, rejects, silver = tables
    held = [flow.hold_parsed()]
    if flow.silver_dedup:
        held.append(flow.silver.persist())
    run = inheritable_thread_target(flow.bronze.sparkSession)(append)
    try:
        with ThreadPoolExecutor(2) as beside:
            others = [beside.submit(run, flow.bronze, bronze)]
            append(flow.silver, silver)
            others.append(beside.submit(run, flow.rejects, rejects))
            yield flow.silver
        for other in others:
            other.result()
    finally:
        for rows in held:
            rows.unpersist()


def write_air(raw: DataFrame, root: str, merge_id: str,
              durations: Sequence[str] = rules.WINDOW_DURATIONS, database: str | None = None) -> None:
    """Bronze, rejects, silver, metrics and peaks of one raw batch.

    Windows that are no peaks any more, or have no readings any more, leave their tables. New
    partitions are added to the tables of ``database``, if one is given.
    """
    with _appended(AirFlow(raw), (
            contracts.BRONZE_AIR, contracts.REJECTS_AIR, contracts.SILVER_AIR), root, merge_id,
            database) as silver:
        _write(silver, AIR, root, merge_id, durations, database)


def write_weather(raw: DataFrame, root: str, merge_id: str,
                  durations: Sequence[str] = rules.WINDOW_DURATIONS, database: str | None = None) -> None:
    """Bronze, rejects, silver and metrics of one raw batch.

    Silver holds no duplicates within a batch.
    """
    with _appended(WeatherFlow(raw), (
            contracts.BRONZE_WEATHER, contracts.REJECTS_WEATHER, contracts.SILVER_WEATHER), root, merge_id,
            database) as silver:
        _write(silver, WEATHER, root, merge_id, durations, database)
