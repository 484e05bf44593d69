"""The registered queries: each runs an operator of the library over a whole driver table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from checks import feed, runs
from envstream import contracts, rules
from envstream.functions import keys, text, times, units
from envstream.operators import (
    audit, dedup, parse, peaks, providers, quality, series, serving, windows,
)
from envstream.plans import flows
from envstream.session import work_dir
from envstream.sinks import catalog, messages
from envstream.sinks import metrics as prepare
from envstream.sources import payloads, tables

Query = Callable[[SparkSession, str], DataFrame]

NOW = datetime(2024, 1, 15, 12)
MIDDLE = datetime(2024, 1, 16)
REJECTED_AT = datetime(2024, 2, 1)
COARSE = ("6 hours", "1 day")
PANEL = serving.PanelFilter(datetime(2024, 1, 1), NOW)
NARROW = serving.PanelFilter(
    datetime(2024, 1, 1), NOW, city="^(par|LON)", parameter="pm", window_duration="^10",
    status="danger")
EMPTY = serving.PanelFilter(datetime(2025, 1, 1), datetime(2025, 1, 2))
READING_KEY = ("country", "city", "parameter")

QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def comparable(rows: DataFrame) -> DataFrame:
    """Timestamps without zone and numbers rounded, so that other engines compare equal.

    Engines differ in how they round a number halfway between two others, and averages of decimal
    readings often lie there. The shift before rounding moves them off; it is too small to change
    a number that needs no rounding.
    """
    def shown(name: str, kind) -> Column:
        if isinstance(kind, TimestampType):
            return F.col(name).cast("timestamp_ntz").alias(name)
        if kind.simpleString() == "double":
            return F.round(F.col(name) + 1.23456e-9, 8).alias(name)
        return F.col(name)

    return rows.select(*[shown(f.name, f.dataType) for f in rows.schema.fields])


# Readings and metrics the queries below start from.

def clean_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.plausible_air(feed.observations(spark, sf_dir))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.with_status(windows.air_averages(clean_readings(spark, sf_dir)))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics as panels find them: a written table, partitioned by day."""
    return runs.gold_table(spark, sf_dir, metrics(spark, sf_dir))


def weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feed.observations(spark, sf_dir)
    fields = {**feed.weather_fields(), "humidity_unit": F.lit("%"), "humidity": F.col("k")}
    return parse.normalize_units(rows.select(
        "event_id", "event_time", "city", *[c.alias(n) for n, c in fields.items()]))


def readings_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as delivered, some of them twice in a row."""
    rows = feed.observations(spark, sf_dir)
    twice = F.sequence(F.lit(0), F.when(F.col("event_id") % 10 == 0, 1).otherwise(0))
    return rows.withColumn("delivery", F.explode(twice)).select(
        "country", "city", "parameter", "event_time", "value", "event_id", "delivery")


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every metric row up to three times, as written by successive batches."""
    count = F.minute("window_start") / 5 % 3
    revision = F.explode(F.sequence(F.lit(0), count.cast("int")))
    return metrics(spark, sf_dir).withColumn("revision", revision).withColumns({
        "rolling_avg": F.col("rolling_avg") + F.col("revision"),
        "ingested_at": F.timestamp_micros(
            F.unix_micros("window_end") + F.col("revision").cast("bigint") * 60_000_000)})


# Sources and parsing.

@registered
def raw_envelope(spark, sf_dir):
    return comparable(feed.raw_air(spark, sf_dir))


@registered
def scan_parquet(spark, sf_dir):
    feed.events(spark, sf_dir)
    return tables.read_columns(spark, f"{sf_dir}/events.parquet", "event_id", "event_type")


@registered
def scan_empty(spark, sf_dir):
    """First run: the state table does not exist yet, so the merge returns the new state."""
    newer = peaks.latest_state(metrics(spark, sf_dir))
    missing = tables.read_or_empty(spark, work_dir(spark, "state"), contracts.PEAK_STATE)
    return comparable(peaks.merge_state(missing, newer))


@registered
def parsed_air(spark, sf_dir):
    parsed = parse.parse_air(feed.raw_air(spark, sf_dir))
    return comparable(parsed.select(
        "corrupt_record", "event_time_raw", "event_time", "country", "city", "parameter",
        "value", "location_id", "message_id"))


@registered
def parsed_weather(spark, sf_dir):
    parsed = parse.parse_weather(feed.raw_weather(spark, sf_dir))
    return comparable(parsed.select(
        "corrupt_record", "event_time_raw", "event_time", "city", "temperature",
        "temperature_unit", "wind_speed", "wind_unit", "humidity", "humidity_unit",
        "temperature_c", "wind_speed_ms", "humidity_pct", "message_id"))


@registered
def unit_conversion(spark, sf_dir):
    rows = weather_rows(spark, sf_dir)
    known = units.has_known_units(
        F.col("temperature_unit"), F.col("wind_unit"), F.col("humidity_unit"))
    return comparable(rows.select(
        "event_id", "temperature_c", "wind_speed_ms", "humidity_pct", known.alias("known_units")))


# Quality.

@registered
def rejects_air(spark, sf_dir):
    parsed = parse.parse_air(feed.raw_air(spark, sf_dir))
    return comparable(quality.air_rejects(parsed, REJECTED_AT))


@registered
def rejects_weather(spark, sf_dir):
    parsed = parse.parse_weather(feed.raw_weather(spark, sf_dir))
    return comparable(quality.weather_rejects(parsed, REJECTED_AT))


@registered
def rejects_strict(spark, sf_dir):
    parsed = parse.parse_weather(feed.raw_weather(spark, sf_dir))
    rows = quality.weather_rejects(parsed, REJECTED_AT, strict=True, strict_units=True)
    return rows.groupBy("reject_reason").agg(F.count("*").alias("rows"))


@registered
def silver_air(spark, sf_dir):
    silver = flows.AirFlow(feed.raw_air(spark, sf_dir)).silver
    return comparable(silver.select(
        "message_id", "event_time", "country", "city", "parameter", "value", "location_id",
        "event_date"))


@registered
def silver_weather(spark, sf_dir):
    silver = flows.WeatherFlow(feed.raw_weather(spark, sf_dir)).silver
    return comparable(silver.select(
        "message_id", "event_time", "city", "temperature_c", "humidity_pct", "wind_speed_ms",
        "event_date"))


@registered
def dispositions_air(spark, sf_dir):
    parsed = parse.parse_air(feed.raw_air(spark, sf_dir))
    return quality.count_dispositions(quality.air_disposition(parsed))


@registered
def dispositions_weather(spark, sf_dir):
    parsed = parse.parse_weather(feed.raw_weather(spark, sf_dir))
    return quality.count_dispositions(quality.weather_disposition(parsed))


@registered
def contract_check(spark, sf_dir):
    rows = audit.contract_violations(feed.raw_air(spark, sf_dir), contracts.AIR_MESSAGE_KINDS)
    return rows.select("offset", F.array_join("violations", ",").alias("violations"))


@registered
def dedup_air(spark, sf_dir):
    usable = quality.usable_air(parse.parse_air(feed.raw_air(spark, sf_dir)))
    return comparable(dedup.dedup_air(usable).select(
        "message_id", "city", "parameter", "event_time", "value"))


@registered
def dedup_weather(spark, sf_dir):
    usable = quality.usable_weather(parse.parse_weather(feed.raw_weather(spark, sf_dir)))
    return comparable(dedup.dedup_weather(usable).select(
        "message_id", "city", "event_time", "temperature_c", "wind_speed_ms"))


# Windows, status and peaks.

@registered
def air_metrics(spark, sf_dir):
    """The whole air-quality flow: parse, reject, deduplicate, average, classify."""
    return comparable(flows.AirFlow(feed.raw_air(spark, sf_dir)).metrics)


@registered
def weather_metrics(spark, sf_dir):
    return comparable(flows.WeatherFlow(feed.raw_weather(spark, sf_dir)).metrics)


@registered
def win_air(spark, sf_dir):
    return comparable(windows.air_averages(clean_readings(spark, sf_dir), ("5 minutes",)))


@registered
def win_multi(spark, sf_dir):
    return comparable(windows.air_averages(clean_readings(spark, sf_dir), COARSE))


@registered
def win_weather(spark, sf_dir):
    rows = quality.plausible_weather(weather_rows(spark, sf_dir))
    return comparable(windows.weather_averages(rows, COARSE))


@registered
def status_levels(spark, sf_dir):
    coarse = windows.air_averages(clean_readings(spark, sf_dir), COARSE)
    return comparable(windows.with_status(coarse))


@registered
def peak_detection(spark, sf_dir):
    return comparable(peaks.detect_peaks(metrics(spark, sf_dir)))


@registered
def peaks_with_state(spark, sf_dir):
    """Second half of the time, with the state the first half left behind."""
    rows = metrics(spark, sf_dir)
    before = F.col("window_start") < times.literal(MIDDLE)
    state = peaks.latest_state(rows.filter(before))
    return comparable(peaks.detect_peaks(rows.filter(~before), state))


@registered
def latest_state(spark, sf_dir):
    return comparable(peaks.latest_state(metrics(spark, sf_dir)))


@registered
def state_merge(spark, sf_dir):
    rows = metrics(spark, sf_dir)
    before = F.col("window_start") < times.literal(MIDDLE)
    older = peaks.latest_state(rows)
    newer = peaks.latest_state(rows.filter(before)).withColumn(
        "prev_rolling_avg", F.col("prev_rolling_avg") + 1)
    return comparable(peaks.merge_state(older, newer))


@registered
def keep_latest(spark, sf_dir):
    rows = dedup.latest_by(
        revisions(spark, sf_dir), contracts.AIR_METRIC_KEY, F.col("ingested_at"))
    return comparable(rows)


# Serving.

@registered
def active_danger(spark, sf_dir):
    return serving.active_count(gold(spark, sf_dir), PANEL, "DANGER")


@registered
def active_warning(spark, sf_dir):
    return serving.active_count(gold(spark, sf_dir), PANEL, "WARNING")


@registered
def cities_impacted(spark, sf_dir):
    return serving.cities_impacted(gold(spark, sf_dir), PANEL)


@registered
def worst_offender(spark, sf_dir):
    return comparable(serving.worst_offender(gold(spark, sf_dir), PANEL))


@registered
def worst_offender_default(spark, sf_dir):
    return comparable(serving.worst_offender(gold(spark, sf_dir), EMPTY))


@registered
def recent_alerts(spark, sf_dir):
    return comparable(serving.recent_alerts(gold(spark, sf_dir), PANEL))


@registered
def active_pairs(spark, sf_dir):
    return serving.active_pairs(gold(spark, sf_dir), PANEL)


@registered
def top_offenders(spark, sf_dir):
    return serving.top_offenders(gold(spark, sf_dir), PANEL)


@registered
def top_offenders_filtered(spark, sf_dir):
    return serving.top_offenders(gold(spark, sf_dir), NARROW)


@registered
def last_danger(spark, sf_dir):
    return comparable(serving.last_danger(gold(spark, sf_dir), PANEL))


@registered
def status_trend(spark, sf_dir):
    return comparable(serving.status_trend(gold(spark, sf_dir), PANEL, "6 hours"))


@registered
def filter_values(spark, sf_dir):
    return serving.filter_choices(gold(spark, sf_dir))


@registered
def bi_average(spark, sf_dir):
    return comparable(serving.average_by_city_and_parameter(
        gold(spark, sf_dir), rules.BI_ROW_LIMIT))


@registered
def preview_latest(spark, sf_dir):
    return comparable(serving.latest_windows(gold(spark, sf_dir).drop("window_date")))


@registered
def preview_peaks(spark, sf_dir):
    return comparable(serving.latest_peaks(peaks.detect_peaks(metrics(spark, sf_dir))))


@registered
def city_join(spark, sf_dir):
    rows = gold(spark, sf_dir)
    # The first two cities move by the number of their windows; the third keeps its place.
    moved = rows.filter(F.col("city") != "Paris").groupBy("city").agg(
        F.count("*").cast("double").alias("latitude"), F.lit(0.5).alias("longitude"))
    joined = serving.with_coordinates(rows, tables.city_dimension(spark, moved))
    return comparable(joined.groupBy("city", "latitude", "longitude").agg(
        F.count("*").alias("rows"), F.max("rolling_avg").alias("highest")))


@registered
def retention(spark, sf_dir):
    return comparable(serving.within_retention(gold(spark, sf_dir), MIDDLE, days=7).drop("window_date"))


@registered
def serving_rows(spark, sf_dir):
    """Rows as a serving table takes them: complete, typed, one per natural key."""
    rows = revisions(spark, sf_dir).withColumn(
        "status", F.when(F.col("parameter") != "o3", F.col("status")))
    return comparable(prepare.prepare_air(rows))


# Audits.

@registered
def constraints(spark, sf_dir):
    rows = windows.with_status(windows.air_averages(
        feed.observations(spark, sf_dir), ("5 minutes", "1 day")))
    return audit.audit_constraints(rows, audit.domain_rules("air"))


@registered
def dup_keys(spark, sf_dir):
    return audit.duplicate_keys(revisions(spark, sf_dir), contracts.AIR_METRIC_KEY)


@registered
def nonempty(spark, sf_dir):
    rows = metrics(spark, sf_dir)
    weather = windows.weather_averages(quality.plausible_weather(weather_rows(spark, sf_dir)))
    return audit.row_counts({"air_quality_metrics": rows, "weather_metrics": weather})


# Ingestion.

@registered
def message_id(spark, sf_dir):
    rows = feed.observations(spark, sf_dir)
    parts = [F.col(c) for c in ("user_id", "parameter", "message_id", "k")]
    return rows.select("event_id", keys.content_id(*parts).alias("content_id"))


@registered
def recency(spark, sf_dir):
    items = providers.latest_items(feed.latest_responses(spark, sf_dir))
    messages_ = items.select("location_id", providers.reading_time_text().alias("event_time"))
    return providers.recent_only(messages_, NOW)


@registered
def change_only(spark, sf_dir):
    rows = series.change_only(
        readings_twice(spark, sf_dir), READING_KEY, "event_time", ["event_id", "delivery"],
        ["event_time", "value"])
    return comparable(rows)


@registered
def change_only_interleaved(spark, sf_dir):
    """Few contents per series and day, in turn, so that equal ones do not lie side by side."""
    rows = readings_twice(spark, sf_dir).withColumns({
        "event_time": F.date_trunc("day", "event_time"),
        "value": F.pmod(F.floor("value"), F.lit(3)).cast("double")})
    return comparable(series.change_only(
        rows, READING_KEY, "event_time", ["event_id", "delivery"], ["event_time", "value"]))


@registered
def message_id_numbers(spark, sf_dir):
    """Ids of doubles from 1e-8 to 1e20."""
    digits = F.concat((F.col("event_id") % 997 + 1).cast("string"), F.lit("e"), (F.col(
        "event_id") % 27 - 9).cast("string"))
    number = digits.cast("double")
    return feed.observations(spark, sf_dir).select(
        "event_id", keys.content_id(F.col("parameter"), number).alias("content_id"))


@registered
def ingestion_counters(spark, sf_dir):
    marked = series.mark_repeats(
        readings_twice(spark, sf_dir), READING_KEY, "event_time", ["event_id", "delivery"],
        ["event_time", "value"])
    rows = marked.withColumn("event_time", F.when(
        F.col("event_id") % 40 != 5, F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    rows = providers.ingestion_disposition(rows, NOW, F.col("repeated"))
    return quality.count_dispositions(rows)


@registered
def capacity_trim(spark, sf_dir):
    entries = feed.observations(spark, sf_dir).select(
        "user_id", "parameter", F.col("event_time").alias("updated_at"), "event_id")
    return comparable(providers.newest_keys(entries, MIDDLE, rules.CHANGE_STATE_CAPACITY))


@registered
def raw_payloads(spark, sf_dir):
    """Forecast responses stored as JSON lines and read back."""
    path = work_dir(spark, "payloads")
    feed.forecast_responses(spark, sf_dir).write.json(path)
    stored = payloads.responses(spark, path, payloads.WEATHER_RESPONSES)
    parsed = stored.select(
        "country", "city", F.from_json("body", contracts.FORECAST_PAYLOAD).alias("p"))
    return parsed.select(
        "country", "city", F.col("p.current.time").alias("time"),
        F.col("p.current.temperature_2m").alias("temperature_2m"),
        F.col("p.current_units.temperature_2m").alias("temperature_unit"))


@registered
def payload_times(spark, sf_dir):
    items = providers.latest_items(feed.latest_responses(spark, sf_dir))
    return items.select("location_id", "value", providers.reading_time_text().alias("event_time"))


@registered
def city_match(spark, sf_dir):
    rows = feed.observations(spark, sf_dir)
    place = F.concat(
        F.element_at(F.array(*[F.lit(n) for n in feed.PLACE_NAMES]),
                     (F.col("user_id") % 10 + 1).cast("int")), F.lit(" "), F.col("parameter"))
    return rows.groupBy(place.alias("place")).agg(F.count("*").alias("rows")).withColumn(
        "cities", F.array_join(text.matched_cities(
            F.col("place"), ["Berlin", "London", "Paris"]), ","))


def _stations(spark, sf_dir):
    return providers.stations(feed.station_responses(spark, sf_dir))


@registered
def best_location(spark, sf_dir):
    best = providers.best_stations(providers.city_stations(_stations(spark, sf_dir)))
    return comparable(best.select("country", "target_city", "id", "last_reported"))


@registered
def sensor_lookup(spark, sf_dir):
    return providers.sensor_parameters(_stations(spark, sf_dir))


@registered
def payload_air(spark, sf_dir):
    chosen = providers.city_stations(_stations(spark, sf_dir))
    items = providers.latest_items(feed.latest_responses(spark, sf_dir))
    rows = providers.air_messages(items, chosen, REJECTED_AT)
    return comparable(rows.drop("schema_version", "pipeline", "pipeline_version"))


@registered
def ingest_air(spark, sf_dir):
    """Messages of the best station of every country and city."""
    rows = flows.air_ingestion(
        feed.station_responses(spark, sf_dir), feed.latest_responses(spark, sf_dir), REJECTED_AT)
    return comparable(rows.select(
        "country", "city", "location_id", "sensor_id", "parameter", "value", "event_time"))


@registered
def payload_forecast(spark, sf_dir):
    rows = providers.forecast_messages(feed.forecast_responses(spark, sf_dir), REJECTED_AT)
    return comparable(rows.drop("message_id", "schema_version", "pipeline", "pipeline_version"))


@registered
def payload_observation(spark, sf_dir):
    rows = providers.observation_messages(feed.observation_responses(spark, sf_dir), REJECTED_AT)
    return comparable(rows.drop("schema_version", "pipeline", "pipeline_version"))


@registered
def publish_air(spark, sf_dir):
    rows = feed.observations(spark, sf_dir).select(
        "country", "city", "parameter", "value", "message_id",
        F.when(F.col("event_id") % 3 == 0, F.col("k")).alias("sensor_id"))
    return messages.air_records(rows)


@registered
def publish_weather(spark, sf_dir):
    rows = feed.observations(spark, sf_dir).select(
        F.when(F.col("event_id") % 9 != 0, F.col("city")).alias("city"),
        F.lit("feed").alias("source"), F.col("k").alias("humidity"))
    return messages.weather_records(rows)


# Tables, catalog and streams. Each writes to a fresh folder and returns what a reader sees.

@registered
def gold_merge(spark, sf_dir):
    return comparable(runs.overlapping_merges(spark, metrics(spark, sf_dir), MIDDLE))


@registered
def peaks_merge(spark, sf_dir):
    return comparable(runs.merged_peaks(spark, metrics(spark, sf_dir)))


@registered
def layers(spark, sf_dir):
    return audit.layer_presence(spark, runs.lakehouse(spark, sf_dir))


@registered
def catalog_counts(spark, sf_dir):
    return catalog.table_counts(spark, runs.registered_database(spark, sf_dir))


@registered
def backfill_two_batches(spark, sf_dir):
    """Averages of windows whose readings came in two batches, each loaded twice."""
    return comparable(runs.backfilled(spark, sf_dir, contracts.GOLD_AIR))


@registered
def backfill_peaks(spark, sf_dir):
    return comparable(runs.backfilled(spark, sf_dir, contracts.GOLD_PEAKS))


@registered
def backfill_displaced(spark, sf_dir):
    """Averages where a later batch has messages of an earlier one with earlier times."""
    return comparable(runs.displaced(spark, sf_dir, contracts.GOLD_AIR))


@registered
def backfill_displaced_peaks(spark, sf_dir):
    return comparable(runs.displaced(spark, sf_dir, contracts.GOLD_PEAKS))


@registered
def backfill_retry(spark, sf_dir):
    """Rows of every layer after each batch was loaded twice."""
    return runs.repeated_counts(spark, sf_dir)


@registered
def retention_drop(spark, sf_dir):
    """Rows left in the gold tables once the days before the last week were dropped."""
    return runs.retained_counts(spark, sf_dir, MIDDLE, 7)


@registered
def inferred_schema(spark, sf_dir):
    """Columns of the peaks table as found in its files, next to its row count."""
    root = runs.lakehouse(spark, sf_dir)
    path = f"{root}/{contracts.GOLD_PEAKS.location}"
    found = catalog.infer_schema(spark, path, contracts.GOLD_PEAKS.schema)
    rows = audit.row_counts({"peaks": spark.read.parquet(path)}).select("rows")
    names = F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString())
                 .alias("data_type")) for f in found.fields]))
    return rows.select("rows", names.alias("c")).select("c.column_name", "c.data_type", "rows")


@registered
def stream_bronze(spark, sf_dir):
    return comparable(runs.streamed_layer(spark, sf_dir, "air", "bronze"))


@registered
def stream_silver(spark, sf_dir):
    rows = runs.streamed_layer(spark, sf_dir, "air", "silver")
    return comparable(rows.select(
        "message_id", "event_time", "city", "parameter", "value", "event_date"))


@registered
def stream_silver_weather(spark, sf_dir):
    rows = runs.streamed_layer(spark, sf_dir, "weather", "silver")
    return comparable(rows.select(
        "message_id", "event_time", "city", "temperature_c", "wind_speed_ms", "event_date"))


@registered
def stream_rejects(spark, sf_dir):
    rows = runs.streamed_layer(spark, sf_dir, "air", "rejects")
    return comparable(rows.drop("rejected_at", "reject_date"))


@registered
def stream_rejects_weather(spark, sf_dir):
    rows = runs.streamed_layer(spark, sf_dir, "weather", "rejects")
    return comparable(rows.drop("rejected_at", "reject_date"))


@registered
def stream_win_air(spark, sf_dir):
    return comparable(runs.streamed_final_windows(spark, sf_dir, "air"))


@registered
def stream_win_weather(spark, sf_dir):
    return comparable(runs.streamed_final_windows(spark, sf_dir, "weather"))


@registered
def stream_late(spark, sf_dir):
    """The later half arrives first, so the earlier half is late and dropped."""
    return comparable(runs.streamed_final_windows(spark, sf_dir, "air", late_half=True))


@registered
def stream_update(spark, sf_dir):
    return comparable(runs.streamed_metrics(spark, sf_dir, contracts.GOLD_AIR))


@registered
def stream_peaks(spark, sf_dir):
    """Four weeks as four micro-batches and more; state goes on from one to the next."""
    return comparable(runs.streamed_peaks(spark, sf_dir))


@registered
def stream_update_weather(spark, sf_dir):
    return comparable(runs.streamed_weather_serving(spark, sf_dir))


@registered
def stream_change_only(spark, sf_dir):
    rows = readings_twice(spark, sf_dir)
    return comparable(runs.streamed_changes(
        spark, rows, READING_KEY, ["event_id", "delivery"], ["event_time", "value"]))
