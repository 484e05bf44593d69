"""Raw provider payloads to canonical messages.

Payload fields that may be an object or a scalar are read as JSON text, so one schema covers both
forms. As in the providers' own conventions, an empty text counts as missing in a fallback chain.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream import contracts, rules
from envstream.functions import keys, text, times, units
from envstream.operators import dedup

_NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"


def _is_object(column: Column) -> Column:
    return F.coalesce(F.startswith(column, F.lit("{")), F.lit(False))


def _first_text(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def _path(column: Column | str, path: str) -> Column:
    return F.get_json_object(column, path)


def number_or_null(column: Column) -> Column:
    return F.when(column.rlike(_NUMBER), column.try_cast("double"))


def explode_results(responses: DataFrame, schema, *carried: str) -> DataFrame:
    """One row per element of ``results`` in every response body."""
    body = F.from_json("body", f"results array<{schema.simpleString()}>")
    return (
        responses.select(*carried, body.alias("parsed"))
        .select(*carried, F.explode("parsed.results").alias("item"))
        .select(*carried, "item.*")
    )


def stations(responses: DataFrame) -> DataFrame:
    """Stations of location responses (``country``, ``body``)."""
    return explode_results(responses, contracts.STATION_PAYLOAD, "country")


def latest_items(responses: DataFrame) -> DataFrame:
    """Readings of latest-value responses (``location_id``, ``body``)."""
    return explode_results(responses, contracts.LATEST_PAYLOAD, "location_id")


def place_name(locality: Column, city: Column, name: Column) -> Column:
    return _first_text(locality, city, name)


def city_stations(all_stations: DataFrame,
                  cities: Sequence[str] = tuple(c for c, *_ in rules.CITIES)) -> DataFrame:
    """Stations with sensors whose place name belongs to a target city, as ``target_city``."""
    place = place_name(F.col("locality"), F.col("city"), F.col("name"))
    return (
        all_stations.filter(F.size("sensors") > 0)
        .withColumn("target_city", F.explode(text.matched_cities(place, cities)))
    )


def best_stations(candidates: DataFrame) -> DataFrame:
    """The station of each country and city that reported last; never-reported ones come last.

    Ties go to the station with the smallest id.
    """
    reported = times.parse_provider_time(_path("datetimeLast", "$.utc"))
    ranked = candidates.withColumn("last_reported", reported)
    smallest_id_first = -F.coalesce(F.col("id").try_cast("bigint"), F.lit(0))
    return dedup.latest_by(
        ranked, ["country", "target_city"], F.col("last_reported"), smallest_id_first)


def with_readings(candidates: DataFrame, items: DataFrame) -> DataFrame:
    """Stations that sent at least one reading.

    The readings shrink to one row per station before the shuffle, however many one station has.
    """
    sent = items.select(F.col("location_id").alias("id")).distinct()
    return candidates.join(sent, "id", "left_semi")


def sensor_parameters(all_stations: DataFrame) -> DataFrame:
    """One row per station and sensor with the pollutant it measures, as first listed."""
    sensors = all_stations.select(
        F.col("id").alias("location_id"), F.posexplode("sensors").alias("position", "sensor"))
    flat = sensors.filter(F.col("sensor.parameter").isNotNull()).select(
        "position", "location_id", F.col("sensor.id").alias("sensor_id"),
        F.col("sensor.parameter.name").alias("sensor_parameter"),
        F.col("sensor.parameter.units").alias("sensor_unit"),
        F.col("sensor.parameter.id").alias("sensor_parameter_id"))
    return dedup.earliest_by(
        flat, ["location_id", "sensor_id"], F.col("position")).drop("position")


def reading_time_text() -> Column:
    """Time of a latest-value item from the first field that carries one."""
    moment, day = F.col("datetime"), F.col("date")
    later_fields = F.coalesce(
        _first_text(_path("datetimeLast", "$.utc")),
        _first_text(_path("period", "$.datetimeTo.utc")),
        _first_text(_path("period", "$.datetimeFrom.utc")),
        F.when(_is_object(day), _first_text(_path(day, "$.utc"), _path(day, "$.local")))
        .otherwise(_first_text(F.col("date_utc"), F.col("lastUpdated"), day)),
    )
    return (
        F.when(_is_object(moment), _first_text(_path(moment, "$.utc"), _path(moment, "$.local")))
        .when(moment.isNotNull(), moment)
        .otherwise(later_fields)
    )


def _read_item(items: DataFrame) -> DataFrame:
    """Own fields of a latest-value item, before any lookup."""
    parameter = F.col("parameter")
    described = _is_object(parameter)
    sensor = _first_text(F.col("sensorsId"), F.col("sensorId"), F.col("sensor_id"))
    nested_sensor = _first_text(_path("sensor", "$.id"), _path("sensor", "$.sensorId"))
    return items.select(
        "location_id",
        F.coalesce(sensor, nested_sensor).alias("sensor_id"),
        F.when(described, _first_text(_path(parameter, "$.name"), _path(parameter, "$.code")))
        .otherwise(parameter).alias("own_parameter"),
        F.when(described, _first_text(_path(parameter, "$.units"), _path(parameter, "$.unit")))
        .otherwise(_first_text(F.col("unit"), F.col("units"))).alias("own_unit"),
        F.when(described, _path(parameter, "$.id").try_cast("bigint"))
        .otherwise(F.col("parameter_id")).alias("own_parameter_id"),
        number_or_null(F.col("value")).alias("value"),
        F.col("coordinates").alias("own_coordinates"),
        reading_time_text().alias("event_time"),
    )


def air_messages(items: DataFrame, chosen: DataFrame, ingestion_time: datetime) -> DataFrame:
    """Canonical air-quality messages of latest-value items of the chosen stations.

    What an item does not say about its pollutant comes from its sensor, which the station lists.
    The one join is an equi join whose strategy is left to the optimizer, as stations may be many.
    """
    station = chosen.select(
        F.col("id").alias("location_id"), "country", "target_city", "sensors",
        _first_text(F.col("locality"), F.col("name")).alias("station_city"),
        F.col("coordinates").alias("station_coordinates"),
        _first_text(F.col("provider"), F.col("owner"), F.col("sourceName")).alias("operator"))
    own_sensor = F.col("sensor_id")
    listed = F.filter("sensors", lambda s: (s["id"] == own_sensor) & s["parameter"].isNotNull())
    rows = (
        _read_item(items).join(station, "location_id")
        .withColumn("listed", F.get(listed, 0)["parameter"])
    )
    incomplete = reduce(
        or_, [F.col(c).isNull() for c in ("own_parameter", "own_unit", "own_parameter_id")])
    own, looked_up = F.col("own_coordinates"), F.col("station_coordinates")
    coordinates = F.when(_is_object(own) & (own != "{}"), own).otherwise(looked_up)

    def completed(own_name: str, listed_name: str) -> Column:
        own_value = F.col(own_name)
        return F.when(incomplete, F.coalesce(
            F.nullif(own_value, F.lit("")), F.col(f"listed.{listed_name}"))).otherwise(own_value)

    operator = F.col("operator")
    rows = rows.select(
        F.lit(rules.AIR_SOURCE).alias("source"),
        F.lit(rules.SCHEMA_VERSION).alias("schema_version"),
        F.lit(rules.AIR_PIPELINE_NAME).alias("pipeline"),
        F.lit(ingestion_time.strftime("%Y-%m-%d")).alias("pipeline_version"),
        "country",
        F.coalesce(F.nullif("target_city", F.lit("")), "station_city").alias("city"),
        "station_city", "target_city",
        completed("own_parameter", "name").alias("parameter"), "value",
        completed("own_unit", "units").alias("unit"),
        number_or_null(_path(coordinates, "$.latitude")).alias("latitude"),
        number_or_null(_path(coordinates, "$.longitude")).alias("longitude"),
        "event_time",
        times.iso_text(times.literal(ingestion_time)).alias("ingestion_time"),
        "location_id", "sensor_id",
        F.when(_is_object(operator), _path(operator, "$.name")).otherwise(operator)
        .alias("provider"),
        F.coalesce("own_parameter_id", "listed.id").alias("parameter_id"))
    return rows.withColumn("message_id", keys.content_id(*[
        F.col(c) for c in ("location_id", "parameter", "event_time", "value", "unit")]))


def _weather_message(rows: DataFrame, source: str, ingestion_time: datetime) -> DataFrame:
    """Canonical weather message of rows with city, place, time and measurements."""
    rows = rows.select(
        F.lit(source).alias("source"),
        F.lit(rules.SCHEMA_VERSION).alias("schema_version"),
        F.lit(rules.WEATHER_PIPELINE_NAME).alias("pipeline"),
        F.lit(ingestion_time.strftime("%Y-%m-%d")).alias("pipeline_version"),
        "country", "city", F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"), "temperature",
        F.lit(rules.CANONICAL_TEMPERATURE_UNIT).alias("temperature_unit"), "wind_speed",
        F.lit(rules.CANONICAL_WIND_UNIT).alias("wind_unit"),
        F.col("humidity").cast("int").alias("humidity"),
        F.lit(rules.CANONICAL_HUMIDITY_UNIT).alias("humidity_unit"),
        times.iso_text(F.col("moment")).alias("event_time"),
        times.iso_text(times.literal(ingestion_time)).alias("ingestion_time"))
    return rows.withColumn("message_id", keys.content_id(*[
        F.col(c) for c in (
            "source", "city", "event_time", "temperature", "wind_speed", "humidity",
            "temperature_unit", "wind_unit", "humidity_unit")]))


_PLACE = ("country", "city", "latitude", "longitude")


def forecast_messages(responses: DataFrame, ingestion_time: datetime) -> DataFrame:
    """Weather messages of responses with ``current`` and ``current_units``.

    Responses carry country, city, latitude, longitude and ``body``.
    """
    parsed = responses.select(
        *_PLACE, F.from_json("body", contracts.FORECAST_PAYLOAD).alias("p"))
    now, unit = "p.current", "p.current_units"
    rows = parsed.select(
        *_PLACE,
        times.parse_provider_time(F.col(f"{now}.time")).alias("moment"),
        units.temperature_celsius(
            F.col(f"{now}.temperature_2m"), F.col(f"{unit}.temperature_2m")).alias("temperature"),
        units.wind_metres_per_second(
            F.col(f"{now}.wind_speed_10m"), F.col(f"{unit}.wind_speed_10m")).alias("wind_speed"),
        F.col(f"{now}.relative_humidity_2m").alias("humidity"))
    return _weather_message(rows, rules.FORECAST_SOURCE, ingestion_time)


def observation_messages(responses: DataFrame, ingestion_time: datetime) -> DataFrame:
    """Weather messages of responses with ``main``, ``wind`` and an epoch ``dt``."""
    parsed = responses.select(
        *_PLACE, F.from_json("body", contracts.OBSERVATION_PAYLOAD).alias("p"))
    rows = parsed.select(
        *_PLACE,
        F.timestamp_micros((number_or_null(F.col("p.dt")) * 1_000_000).cast("bigint"))
        .alias("moment"),
        F.col("p.main.temp").alias("temperature"), F.col("p.wind.speed").alias("wind_speed"),
        F.col("p.main.humidity").alias("humidity"))
    return _weather_message(rows, rules.OBSERVATION_SOURCE, ingestion_time)


def recent_only(messages: DataFrame, now: datetime, allow_late: bool = True) -> DataFrame:
    """Messages at most six hours old, or 45 minutes when late events are not allowed."""
    return messages.filter(is_recent(F.col("event_time"), now, allow_late))


def is_recent(event_time: Column, now: datetime, allow_late: bool = True) -> Column:
    limit = rules.LATE_EVENT_WINDOW if allow_late else rules.REALTIME_WINDOW
    moment = times.parse_provider_time(event_time)
    return F.coalesce(moment >= times.literal(now - times.delta(limit)), F.lit(False))


def ingestion_disposition(messages: DataFrame, now: datetime, repeated: Column,
                          allow_late: bool = True) -> DataFrame:
    """Adds ``disposition``: missing_time, skipped_old, skipped_dup or produced."""
    return messages.withColumn(
        "disposition",
        F.when(F.col("event_time").isNull(), "missing_time")
        .when(~is_recent(F.col("event_time"), now, allow_late), "skipped_old")
        .when(repeated, "skipped_dup")
        .otherwise("produced"))


def newest_keys(entries: DataFrame, now: datetime, capacity: int | None = None,
                ttl: str = rules.CHANGE_STATE_TTL) -> DataFrame:
    """State entries not older than the time to live; with ``capacity``, the newest so many only."""
    oldest = times.literal(now - times.delta(ttl))
    fresh = entries.filter(F.col("updated_at").isNull() | (F.col("updated_at") >= oldest))
    if capacity is None:
        return fresh
    others = [F.col(c) for c in entries.columns if c != "updated_at"]
    return fresh.orderBy(F.col("updated_at").desc_nulls_first(), *others).limit(capacity)
