"""Sensor readings, raw messages and provider payloads derived from the ``events`` table.

Every event becomes one reading. Conditions on the event id spoil some of them (text cut short,
field missing, unsupported pollutant) and deliver some twice; none leaves one out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envstream import rules
from envstream.operators.parse import raw_envelope
from envstream.session import configure

EVENTS = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
          "props string")
COUNTRIES = {"Paris": "FR", "London": "GB", "Berlin": "DE"}
PARAMETERS = {
    "click": "pm25", "purchase": "pm10", "error": "co", "signup": "no2", "view": "o3",
}
TEMPERATURE_UNITS = ("C", "°F", " F ", "fahrenheit", "K", "celsius")
WIND_UNITS = ("km/h", "m/s", "mph", "kn", "KPH ", "furlong")
PLACE_NAMES = (
    "Paris 2e Arrondissement", "Parish", "Londonderry", "LONDON - Bexley", "Bérlin", "Nanterre",
    "PÂRIS", "Greater  London", "Berlin-Mitte", "Arrondissement 5",
)


def _choice(index: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _mapped(column: Column, mapping: dict[str, str]) -> Column:
    result = None
    for name, value in mapping.items():
        result = (F if result is None else result).when(column == name, value)
    return result


def _text(moment: str) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = configure(spark).read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean typed readings: event_id, event_time, city, parameter, value, message_id."""
    rows = events(spark, sf_dir)
    city = _choice(F.col("user_id"), COUNTRIES)
    parameter = F.when(F.col("event_id") % 50 == 7, "so2").otherwise(
        _mapped(F.col("event_type"), PARAMETERS))
    message_id = F.when(F.col("event_id") % 11 == 0, "").otherwise(
        F.col("event_id").cast("string"))
    return rows.select(
        "event_id", "user_id", F.col("ts").alias("event_time"), city.alias("city"),
        _mapped(city, COUNTRIES).alias("country"), parameter.alias("parameter"), "value",
        message_id.alias("message_id"),
        F.get_json_object("props", "$.k").cast("int").alias("k"))


def _spoilt(remainder: int) -> Column:
    return F.col("event_id") % 40 == remainder


def _records(rows: DataFrame, message: Column, topic: str) -> DataFrame:
    """Source records of the messages: some cut short, some delivered twice."""
    text = F.to_json(message)
    twice = F.sequence(F.lit(0), F.when(F.col("event_id") % 10 == 0, 1).otherwise(0))
    return rows.withColumn("delivery", F.explode(twice)).select(
        F.when(_spoilt(3), F.substring(text, F.lit(1), F.length(text) - 4)).otherwise(text)
        .alias("value"),
        (F.col("event_time") + F.expr("INTERVAL 2 SECONDS")).alias("timestamp"),
        F.lit(topic).alias("topic"), (F.col("user_id") % 8).cast("int").alias("partition"),
        (F.col("event_id") * 2 + F.col("delivery")).alias("offset"))


def _shared_fields() -> dict[str, Column]:
    return {
        "schema_version": F.lit("1.0"),
        "country": F.col("country"),
        "city": F.when(~_spoilt(9), F.col("city")),
        "event_time": F.when(_spoilt(5), "").otherwise(_text("event_time")),
        "message_id": F.col("message_id"),
    }


def air_records(spark: SparkSession, sf_dir: str, moved: bool = False) -> DataFrame:
    """Records of the readings; ``moved`` gives them times two days and some minutes earlier."""
    rows = observations(spark, sf_dir)
    if moved:
        back = 2 * 86_400 + (F.col("event_id") % 70) * 60
        rows = rows.withColumn("event_time", F.timestamp_micros(
            F.unix_micros("event_time") - back.cast("bigint") * 1_000_000))
    fields = {
        "source": F.lit("feed"), **_shared_fields(), "parameter": F.col("parameter"),
        "value": F.when(~_spoilt(7), F.col("value")), "location_id": F.col("user_id"),
    }
    message = F.struct(*[c.alias(n) for n, c in fields.items()])
    return _records(rows, message, rules.AIR_TOPIC)


def weather_fields() -> dict[str, Column]:
    return {
        "temperature": F.when(~_spoilt(7), F.round(F.col("value") - 60, 2)),
        "temperature_unit": F.when(
            F.col("event_id") % 13 != 0, _choice(F.col("event_id"), TEMPERATURE_UNITS)),
        "wind_speed": F.round(F.col("value") / 10, 3),
        "wind_unit": F.when(
            F.col("event_id") % 17 != 0, _choice(F.col("event_id"), WIND_UNITS)),
        "humidity": F.col("k"),
        "humidity_unit": F.lit("%"),
    }


def weather_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations(spark, sf_dir)
    fields = {"source": F.lit("feed"), **_shared_fields(), **weather_fields()}
    message = F.struct(*[c.alias(n) for n, c in fields.items()])
    return _records(rows, message, rules.WEATHER_TOPIC)


def raw_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_envelope(air_records(spark, sf_dir))


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_envelope(weather_records(spark, sf_dir))


def _in_results(item: Column) -> Column:
    return F.to_json(F.struct(F.array(item).alias("results")))


def station_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per user, who stands for a station with one sensor per kind of event."""
    rows = observations(spark, sf_dir)
    sensor = F.struct(
        (F.col("user_id") * 10 + F.length("parameter")).alias("id"),
        F.struct(
            F.length("parameter").cast("bigint").alias("id"),
            F.upper("parameter").alias("name"), F.lit("µg/m³").alias("units"),
        ).alias("parameter"))
    # A set of at most as many sensors as there are pollutants.
    grouped = rows.groupBy("user_id", "country").agg(
        F.max("event_time").alias("last_time"), F.array_sort(F.collect_set(sensor)).alias("s"))
    place = _choice(F.col("user_id"), PLACE_NAMES)
    station = F.struct(
        F.col("user_id").alias("id"),
        F.when(F.col("user_id") % 3 == 0, place).otherwise("").alias("locality"),
        place.alias("name"),
        F.struct(F.concat(F.lit("net-"), F.col("user_id") % 4).alias("name")).alias("provider"),
        F.struct(
            (F.col("user_id") % 90).cast("double").alias("latitude"),
            (F.col("user_id") % 180).cast("double").alias("longitude")).alias("coordinates"),
        F.when(F.col("user_id") % 5 != 0, F.struct(_text("last_time").alias("utc")))
        .alias("datetimeLast"),
        F.when(F.col("user_id") % 7 != 0, F.col("s")).alias("sensors"))
    return grouped.select("country", _in_results(station).alias("body"))


def latest_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per event; its time and its pollutant are given in various forms."""
    rows = observations(spark, sf_dir)
    form = F.col("event_id") % 6

    def at(number: int, value: Column) -> Column:
        return F.when(form == number, value)

    when = _text("event_time")
    utc = F.struct(when.alias("utc"))
    described = F.struct(F.col("parameter").alias("name"), F.lit("ppm").alias("units"),
                         F.lit(77).cast("bigint").alias("id"))
    fields = {
        "value": F.col("value"),
        "sensorsId": F.col("user_id") * 10 + F.length("parameter"),
        "parameter": F.when(F.col("event_id") % 4 == 0, F.to_json(described)).when(
            F.col("event_id") % 4 == 1, F.concat(F.lit('"'), F.col("parameter"), F.lit('"'))),
        "coordinates": F.when(F.col("event_id") % 3 == 0, F.struct(
            F.lit(1.5).alias("latitude"), F.lit(2.5).alias("longitude"))),
        "datetime": at(0, F.to_json(utc)),
        "datetimeLast": at(1, utc),
        "period": at(2, F.struct(F.struct(when.alias("utc")).alias("datetimeTo"))),
        "date": at(3, F.struct(when.alias("utc"))),
        "lastUpdated": at(4, when),
    }
    # Object or text by turns, so these two are joined in as JSON text.
    mixed = ("parameter", "datetime")
    plain = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items() if n not in mixed]))
    extra = F.concat(*[
        F.coalesce(F.concat(F.lit(f',"{n}":'), fields[n]), F.lit("")) for n in mixed])
    item = F.concat(F.substring(plain, F.lit(1), F.length(plain) - 1), extra, F.lit("}"))
    body = F.concat(F.lit('{"results":['), item, F.lit("]}"))
    return rows.select(F.col("user_id").cast("string").alias("location_id"), body.alias("body"))


def _weather_responses(rows: DataFrame, body: Column) -> DataFrame:
    return rows.select(
        "country", "city", (F.col("user_id") % 90).cast("double").alias("latitude"),
        (F.col("user_id") % 180).cast("double").alias("longitude"), F.to_json(body).alias("body"))


def forecast_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = weather_fields()
    body = F.struct(
        F.struct(
            F.date_format("event_time", "yyyy-MM-dd'T'HH:mm").alias("time"),
            fields["temperature"].alias("temperature_2m"),
            fields["wind_speed"].alias("wind_speed_10m"),
            F.col("k").alias("relative_humidity_2m")).alias("current"),
        F.struct(
            fields["temperature_unit"].alias("temperature_2m"),
            fields["wind_unit"].alias("wind_speed_10m"),
            F.lit("%").alias("relative_humidity_2m")).alias("current_units"))
    return _weather_responses(observations(spark, sf_dir), body)


def observation_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = weather_fields()
    body = F.struct(
        F.struct(
            fields["temperature"].alias("temp"), F.col("k").alias("humidity")).alias("main"),
        F.struct(fields["wind_speed"].alias("speed")).alias("wind"),
        F.when(~_spoilt(5), F.unix_seconds("event_time")).alias("dt"))
    return _weather_responses(observations(spark, sf_dir), body)
