"""From source records to typed observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from envstream import contracts
from envstream.functions import times, units


def raw_envelope(records: DataFrame) -> DataFrame:
    """Value as text with topic, partition, offset and arrival time, plus the arrival date."""
    return records.selectExpr(
        "CAST(value AS STRING) AS raw_value", "timestamp AS kafka_timestamp", "topic",
        "partition", "offset",
    ).withColumn("ingest_date", F.to_date("kafka_timestamp"))


def parse_messages(raw: DataFrame, message: StructType) -> DataFrame:
    """Message fields beside ``raw_value``; a text that does not parse fills corrupt_record."""
    schema = StructType(list(message.fields)).add(contracts.CORRUPT_COLUMN, "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": contracts.CORRUPT_COLUMN}
    # As a generated row the fields are computed once. As a projected struct, filters on them
    # would move below the projection and parse the text again for every predicate.
    parsed = raw.select(
        "raw_value", F.inline(F.array(F.from_json("raw_value", schema, options))))
    fields = [
        F.col(name).alias("event_time_raw" if name == "event_time" else name)
        for name in message.fieldNames()
    ]
    return parsed.select(
        "raw_value", *fields, F.col(contracts.CORRUPT_COLUMN).alias("corrupt_record"),
        times.parse_event_time(F.col("event_time")).alias("event_time"))


def parse_air(raw: DataFrame) -> DataFrame:
    return parse_messages(raw, contracts.AIR_MESSAGE)


def normalize_units(parsed: DataFrame) -> DataFrame:
    """Adds temperature_c, wind_speed_ms and humidity_pct."""
    return parsed.withColumns({
        "temperature_c": units.temperature_celsius(
            F.col("temperature"), F.col("temperature_unit")),
        "wind_speed_ms": units.wind_metres_per_second(F.col("wind_speed"), F.col("wind_unit")),
        "humidity_pct": units.humidity_percent(F.col("humidity")),
    })


def parse_weather(raw: DataFrame) -> DataFrame:
    return normalize_units(parse_messages(raw, contracts.WEATHER_MESSAGE))
