"""Raw provider responses stored as JSON lines, one response per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STATION_RESPONSES = "country string, body string"
LATEST_RESPONSES = "location_id string, body string"
WEATHER_RESPONSES = "country string, city string, latitude double, longitude double, body string"


def responses(spark: SparkSession, path: str, schema: str, streaming: bool = False) -> DataFrame:
    """Responses with their request fields; ``body`` is the response text."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).json(path)
