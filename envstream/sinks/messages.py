"""Publishing canonical messages as keyed JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream.functions import keys


def _keyed(messages: DataFrame, key: Column) -> DataFrame:
    fields = F.struct(*messages.columns)
    return messages.select(
        key.alias("key"), F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def air_records(messages: DataFrame) -> DataFrame:
    """Key ``country|city|parameter`` and the message as JSON, absent fields written as null."""
    return _keyed(messages, keys.air_publish_key())


def weather_records(messages: DataFrame) -> DataFrame:
    """Key ``city|source`` and the message as JSON."""
    return _keyed(messages, keys.weather_publish_key())


def publish(records: DataFrame, servers: str, topic: str) -> None:
    """Writes a batch of records to a topic. Needs the Kafka connector on the class path."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic).save()
