"""Message streams: Kafka in production, files of the same columns in tests and backfills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from envstream import contracts
from envstream.operators.parse import raw_envelope


def kafka_options(servers: str, topic: str, starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Raw envelope of one topic. Needs the Kafka connector on the class path."""
    options = kafka_options(servers, topic, starting_offsets, max_offsets_per_trigger)
    return raw_envelope(spark.readStream.format("kafka").options(**options).load())


def file_stream(spark: SparkSession, path: str, file_format: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw envelope of files holding value, timestamp, topic, partition and offset."""
    reader = spark.readStream.schema(contracts.SOURCE_RECORD).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return raw_envelope(reader.load(path))


def table_stream(spark: SparkSession, root: str, table: contracts.TableContract) -> DataFrame:
    """A lakehouse table as a stream, for jobs that read a layer instead of the topic."""
    return spark.readStream.schema(table.schema).parquet(f"{root}/{table.location}")
