"""Table scans that tolerate a missing table, and the city dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from envstream import contracts, rules
from envstream.operators import dedup
from envstream.sources import files

CITY_DIMENSION = "city string, latitude double, longitude double"


def read_columns(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Parquet scan of the named columns only."""
    return spark.read.parquet(path).select(*columns)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, and the optimizer knows it, unlike of an empty list, so joins with them are left out."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).filter(F.lit(False)).select(*nothing)


def read_or_empty(spark: SparkSession, path: str, schema: StructType,
                  condition: Column | None = None) -> DataFrame:
    """Parquet table with a known schema; an empty one when nothing was written yet."""
    try:
        rows = spark.read.schema(schema).parquet(path)
        rows = rows if condition is None else rows.filter(condition)
        return rows.select(*schema.fieldNames())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


def read_folders(spark: SparkSession, path: str, table: contracts.TableContract,
                 values: Sequence[str | int]) -> DataFrame:
    """The rows whose first partition column has one of the values. Only these folders are looked at."""
    partition = table.partitions[0]
    folders = [f"{path}/{partition}={value}" for value in values]
    there = [folder for folder in folders if files.exists(spark, folder)]
    if not there:
        return empty(spark, table.schema)
    return spark.read.schema(table.schema).option("basePath", path).parquet(*there).select(
        *table.schema.fieldNames())


def city_dimension(spark: SparkSession, updates: DataFrame | None = None) -> DataFrame:
    """The target cities with their coordinates; a row of ``updates`` adds or replaces a city."""
    cities = spark.createDataFrame(
        [(city, latitude, longitude) for city, _, latitude, longitude in rules.CITIES],
        CITY_DIMENSION)
    return cities if updates is None else dedup.merge_rows(cities, updates, ["city"])
