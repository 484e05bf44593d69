"""External tables over the layers, partition sync, counts and retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from envstream import contracts, rules
from envstream.functions import times
from envstream.operators import audit
from envstream.sources import files

DATABASE = "lakehouse"


def infer_schema(spark: SparkSession, path: str, fallback: StructType) -> StructType:
    """Schema found in a table's files, or the known one when there are none."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return fallback


def columns_table(spark: SparkSession, schema: StructType) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return spark.createDataFrame(rows, "column_name string, data_type string")


def create_table_sql(table: contracts.TableContract, location: str,
                     database: str = DATABASE, schema: StructType | None = None) -> str:
    fields = [(f.name, f.dataType.simpleString()) for f in (schema or table.schema).fields]
    if table.appended:
        fields.append((contracts.BATCH_COLUMN, "string"))
    columns = ", ".join(f"`{name}` {kind}" for name, kind in fields)
    stored = table.stored_partitions
    partitioned = f" PARTITIONED BY ({', '.join(stored)})" if stored else ""
    safe_location = location.replace("'", "''")
    return (
        f"CREATE TABLE IF NOT EXISTS {database}.{table.name} ({columns}) USING PARQUET"
        f"{partitioned} LOCATION '{safe_location}'"
    )


def register(spark: SparkSession, root: str, database: str = DATABASE,
             tables: Sequence[contracts.TableContract] = contracts.TABLES) -> None:
    """Database and external tables; the peaks columns follow the files when there are any."""
    location = files.absolute(spark, f"{root}/_database")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for table in tables:
        path = f"{root}/{table.location}"
        files.make_dirs(spark, path)
        schema = table.schema
        if table is contracts.GOLD_PEAKS:
            schema = infer_schema(spark, path, schema)
        spark.sql(create_table_sql(table, files.absolute(spark, path), database, schema))


def add_partitions(rows: DataFrame, table: contracts.TableContract, database: str = DATABASE,
                   merge_id: str | None = None) -> None:
    """Makes the partitions of a batch visible that was just written. Nothing is listed.

    ``rows`` are the batch's; the partitions are the combinations of values among them, which the batch
    wrote one folder each for. ``merge_id`` goes with layers that batches are appended to.
    """
    columns = [F.col(c).cast("string").alias(c) for c in table.partitions]
    found = rows.select(*columns).distinct().collect()
    extra = {contracts.BATCH_COLUMN: merge_id} if table.appended else {}
    for start in range(0, len(found), 100):
        parts = []
        for row in found[start:start + 100]:
            values = {**row.asDict(), **extra}
            parts.append("PARTITION (" + ", ".join(
                f"{name} = {_quoted(value)}" for name, value in values.items()) + ")")
        rows.sparkSession.sql(
            f"ALTER TABLE {database}.{table.name} ADD IF NOT EXISTS {' '.join(parts)}")


def _quoted(value: str | None) -> str:
    escaped = None if value is None else value.replace("\\", "\\\\").replace("'", "\\'")
    return "NULL" if value is None else f"'{escaped}'"


def sync_partitions(spark: SparkSession, database: str = DATABASE,
                    tables: Sequence[contracts.TableContract] = contracts.TABLES) -> None:
    """Finds all partitions of the tables by listing them, such as those that streams have written."""
    for table in tables:
        if table.stored_partitions:
            spark.catalog.recoverPartitions(f"{database}.{table.name}")


def list_tables(spark: SparkSession, database: str = DATABASE) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}").select("tableName").orderBy("tableName")


def table_counts(spark: SparkSession, database: str = DATABASE,
                 tables: Sequence[contracts.TableContract] = contracts.TABLES) -> DataFrame:
    """Rows of every table from one job."""
    return audit.row_counts(
        {t.name: spark.table(f"{database}.{t.name}") for t in tables}).select("table_name", "rows")


def drop_expired(spark: SparkSession, table: contracts.TableContract, now: datetime,
                 database: str = DATABASE, days: int = rules.RETENTION_DAYS) -> list[str]:
    """Removes the daily partitions that ended before the retention period; returns their days.

    Tables are external, so the files are removed as well.
    """
    (partition,) = table.partitions
    name = f"{database}.{table.name}"
    oldest = (now - times.delta(f"{days} days")).date().isoformat()
    values = [row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    expired = sorted(v for v in values if v < oldest)
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(
        "col_name = 'Location'").first()["data_type"]
    for day in expired:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition} = DATE'{day}')")
        files.delete(spark, f"{location}/{partition}={day}")
    return expired
