"""Writes over JDBC: append, and upsert through a staging table."""

from __future__ import annotations

import logging
import re
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from envstream.sources.jdbc import JdbcSettings

LOGGER = logging.getLogger(__name__)


def with_partitions(rows: DataFrame, target: int, grow: bool = False) -> DataFrame:
    """At most ``target`` partitions, or exactly that many, with a shuffle, when it may grow."""
    return rows.repartition(target) if grow else rows.coalesce(target)


def with_retries(action: Callable[[], None], retries: int, delay_seconds: float,
                 fail_fast: bool = True) -> bool:
    """Runs an action that may be repeated; tells whether it succeeded."""
    for attempt in range(retries + 1):
        try:
            action()
            return True
        except Exception as error:
            if attempt == retries:
                LOGGER.exception("write failed after %s attempts", attempt + 1)
                if fail_fast:
                    raise
                return False
            LOGGER.warning("write attempt %s failed: %s", attempt + 1, error)
            time.sleep(delay_seconds)
    return False


def append(rows: DataFrame, settings: JdbcSettings, table: str, mode: str = "append",
           fail_fast: bool = True) -> bool:
    def write() -> None:
        with_partitions(rows, settings.write_partitions).write.format("jdbc").mode(mode).options(
            **settings.write_options(), dbtable=table).save()

    return with_retries(write, settings.max_retries, settings.retry_delay_seconds, fail_fast)


def _identifier(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?", name):
        raise ValueError(f"not a plain SQL name: {name!r}")
    return name


def upsert_statement(table: str, staging: str, columns: Sequence[str],
                     key: Sequence[str], touched: str = "ingested_at") -> str:
    """One statement that moves the staged rows into the table, replacing rows of equal key."""
    names = ", ".join(_identifier(c) for c in columns)
    changes = [f"{_identifier(c)} = EXCLUDED.{c}" for c in columns if c not in key]
    changes.append(f"{_identifier(touched)} = NOW()")
    return (
        f"INSERT INTO {_identifier(table)} ({names}) SELECT {names} FROM {_identifier(staging)} "
        f"ON CONFLICT ({', '.join(_identifier(k) for k in key)}) "
        f"DO UPDATE SET {', '.join(changes)}"
    )


def _execute(rows: DataFrame, settings: JdbcSettings, statement: str) -> None:
    jvm = rows.sparkSession.sparkContext._jvm
    jvm.java.lang.Class.forName(settings.driver)
    properties = jvm.java.util.Properties()
    for name in ("user", "password"):
        value = getattr(settings, name)
        if value is not None:
            properties.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(settings.url, properties)
    try:
        connection.createStatement().execute(statement)
    finally:
        connection.close()


def upsert(rows: DataFrame, settings: JdbcSettings, table: str, columns: Sequence[str],
           key: Sequence[str], fail_fast: bool = True, writer: str | None = None) -> bool:
    """Executors fill the staging table, then the database merges it; no row passes the driver.

    ``rows`` must hold one row per key. Queries that write to one table at the same time need a
    ``writer`` name each, which gives them staging tables of their own.
    """
    staging = f"{table}_staging" if writer is None else f"{table}_staging_{writer}"
    statement = upsert_statement(table, staging, columns, key)

    def write() -> None:
        staged = with_partitions(rows.select(*columns), settings.write_partitions)
        staged.write.format("jdbc").mode("overwrite").options(
            **settings.write_options(), dbtable=staging, truncate="true").save()
        _execute(rows, settings, statement)

    return with_retries(write, settings.max_retries, settings.retry_delay_seconds, fail_fast)
