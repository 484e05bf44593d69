"""Reads over JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from envstream import rules


@dataclass(frozen=True)
class JdbcSettings:
    url: str
    driver: str
    user: str | None = None
    password: str | None = None
    batch_size: int = rules.JDBC_BATCH_SIZE
    isolation_level: str = rules.JDBC_ISOLATION_LEVEL
    write_partitions: int = rules.JDBC_WRITE_PARTITIONS
    max_retries: int = rules.JDBC_MAX_RETRIES
    retry_delay_seconds: float = rules.JDBC_RETRY_DELAY_SECONDS

    def read_options(self) -> dict[str, str]:
        options = {"url": self.url, "driver": self.driver}
        if self.user is not None:
            options["user"] = self.user
        if self.password is not None:
            options["password"] = self.password
        return options

    def write_options(self) -> dict[str, str]:
        """``numPartitions`` makes the writer merge partitions down to that many connections."""
        return {
            **self.read_options(),
            "batchsize": str(self.batch_size),
            "isolationLevel": self.isolation_level,
            "numPartitions": str(self.write_partitions),
        }


def read_query(spark: SparkSession, settings: JdbcSettings, query: str) -> DataFrame:
    return spark.read.format("jdbc").options(
        **settings.read_options(), dbtable=f"({query}) q").load()


def can_connect(spark: SparkSession, settings: JdbcSettings, probe: str = "SELECT 1",
                fail_fast: bool = False) -> bool:
    """Whether the database answers a one-row query."""
    try:
        read_query(spark, settings, probe).collect()
    except Exception:
        if fail_fast:
            raise
        return False
    return True
