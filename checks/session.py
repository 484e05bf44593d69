"""Local session for tests, comparison and benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from envstream.session import configure


def local_session(cpus: str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("envstream")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        # Recording the Python line of every column expression is slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Small data: let even a few megabytes use every core.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        .config("spark.driver.memory", os.environ.get("DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
