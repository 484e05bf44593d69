"""Small file-system calls through Hadoop, so that they work on any storage Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none when it is missing."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def absolute(spark: SparkSession, path: str) -> str:
    """Path with its scheme, as table locations need it."""
    fs, target = _resolve(spark, path)
    return fs.makeQualified(target).toString()
