"""What several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envstream.session import work_dir

# Characters that separate words: the space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, label: str, **options: str) -> DataFrame:
    """The rows, stored in the shared folder: later steps read the file and need no earlier task.

    ``options`` are those of the Parquet writer, written with ``_`` for ``.``.
    """
    path = work_dir(frame.sparkSession, label)
    frame.write.options(**{k.replace("_", "."): v for k, v in options.items()}).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


Batches = Iterator[pa.RecordBatch]


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The same function for ``mapInArrow``; its worker gives back the memory it has freed when a task ends.

    Workers are kept for later tasks, and with them whatever their allocators keep: beside the JVM that
    counts as memory of the executor, also while no task needs Python.
    """
    def returning(batches: Batches) -> Batches:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
        if trim is not None:
            trim(0)

    return returning


def let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN), lambda word: word != "")


def keyed(docs: DataFrame) -> DataFrame:
    """id_hash, text_hash and ``own``, the whole row: two hashes that tell rows by doc_id and text."""
    return docs.select(
        F.xxhash64("doc_id", F.col("doc_id").isNull()).alias("id_hash"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.struct("*").alias("own"))


def place_of() -> Column:
    """Order of ``keyed`` rows: by doc_id, null ones last, then by hash of text."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "id_hash")


def rows_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the id_hash and text_hash of ``places``, one for each, unchanged."""
    keys = ["id_hash", "text_hash"]
    return keyed(docs).join(places.select(keys), keys, "left_semi").dropDuplicates(keys).select("own.*")
