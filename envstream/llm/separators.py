"""Token counts from flat token files that have no index, only an end-of-document id.

A file is a run of little-endian unsigned 32-bit ids, held as blocks (file, block, content). A vector
comparison finds the separators of every block. What is left open at the end of a block reaches into
the next ones, which may hold no separator at all: where the open document of a block began is a
running maximum over the separators before it. That prefix scan has two levels, within stretches of
``SPAN`` blocks and over the stretches of a file, so a file of any length is split over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from envstream.llm.common import lean, written
from envstream.llm.pieces import PieceEncoder, slices

BLOCK_IDS = 16_384
SPAN = 1024
ID_BYTES = 4
#: A writer holds a row group, so it is a few hundred blocks; ids that differ need no dictionary.
ROW_GROUP = {"parquet_block_size": str(16 << 20), "parquet_enable_dictionary": "false"}


def _blocks_of(file: str, first: int, data: bytes, size: int) -> Iterator[tuple[str, int, bytes]]:
    for at in range(0, len(data), size):
        yield file, first + at // size, data[at:at + size]


def flat_files(docs: DataFrame, vocabulary: str, separator: int,
               block_ids: int = BLOCK_IDS) -> DataFrame:
    """Tokenises documents into flat files, one per task: file, block, content, doc_ids.

    ``doc_ids`` names the documents whose separator lies in the block; the scan doesn't read it.
    A null text is empty, and an empty one is a separator alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    size = block_ids * ID_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(shared.value, special_as_text=True)
        file, block, rest, owed = f"tokens-{TaskContext.get().partitionId():06d}", 0, b"", []

        def batches_of(some: bytes, first: int) -> Iterator[pa.RecordBatch]:
            for _, number, content in _blocks_of(file, first, some, size):
                ends = int((np.frombuffer(content, "<u4") == separator).sum())
                named = owed[:ends]
                del owed[:ends]
                yield pa.RecordBatch.from_arrays([
                    pa.array([file]), pa.array([number], pa.int64()), pa.array([content], pa.binary()),
                    pa.array([named], pa.list_(kind))], names=["file", "block", "content", "doc_ids"])

        for part, texts in slices(batches, 1):
            kind = part.column(0).type
            ids, edges = encoder.encode(texts)
            rest += np.insert(ids, edges[1:], separator).astype("<u4").tobytes()
            owed += part.column(0).to_pylist()
            whole = len(rest) // size * size
            if whole:
                yield from batches_of(rest[:whole], block)
                rest, block = rest[whole:], block + whole // size
        if rest:
            yield from batches_of(rest, block)

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    name = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        lean(run), f"file string, block long, content binary, doc_ids array<{name}>")


def read_flat_files(spark: SparkSession, path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of the flat files in a folder. Each is read whole, so keep files below 2 GB."""
    size = block_ids * ID_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(content) % ID_BYTES:
                    raise ValueError(f"{file} does not hold whole ids")
                for name, block, data in _blocks_of(file, 0, content, size):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([block], pa.int64()), pa.array([data])],
                        names=["file", "block", "content"])

    found = spark.read.format("binaryFile").load(path).select("path", "content")
    return found.mapInArrow(run, "file string, block long, content binary")


def _separators(blocks: DataFrame, separator: int) -> DataFrame:
    """Per block: its ids, and the places just behind each separator."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [np.flatnonzero(np.frombuffer(content or b"", "<u4") == separator) + 1
                    for content in batch.column(2).to_pylist()]
            ids = pa.compute.divide(pa.compute.fill_null(
                pa.compute.binary_length(batch.column(2)), 0).cast(pa.int64()), ID_BYTES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), ids,
                 pa.array([x.astype(np.int64) for x in ends], pa.list_(pa.int64()))],
                names=["file", "block", "ids", "ends"])

    return blocks.select("file", F.col("block").cast("long").alias("block"), "content").mapInArrow(
        run, "file string, block long, ids long, ends array<long>")


def scan(blocks: DataFrame, separator: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per document of the flat files: file, ordinal (from 0), start, n_tokens, closed.

    Every block but the last of a file holds ``block_ids`` ids. The separator doesn't count as a
    token. Two separators in a row enclose an empty document. What follows the last separator of a
    file is a document that isn't closed, if it holds a token. An empty file has no documents.
    """
    found = written(_separators(blocks, separator), "separators").withColumn(
        "span", F.expr(f"block div {SPAN}"))
    base = F.col("block") * block_ids
    in_span = Window.partitionBy("file", "span").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    last = F.when(F.size("ends") > 0, base + F.try_element_at("ends", F.lit(-1)))
    local = found.select(
        "file", "span", "block", "ids", "ends", F.max(last).over(in_span).alias("open"),
        F.coalesce(F.sum(F.size("ends")).over(in_span), F.lit(0)).alias("before"))
    in_file = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.groupBy("file", "span").agg(
        F.max(last).alias("last"), F.sum(F.size("ends")).alias("n"),
        F.max("block").alias("block"))
    spans = spans.select(
        "file", "span", F.max("last").over(in_file).alias("open_span"),
        F.coalesce(F.sum("n").over(in_file), F.lit(0)).alias("before_span"),
        (F.col("span") == F.max("span").over(Window.partitionBy("file"))).alias("in_last"),
        F.col("block").alias("last_block"))
    joined = local.join(spans, ["file", "span"])
    end = base + F.col("ids")
    # The end of the file closes what its last separator leaves open.
    is_last = F.col("in_last") & (F.col("block") == F.col("last_block"))
    first = F.coalesce("open", "open_span", F.lit(0).cast("long"))
    closing = F.transform("ends", lambda x: base + x)
    left_open = end > F.coalesce(F.try_element_at(closing, F.lit(-1)), first)
    closing_all = F.when(is_last & left_open, F.concat(closing, F.array(end))).otherwise(closing)
    rows = joined.select(
        "file", (F.col("before") + F.col("before_span")).alias("ordinal"), first.alias("first"),
        closing_all.alias("closing"), F.size("ends").alias("n"))
    rows = rows.select("file", "ordinal", "first", "closing", "n",
                       F.posexplode("closing").alias("at", "end"))
    start = F.coalesce(F.get("closing", F.col("at") - 1), F.col("first"))
    closed = F.col("at") < F.col("n")
    return rows.select(
        "file", (F.col("ordinal") + F.col("at")).alias("ordinal"), start.alias("start"),
        (F.col("end") - start - closed.cast("int")).alias("n_tokens"), closed.alias("closed"))


def document_tokens(docs: DataFrame, vocabulary_file: str, separator: int) -> DataFrame:
    """doc_id, file, ordinal, start, n_tokens of every document, counted in flat files made of them.

    Repeated rows and null ids are documents like others; columns other than doc_id and text are not
    looked at. An empty table gives an empty result.
    """
    with open(vocabulary_file, encoding="utf-8") as source:
        blocks = written(flat_files(docs, source.read(), separator), "tokens", **ROW_GROUP)
    counted = scan(blocks, separator)
    earlier = Window.partitionBy("file", "span").orderBy("block")
    size = F.size("doc_ids")
    order = blocks.select("file", "block", "doc_ids").withColumn("span", F.expr(f"block div {SPAN}"))
    spans = order.groupBy("file", "span").agg(F.sum(size).alias("n"))
    spans = spans.select("file", "span", (F.sum("n").over(
        Window.partitionBy("file").orderBy("span")) - F.col("n")).alias("before_span"))
    named = order.withColumn("before", F.sum(size).over(earlier) - size).join(
        spans, ["file", "span"]).select(
        "file", (F.col("before") + F.col("before_span")).alias("first"),
        F.posexplode("doc_ids").alias("at", "doc_id"))
    return counted.join(
        named.select("file", (F.col("first") + F.col("at")).alias("ordinal"), "doc_id"),
        ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens")
