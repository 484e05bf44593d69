"""Token files with frequency-ranked ids in byte-aligned variable-length coding.

The more frequent an id in the whole corpus, the lower its rank, and ranks are what the files hold: one
to four bytes each, without leading zeros. The lengths lie apart from the bytes, four to a control
byte, two bits each. A reader looks the control bytes up in a table of 256 rows, sums the lengths up
to places, and takes four bytes at every place at once, less those that belong to the next ones.

A corpus is a folder with two tables. ``ranks`` has the id of every rank. ``blocks`` has the files in
blocks of whole documents: file, block, first (ids of the file before the block), doc_ids, and two
coded streams, of the documents' lengths and of their ids. Files are numbered in the order of their
documents, and documents lie in ascending order of doc_id.

Ids are made once. Until their ranks are known they are kept in a plain compressed form; they are dealt
to files by ranges of doc_id, and where one id has very many rows, those are dealt further by place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from envstream.llm.common import lean, written
from envstream.llm.pieces import PieceEncoder, slices
from envstream.llm.units import offsets_of

#: Ids after which a block ends with its document.
BLOCK_IDS = 65_536
#: Writers hold a row group; a block is a few hundred kilobytes.
ROW_GROUP = {"parquet_block_size": str(16 << 20), "parquet_enable_dictionary": "false"}

_LENGTHS = 1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int64)
_KEPT = np.array([(1 << 8 * n) - 1 for n in range(5)], np.uint32)


def pack_numbers(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of numbers below 2 ** 32."""
    values = values.astype("<u4")
    code = ((values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)).astype(np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    fours = np.zeros(-(-len(code) // 4) * 4, np.uint8)
    fours[:len(code)] = code
    fours = fours.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    return np.bitwise_or.reduce(fours, axis=1).tobytes(), data.tobytes()


def unpack_numbers(control: bytes, data: bytes, count: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    starts = offsets_of(lengths)
    if len(lengths) < count or starts[-1] != len(data):
        raise ValueError("control bytes and data don't belong together")
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    windows = np.ndarray((len(data),), "<u4", padded, strides=(1,))
    return windows[starts[:-1]] & _KEPT[lengths]


def _raw_type(vocabulary_size: int) -> str:
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


def _tokenised(docs: DataFrame, vocabulary: str, end: int, raw: str) -> DataFrame:
    """doc_id, text_hash, task, place, ids (compressed) and n_tokens of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor

        encoder, squeeze = PieceEncoder(shared.value), ZstdCompressor(level=1).compress
        task, place = TaskContext.get().partitionId(), 0
        for part, texts in slices(batches, 2):
            ids, edges = encoder.encode(texts)
            flat = np.insert(ids, edges[1:], end).astype(raw)
            edges = edges + np.arange(len(edges))
            n = part.num_rows
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(1), pa.array(np.full(n, task, np.int32)),
                pa.array(np.arange(place, place + n)),
                pa.array([squeeze(flat[a:b].data) for a, b in zip(edges, edges[1:])], pa.binary()),
                pa.array(np.diff(edges))], names=names)
            place += n

    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    names = ["doc_id", "text_hash", "task", "place", "ids", "n_tokens"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        lean(run), f"doc_id {kind}, text_hash long, task int, place long, ids binary, n_tokens long")


def _ranked_ids(tokens: DataFrame, size: int, raw: str) -> np.ndarray:
    """All ids, the most frequent first, equal ones by number; a vocabulary's worth of numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdDecompressor

        open_up, counts = ZstdDecompressor().decompress, np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                counts += np.bincount(np.frombuffer(open_up(ids.as_py()), raw), minlength=size)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int64)), pa.array(counts[used])], names=["id", "n"])

    found = tokens.select("ids").mapInArrow(lean(run), "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n"))
    counts = np.zeros(size, np.int64)
    for row in found.collect():  # at most the vocabulary
        counts[row.id] = row.n
    return np.lexsort((np.arange(size), -counts))


def write_tokens(docs: DataFrame, vocabulary_file: str, end: int) -> tuple[DataFrame, DataFrame]:
    """The tables ``ranks`` and ``blocks`` of a corpus, as read back from the files.

    Every document ends with the id ``end``. Rows of one doc_id lie in the order of a hash of the text,
    those without an id behind all others. ``vocabulary_file`` is read on the driver.
    """
    from tokenizers import Tokenizer

    with open(vocabulary_file, encoding="utf-8") as source:
        vocabulary = source.read()
    size = max(end, *Tokenizer.from_str(vocabulary).get_vocab().values()) + 1
    raw = _raw_type(size)
    spark = docs.sparkSession
    tokens = written(_tokenised(docs, vocabulary, end, raw), "token-ids", **ROW_GROUP)
    id_of = _ranked_ids(tokens, size, raw)
    rank_of = np.empty(size, np.uint32)
    rank_of[id_of] = np.arange(size)
    shared = spark.sparkContext.broadcast(rank_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdDecompressor

        open_up, ranks = ZstdDecompressor().decompress, shared.value
        file, block, first, held, doc_ids = TaskContext.get().partitionId(), 0, 0, [], []

        def made() -> pa.RecordBatch:
            ids = np.concatenate(held)
            sizes = pack_numbers(np.fromiter(map(len, held), np.int64))
            streams = [pa.array([x], pa.binary()) for x in (*sizes, *pack_numbers(ranks[ids]))]
            return pa.RecordBatch.from_arrays([
                pa.array([file], pa.int32()), pa.array([block], pa.int64()), pa.array([first], pa.int64()),
                pa.array([doc_ids], pa.list_(kind)), pa.array([len(ids)], pa.int64()), *streams],
                names=names)

        total = 0
        for batch in batches:
            kind = batch.column(0).type
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.append(np.frombuffer(open_up(ids.as_py()), raw))
                doc_ids.append(doc_id)
                total += len(held[-1])
                if total >= BLOCK_IDS:
                    yield made()
                    block, first, total, held, doc_ids = block + 1, first + total, 0, [], []
        if held:
            yield made()

    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"), F.col("task"), F.col("place")]
    ordered = tokens.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["file", "block", "first", "doc_ids", "n_ids",
             "size_control", "size_data", "control", "data"]
    blocks = written(ordered.mapInArrow(
        lean(run), f"file int, block long, first long, doc_ids array<{id_type}>, n_ids long, "
                   "size_control binary, size_data binary, control binary, data binary"), "token-blocks", **ROW_GROUP)
    ranks = spark.createDataFrame(pa.table({"rank": np.arange(size), "id": id_of.astype(np.int64)}))
    return written(ranks, "token-ranks"), blocks


def id_table(ranks: DataFrame) -> np.ndarray:
    """Ids by rank; a vocabulary's worth of numbers."""
    rows = ranks.collect()
    table = np.zeros(len(rows), np.uint32)
    for row in rows:
        table[row.rank] = row.id
    return table


def read_tokens(ranks: DataFrame, blocks: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, file, start (in its file), n_tokens, ids_crc32.

    ``with_ids`` adds the ids themselves.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(id_table(ranks))
    columns = ["file", "first", "doc_ids", "n_ids", "size_control", "size_data", "control", "data"]
    names = ["doc_id", "file", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(i)[at] for i, name in enumerate(columns)}
                documents = row["doc_ids"].values
                n, file = len(documents), row["file"].as_py()
                sizes = unpack_numbers(row["size_control"].as_py(), row["size_data"].as_py(), n)
                edges = offsets_of(sizes.astype(np.int64))
                ids = shared.value[unpack_numbers(
                    row["control"].as_py(), row["data"].as_py(), row["n_ids"].as_py())].astype("<u4")
                crc = [zlib.crc32(ids[a:b].data) for a, b in zip(edges, edges[1:])]
                made = [documents, pa.array(np.full(n, file, np.int32)),
                        pa.array(row["first"].as_py() + edges[:-1]), pa.array(np.diff(edges)),
                        pa.array(crc, pa.int64())]
                if with_ids:
                    made.append(pa.ListArray.from_arrays(
                        pa.array(edges, pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(made, names=names)

    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.select(*columns).mapInArrow(
        lean(run), f"doc_id {kind}, file int, start long, n_tokens long, ids_crc32 long"
        + ", ids array<long>" * with_ids)


def document_spans(docs: DataFrame, vocabulary_file: str, end: int, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from files made of all of them.

    ``start`` counts the ids of all documents before, over all files. A null or empty text is the end id
    alone. Rows with a repeated doc_id are documents of their own, next to each other; those without an
    id come last. Long texts are one block. Columns other than doc_id and text are not looked at; an
    empty table gives an empty result.
    """
    ranks, blocks = write_tokens(docs, vocabulary_file, end)
    # A number per file; there are as many files as tasks that wrote them.
    files = blocks.groupBy("file").agg(F.sum("n_ids").alias("n"))
    before = files.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    found = read_tokens(ranks, blocks, with_ids).join(F.broadcast(before), "file")
    return found.select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens",
                        "ids_crc32", *(["ids"] if with_ids else []))


def read_corpus(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``ranks`` and ``blocks`` of a corpus stored with ``store_corpus``."""
    return spark.read.parquet(f"{path}/ranks"), spark.read.parquet(f"{path}/blocks")


def store_corpus(ranks: DataFrame, blocks: DataFrame, path: str) -> None:
    """Stores the two tables side by side, for readers of other sessions."""
    ranks.write.parquet(f"{path}/ranks")
    blocks.write.options(**{k.replace("_", "."): v for k, v in ROW_GROUP.items()}).parquet(f"{path}/blocks")
