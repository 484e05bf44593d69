"""Duplicate passages by relative Lempel-Ziv parsing against a block index.

The reference is the corpus itself, indexed in blocks. An index entry is a stretch of a document: all
windows of ``window`` words that share their least ``gram``, with one hash per window. Equal windows
have the same least gram, so an entry meets everything it can match in the block of that gram. There
every entry is parsed from left to right against all others: a factor is the longest run of its
windows that occur elsewhere. Stretches follow each other without a gap, so a factor that goes on
across their boundary goes on in the next entry, and the window is what is compared at the boundary:
a factor is long enough as soon as it holds one.

Equal texts are one document with a count. A task sends each text once. Grams that are frequent in a
sample of the texts are dealt to ``SALTS`` sub-blocks by document. Their repeated windows are counted
beforehand, with partial counts on the map side, and put into every sub-block, so no block gathers all
entries of a hot gram.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import lean, written
from envstream.llm.units import chunks, offsets_of, ragged

GRAM = 8
SALTS = 64
#: One text in so many tells which grams are hot; a gram is, if it has more than this share of entries.
SAMPLE, HOT_SHARE, HOT_LEAST = 32, 1e-4, 8
CHUNK_ROWS = 40_000

_MULTIPLIER = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Hashes:
    """Hashes of all stretches of n words, by sums that lose nothing modulo 2 to the 64."""

    sums: np.ndarray
    unwind: np.ndarray

    @classmethod
    def of(cls, words: np.ndarray) -> Hashes:
        powers = np.full(len(words), _MULTIPLIER, np.uint64)
        inverse = np.full(len(words) + 1, pow(_MULTIPLIER, -1, 1 << 64), np.uint64)
        powers[:1] = inverse[:1] = 1
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * np.cumprod(powers, dtype=np.uint64), out=sums[1:], dtype=np.uint64)
        return cls(sums, np.cumprod(inverse, dtype=np.uint64))

    def stretch(self, start: np.ndarray, n: int) -> np.ndarray:
        mixed = (self.sums[start + n] - self.sums[start]) * self.unwind[start]
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        return mixed ^ (mixed >> np.uint64(31))


def split_words(text: str) -> list[bytes]:
    """Words of a text; on bytes, split() cuts at the six separators and nothing else."""
    return text.encode("utf-8").split()


def _word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    known = {word: xxh64_intdigest(word, 7) for word in set(words)}
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first least value of each ``width`` neighbours."""
    best, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = best[:-step], best[step:]
        best = np.where(values[left] <= values[right], left, right)
        reach += step
    return best


def entries_of(texts: list[str], window: int) -> tuple[np.ndarray, ...]:
    """Index entries of some texts: text, first window, gram hash, windows, and all window hashes."""
    words = [split_words(text) for text in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    flat = _word_hashes([word for some in words for word in some])
    base = offsets_of(counts)
    hashes = Hashes.of(flat)
    windows = np.maximum(counts - window + 1, 0)
    start = ragged(base[:-1], windows)
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none, none.astype(np.uint64)
    grams = hashes.stretch(np.arange(len(flat) - GRAM + 1), GRAM)
    chosen = _least(grams, window - GRAM + 1)[start]
    document = np.repeat(np.arange(len(texts)), windows)
    first = np.flatnonzero(np.append(True, (chosen[1:] != chosen[:-1]) |
                                     (document[1:] != document[:-1])))
    n = np.diff(np.append(first, len(start)))
    return (document[first], start[first] - base[document[first]], grams[chosen[first]], n,
            hashes.stretch(start, window))


def _from_entries(texts: DataFrame, window: int, made, schema: str) -> DataFrame:
    """What ``made`` makes of the entries of some texts; each task takes a text once.

    It runs where the entries are found, so that a task needs one Python process.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            for part, texts in chunks([batch], 1):
                new = {key: text for key, text in zip(part.column(0).to_pylist(), texts)
                       if key not in sent}
                sent.update(new)
                yield made(list(new), *entries_of(list(new.values()), window))

    return texts.mapInArrow(lean(run), schema)


def _index(texts: DataFrame, window: int) -> DataFrame:
    """key, gram, first, hashes (unsigned 64-bit, packed) of every entry; texts have key and text."""
    def packed(keys: list[bytes], document: np.ndarray, first: np.ndarray, gram: np.ndarray,
               n: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
        edges = pa.array(offsets_of(n) * 8, pa.int32())
        return pa.RecordBatch.from_arrays([
            pa.array(keys, pa.binary()).take(pa.array(document)), pa.array(gram.view(np.int64)),
            pa.array(first.astype(np.int32)),
            pa.BinaryArray.from_buffers(pa.binary(), len(n), [
                None, edges.buffers()[1], pa.py_buffer(hashes.tobytes())])],
            names=["key", "gram", "first", "hashes"])

    return _from_entries(texts, window, packed, "key binary, gram long, first int, hashes binary")


def _chunked(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Sorted rows in tables that end where the group ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) < CHUNK_ROWS:
            continue
        table = pa.Table.from_batches(held)
        end = int(np.flatnonzero(_starts(table, by))[-1])
        if end:
            yield table.slice(0, end).combine_chunks()
        held = table.slice(end).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _starts(table: pa.Table, by: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for column in (table[name].to_numpy() for name in by):
        new[1:] |= column[1:] != column[:-1]
    return new


def _flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Windows per row, and all their hashes."""
    packed = table["hashes"].to_pylist()
    return (np.fromiter((len(x) // 8 for x in packed), np.int64, len(packed)),
            np.frombuffer(b"".join(packed), np.uint64))


def _factors(row: np.ndarray, place: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """(row, first, last) of the longest runs of repeated windows within each row."""
    at = np.flatnonzero(repeated)
    if not len(at):
        return np.zeros((3, 0), np.int64)
    new = np.append(True, (np.diff(at) != 1) | (np.diff(row[at]) != 0))
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1
    return np.stack([row[at[begin]], place[at[begin]], place[at[end]]])


def _parsed(index: DataFrame, window: int) -> DataFrame:
    """key, begin, end (in words) of the factors found within each (gram, salt)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunked(batches, ["gram", "salt"]):
            group = np.cumsum(_starts(table, ["gram", "salt"])) - 1
            several = np.bincount(group)[group] > 1
            table, group = table.filter(pa.array(several)), group[several]
            n, hashes = _flat(table)
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((hashes, group[row]))
            same = (hashes[order][1:] == hashes[order][:-1]) & (
                group[row][order][1:] == group[row][order][:-1])
            repeated = np.zeros(len(hashes), bool)
            repeated[order[1:]] |= same
            repeated[order[:-1]] |= same
            row, first, last = _factors(row, ragged(np.zeros(len(n), np.int64), n), repeated)
            start = table["first"].to_numpy()[row].astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                table["key"].take(pa.array(row)).combine_chunks(),
                pa.array((start + first).astype(np.int32)),
                pa.array((start + last + window).astype(np.int32))], names=["key", "begin", "end"])

    rows = index.repartition("gram", "salt").sortWithinPartitions("gram", "salt")
    return rows.mapInArrow(lean(run), "key binary, begin int, end int").where(F.col("key").isNotNull())


def _hot_grams(texts: DataFrame, window: int) -> np.ndarray:
    """Grams with more than their share of a sample's entries: at most 1 / ``HOT_SHARE`` of them."""
    some = texts.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    counts = written(_index(some, window).groupBy("gram").agg(F.count("*").alias("n")), "grams")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") > max(HOT_LEAST, HOT_SHARE * total)).select("gram")
    return np.array(sorted(row.gram for row in hot.collect()), np.int64)


def _repeated_windows(texts: DataFrame, window: int, hot: np.ndarray) -> DataFrame:
    """Windows of hot grams that occur twice or more, as index entries of every salt."""
    shared = texts.sparkSession.sparkContext.broadcast(hot)

    def counts(keys: list[bytes], document: np.ndarray, first: np.ndarray, gram: np.ndarray,
               n: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
        of = np.repeat(gram.view(np.int64), n)
        kept = np.isin(of, shared.value)
        pairs = np.stack([of[kept], hashes.view(np.int64)[kept]], axis=1)
        distinct, many = np.unique(pairs, axis=0, return_counts=True)
        return pa.RecordBatch.from_arrays([
            pa.array(distinct[:, 0].copy()),
            pa.array([x.tobytes() for x in distinct[:, 1]], pa.binary()), pa.array(many)],
            names=["gram", "hashes", "n"])

    counted = _from_entries(texts, window, counts, "gram long, hashes binary, n long")
    repeated = counted.groupBy("gram", "hashes").agg(F.sum("n").alias("n")).where("n > 1")
    return repeated.select(
        F.lit(None).cast("binary").alias("key"), "gram", F.lit(0).alias("first"), "hashes",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))


def _salted(texts: DataFrame, window: int) -> DataFrame:
    """The index with a salt per entry, -1 for grams that aren't hot."""
    index, hot = _index(texts, window), _hot_grams(texts, window)
    if not len(hot):
        return index.withColumn("salt", F.lit(-1))
    listed = texts.sparkSession.createDataFrame(pa.table({"gram": hot, "hot": np.ones(len(hot), bool)}))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).otherwise(-1)
    entries = index.join(F.broadcast(listed), "gram", "left").select(
        "key", "gram", "first", "hashes", salt.alias("salt"))
    return entries.union(_repeated_windows(texts, window, hot))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def duplicate_spans(docs: DataFrame, window: int = 35) -> DataFrame:
    """Per distinct text: key, copies (rows with that text), spans of words in repeated windows.

    Texts with neither copies nor spans are left out.
    """
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = texts.select(text_key(F.col("text")).alias("key"), "text")
    found = written(_parsed(_salted(keyed, window), window), "spans")
    spans = found.groupBy("key").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    copies = keyed.groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1")
    return spans.join(copies, "key", "full_outer").select(
        "key", F.coalesce("copies", F.lit(1)).alias("copies"), "spans")


def without_repeats(docs: DataFrame, carried: Sequence[str], window: int = 35,
                    joined: bool = True) -> DataFrame:
    """Every row's ``carried`` columns as ``own`` (a struct), n_words, n_removed, and ``kept``.

    Every word in a window of words that also starts elsewhere is removed, at all its places.
    ``kept`` has the words that stay, joined by one space; without ``joined``, a text that keeps all of
    them stays as it is. A null text is an empty one; a text shorter than the window keeps all words. Repeated
    rows are documents of their own, so they remove each other. Long texts are read whole, and an empty
    table gives an empty result.
    """
    marked = duplicate_spans(docs, window)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in carried]).alias("own"),
                       text.alias("words"), text_key(text).alias("key"))
    rows = rows.join(marked, "key", "left").select("own", "words", "copies", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, 1):
            total, removed, kept = [], [], []
            for text, copies, spans in zip(texts, part.column(2), part.column(3)):
                words = split_words(text)
                n = len(words)
                gone = np.zeros(n, bool)
                if (copies.as_py() or 1) > 1 and n >= window:
                    gone[:] = True
                for span in spans.as_py() or ():
                    gone[span["begin"]:span["end"]] = True
                left = [word for word, out in zip(words, gone.tolist()) if not out]
                total.append(n)
                removed.append(n - len(left))
                kept.append(b" ".join(left).decode("utf-8") if joined or len(left) < n else text)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.string())], names=["own", "n_words", "n_removed", "kept"])

    kind = rows.schema["own"].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"own {kind}, n_words long, n_removed long, kept string")


def digest(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return without_repeats(docs, ["doc_id"], window).select(
        F.col("own.doc_id").alias("doc_id"), "n_words", "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
