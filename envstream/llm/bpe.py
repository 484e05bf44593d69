"""Byte-level BPE encoding and decoding with padded numpy matrices.

Distinct pieces of text are laid out as rows of byte ids, bucketed by length. In every round each row
looks all its neighbouring pairs up in a hash table, merges its leftmost pair of least rank, and closes
the gap. A row leaves when none of its pairs is known. Pieces longer than ``MATRIX_BYTES`` keep their
pairs in a heap instead, so that a very long one costs n log n.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream.llm.units import Encoded, UnitEncoder, chunks, offsets_of, ragged

MATRIX_BYTES = 64
NONE = np.int32(2 ** 31 - 1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Vocabulary:
    """Token bytes by rank, and a hash table from pairs of ranks to the rank of their merger."""

    token_bytes: np.ndarray
    token_starts: np.ndarray
    byte_ranks: np.ndarray
    keys: np.ndarray
    values: np.ndarray
    probes: int

    def slots(self, keys: np.ndarray) -> np.ndarray:
        bits = np.uint64(64 - (len(self.keys).bit_length() - 1))
        return ((keys.astype(np.uint64) * _FACTOR) >> bits).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each merged pair, ``NONE`` where it isn't a token. Negative ids are padding."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        found = np.full(keys.shape, NONE, np.int32)
        open_, flat = np.flatnonzero((left >= 0).ravel() & (right >= 0).ravel()), keys.ravel()
        slots = self.slots(flat[open_])
        out = found.ravel()
        for _ in range(self.probes):
            here = self.keys[slots]
            hit = here == flat[open_]
            out[open_[hit]] = self.values[slots[hit]]
            go_on = ~hit & (here >= 0)
            open_, slots = open_[go_on], (slots[go_on] + 1) & (len(self.keys) - 1)
            if not len(open_):
                break
        return out.reshape(keys.shape)


def vocabulary(rank_lines: bytes) -> Vocabulary:
    """From the lines of a rank file: base64 of the token, a space, the rank (from 0, gapless)."""
    ranks = {base64.b64decode(token): int(rank)
             for token, rank in map(bytes.split, rank_lines.splitlines())}
    tokens = sorted(ranks, key=ranks.__getitem__)
    pairs = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                pairs[left << 32 | right] = rank
    size = 1 << (2 * len(pairs)).bit_length()
    made = Vocabulary(
        np.frombuffer(b"".join(tokens), np.uint8), offsets_of(np.array([len(t) for t in tokens])),
        np.array([ranks[bytes([b])] for b in range(256)], np.int32),
        np.full(size, -1, np.int64), np.zeros(size, np.int32), 1)
    keys = np.fromiter(pairs.keys(), np.int64)
    values = np.fromiter(pairs.values(), np.int32)
    slots = made.slots(keys)
    while len(keys):  # in each round one of the keys that want a free slot gets it
        free = made.keys[slots] < 0
        taken, first = np.unique(slots[free], return_index=True)
        first = np.flatnonzero(free)[first]
        made.keys[taken], made.values[taken] = keys[first], values[first]
        rest = np.ones(len(keys), bool)
        rest[first] = False
        keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & (size - 1)
        made.probes += 1
    return made


def _merge_rows(rows: np.ndarray, known: Vocabulary) -> list[np.ndarray]:
    """Final ids per row; rows are ranks padded with -1 on the right."""
    done: list = [None] * len(rows)
    at = np.arange(len(rows))
    ranks = known.pair_ranks(rows[:, :-1], rows[:, 1:])
    while len(at):
        column = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(at), np.int64)
        best = (ranks[np.arange(len(at)), column] if ranks.shape[1]
                else np.full(len(at), NONE, np.int32))
        ended = best == NONE
        for i, row, n in zip(at[ended], rows[ended], (rows[ended] >= 0).sum(axis=1)):
            done[i] = row[:n]
        at, rows, ranks = at[~ended], rows[~ended], ranks[~ended]
        column, best = column[~ended], best[~ended]
        if not len(at):
            break
        line, shown = np.arange(len(at)), np.arange(rows.shape[1] - 1)
        kept = shown + (shown > column[:, None])
        rows = np.take_along_axis(rows, kept, axis=1)
        rows[line, column] = best
        ranks = np.take_along_axis(ranks, kept[:, :-1], axis=1)
        for near in (column - 1, column):
            right = (near >= 0) & (near < ranks.shape[1])
            line_, near_ = line[right], near[right]
            ranks[line_, near_] = known.pair_ranks(rows[line_, near_], rows[line_, near_ + 1])
        width = int((rows >= 0).sum(axis=1).max())
        rows, ranks = rows[:, :width], ranks[:, :max(0, width - 1)]
    return done


def _merge_long(row: np.ndarray, known: Vocabulary) -> np.ndarray:
    ids, n = row.tolist(), len(row)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    first = known.pair_ranks(row[:-1], row[1:])
    heap = [(int(r), i) for i, r in enumerate(first) if r != NONE]
    current = {i: r for r, i in heap}
    heapq.heapify(heap)

    def look(i: int) -> None:
        current.pop(i, None)
        if i >= 0 and after[i] < n:
            rank = int(known.pair_ranks(np.array([ids[i]]), np.array([ids[after[i]]]))[0])
            if rank != NONE:
                current[i] = rank
                heapq.heappush(heap, (rank, i))

    while heap:
        rank, i = heapq.heappop(heap)
        if current.get(i) != rank:
            continue
        gone = after[i]
        current.pop(gone, None)
        ids[i], ids[gone], after[i] = rank, -1, after[gone]
        if after[i] < n:
            before[after[i]] = i
        look(i)
        if before[i] >= 0:
            look(before[i])
    return np.array([x for x in ids if x >= 0], np.int32)


def merge(pieces: list[bytes], known: Vocabulary) -> list[np.ndarray]:
    """Ids of each piece."""
    lengths = np.array([len(p) for p in pieces])
    found: list = [None] * len(pieces)
    edges = [1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, MATRIX_BYTES]
    bucket = np.searchsorted(edges, lengths)
    for k, edge in enumerate(edges):
        members = np.flatnonzero(bucket == k)
        for start in range(0, len(members), 50_000):
            some = members[start:start + 50_000]
            flat = np.frombuffer(b"".join(pieces[i].ljust(edge, b"\0") for i in some), np.uint8)
            rows = known.byte_ranks[flat.reshape(len(some), edge)]
            rows[np.arange(edge) >= lengths[some, None]] = -1
            for i, ids in zip(some, _merge_rows(rows, known)):
                found[i] = ids
    for i in np.flatnonzero(bucket == len(edges)):
        found[i] = _merge_long(known.byte_ranks[np.frombuffer(pieces[i], np.uint8)], known)
    return found


def unit_encoder(known: Vocabulary, pattern: str) -> UnitEncoder:
    import regex

    split = regex.compile(pattern)

    def encode(pieces: list[str], counts: np.ndarray) -> Encoded:
        distinct = list(set(pieces))
        place = dict(zip(distinct, range(len(distinct))))
        merged = merge([piece.encode() for piece in distinct], known)
        sizes = np.fromiter(map(len, merged), np.int64)
        flat = np.concatenate([*merged, np.zeros(0, np.int32)])
        at = np.fromiter(map(place.__getitem__, pieces), np.int64)
        lengths = np.diff(offsets_of(sizes[at])[offsets_of(counts)])
        return flat[ragged(offsets_of(sizes)[at], sizes[at])], lengths

    def one_by_one(units: list[str]) -> Encoded:
        pieces = [split.findall(unit) for unit in units]
        return encode(list(chain.from_iterable(pieces)), np.fromiter(map(len, pieces), np.int64))

    def together(units: list[str]) -> Encoded:
        """Only the first piece of each unit starts with a space."""
        pieces = split.findall("".join(units))
        first = [i for i, piece in enumerate(pieces) if piece[0] == " "]
        return encode(pieces, np.diff([*first, len(pieces)]))

    return UnitEncoder(together, one_by_one)


def decode(ids: np.ndarray, known: Vocabulary) -> np.ndarray:
    starts = known.token_starts[ids]
    return known.token_bytes[ragged(starts, known.token_starts[ids + 1] - starts)]


def encode_documents(docs: DataFrame, rank_file: str, pattern: str,
                     with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256; ``with_ids`` adds the ids.

    ``rank_file`` is read on the driver; the table made of it depends on the vocabulary only. A null
    or empty text has no ids. Strings of special tokens are ordinary text. Repeated rows and null
    ids of documents are encoded like others; columns other than doc_id and text are not looked at. Long
    texts are encoded whole, and an empty table gives an empty result.
    """
    with open(rank_file, "rb") as lines:
        # Plain arrays, so that reading them needs no copy of this package.
        shared = docs.sparkSession.sparkContext.broadcast(vars(vocabulary(lines.read())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(**shared.value)
        encoder = unit_encoder(known, pattern)
        for part, texts in chunks(batches, 1):
            ids, edges = encoder.encode(texts)
            back = decode(ids.astype(np.int64), known)
            sizes = offsets_of((known.token_starts[1:] - known.token_starts[:-1])[ids])[edges]
            little = ids.astype("<u4")
            of_ids = [hashlib.sha256(little[a:b]).hexdigest() for a, b in zip(edges, edges[1:])]
            of_text = [hashlib.sha256(back[a:b]).hexdigest() for a, b in zip(sizes, sizes[1:])]
            columns = [part.column(0), pa.array(np.diff(edges)), pa.array(of_ids, pa.string()),
                       pa.array(of_text, pa.string())]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(
                    pa.array(edges, pa.int32()), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if with_ids else ""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    return rows.mapInArrow(run, schema)
