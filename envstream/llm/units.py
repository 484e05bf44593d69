"""Encoding many texts at once through the distinct space-led units they consist of.

Where a space stands between two characters that are no white space, every pre-token pattern of
byte-level BPE starts a new piece at that space, so the ids of " word" depend on nothing around it.
A text is cut before such spaces, and every distinct unit is encoded once per task. A text in which
any space touches other white space is one unit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

#: Units kept between batches, and characters of text handled at a time. Neither changes a result.
KEEP_UNITS, CHUNK_CHARS = 300_000, 2_000_000

_MARK = "\x00"


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all members of the given stretches, one stretch after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - ends + lengths, lengths)


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def chunks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batches cut into rows of about ``CHUNK_CHARS``, with their texts; null reads as empty."""
    for batch in batches:
        sizes = np.cumsum(pa.compute.fill_null(
            pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + CHUNK_CHARS, "right")))
            part = batch.slice(start, end - start)
            yield part, [value or "" for value in part.column(text).to_pylist()]
            start = end


def cut(text: str) -> list[str]:
    """Units of a text, which they make up; behind a mark, the text itself."""
    if _MARK in text:
        return [_MARK + text]
    units = text.replace(" ", _MARK + " ").split(_MARK)
    return units if units[0] else units[1:]


def _stands_alone(unit: str) -> bool:
    body = unit[1:] if unit[0] == " " else unit
    return bool(body) and not body[0].isspace() and not body[-1].isspace()


Encoded = tuple[np.ndarray, np.ndarray]


class UnitEncoder:
    """Ids of texts, by two functions that give (flat ids, ids per unit) of a list of units.

    ``together`` gets units led by one space and otherwise free of spaces, ``one_by_one`` any others.
    """

    def __init__(self, together: Callable[[list[str]], Encoded],
                 one_by_one: Callable[[list[str]], Encoded]):
        self.together, self.one_by_one = together, one_by_one
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _learn(self, keys: list[str], encoded: Encoded) -> None:
        ids, lengths = encoded
        first = len(self.index)
        self.index.update(zip(keys, range(first, first + len(keys))))
        self.starts = np.concatenate([self.starts, len(self.pool) + offsets_of(lengths)[:-1]])
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.int64)])
        self.pool = np.concatenate([self.pool, ids.astype(np.uint32)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and where each text starts in them (one entry more)."""
        if len(self.index) > KEEP_UNITS:
            self._forget()
        pieces = [cut(text) for text in texts]
        new = set().union(*pieces).difference(self.index)
        whole = {unit for unit in new if unit[0] == _MARK or not _stands_alone(unit)}
        if whole:
            # A mark in front tells a whole text from a unit that reads the same.
            pieces = [units if whole.isdisjoint(units) else [_MARK + text]
                      for text, units in zip(texts, pieces)]
            new = set().union(*pieces).difference(self.index)
        led = [unit for unit in new if unit[0] == " "]
        others = [unit for unit in new if unit[0] != " "]
        if led:
            self._learn(led, self.together(led))
        if others:
            self._learn(others, self.one_by_one([u.removeprefix(_MARK) for u in others]))
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(pieces)), np.int64)
        lengths = self.lengths[at]
        ids = self.pool[ragged(self.starts[at], lengths)]
        counts = np.fromiter(map(len, pieces), np.int64)
        return ids, offsets_of(lengths)[offsets_of(counts)]
