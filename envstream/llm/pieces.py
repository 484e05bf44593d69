"""Ids of many texts at once, as the tokenizers library gives them, through the distinct pieces.

Texts are split at spaces by Arrow and each distinct unit is looked at once. Units of plain letters,
digits and ASCII signs are split into pre-tokens by the vocabulary's own pattern, and each distinct
pre-token is merged by the library's BPE model once per task. All other units (other scripts, marks,
control characters, strings that look like special tokens) go to the library as they are.

Cutting is safe where a pre-token can't cross it. The word vocabulary drops white space, so every space
is such a place. For the byte vocabulary a space between two characters that are no white space starts
a new pre-token; a text with any other space is one unit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from envstream.llm.units import offsets_of, ragged

#: Pre-tokens kept between chunks, and characters handled at a time. Neither changes a result.
KEEP_PIECES, CHUNK_CHARS = 300_000, 4_000_000

_MARK = "\x00"
# Letters that normalisation leaves alone, in both cases.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = rf"^[ -~\t\n\r{_LETTERS[6:]}]*$"
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_WORD = re.compile(rf"{_MARK}|{_CONTRACTIONS}|[{_LETTERS}]+|[0-9]|[^\s{_MARK}{_LETTERS}0-9]+")
# The mark ends a text, where white space is one piece.
_BYTE = re.compile(
    rf"{_MARK}|{_CONTRACTIONS}| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_MARK}{_LETTERS}0-9]+"
    rf"|\s+(?![^\s{_MARK}])|\s+")
# Whatever any of the libraries takes for white space.
_BLANK = "[\\s\x0b\x1c-\x1f\x85\xa0  -     　]"


def _byte_alphabet() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


def slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """The batches cut into rows of about ``CHUNK_CHARS`` bytes, with their texts; null reads as empty."""
    for batch in batches:
        texts = pc.fill_null(batch.column(text), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + CHUNK_CHARS, "right")))
            yield batch.slice(start, end - start), texts.slice(start, end - start)
            start = end


def _strings(values: list[str]) -> pa.Array:
    return pa.array(values, pa.string())


def _joined(values: pa.Array) -> pa.Scalar:
    """All values in one string, with marks between them."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), _MARK)[0]


def _integers(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.int64)


class PieceEncoder:
    """Ids of a tokenizers vocabulary (its JSON text), without special tokens added.

    Strings of special tokens in a text are one id each, as the library has it by default, or plain text.
    """

    def __init__(self, vocabulary: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = special_as_text
        self.model = self.tokenizer.model
        self.by_word = bool(self.model.end_of_word_suffix)
        self.alphabet = {**_byte_alphabet(), 0: _MARK}
        self.names = _strings([])
        self.starts, self.lengths, self.uses = (np.zeros(0, np.int64) for _ in range(3))
        self.pool = np.zeros(0, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, none of them null, and where each starts in them (one entry more)."""
        units, at, counts = self._words(texts) if self.by_word else self._led_units(texts)
        ids, lengths = self._units(units)
        starts = offsets_of(lengths)[:-1]
        taken = lengths[at]
        return ids[ragged(starts[at], taken)], offsets_of(taken)[offsets_of(counts)]

    @staticmethod
    def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        parts = pc.split_pattern(texts, " ")
        found = parts.flatten().dictionary_encode()
        return found.dictionary, _integers(found.indices), _integers(pc.list_value_length(parts))

    @staticmethod
    def _led_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        parts = pc.split_pattern(texts, " ")
        flat, counts = parts.flatten(), _integers(pc.list_value_length(parts))
        edges = offsets_of(counts)
        is_first = np.zeros(len(flat), bool)
        is_first[edges[:-1]] = True
        first = flat.filter(pa.array(is_first)).dictionary_encode()
        led = flat.filter(pa.array(~is_first)).dictionary_encode()
        n_led = len(led.dictionary)
        at = np.empty(len(flat), np.int64)
        at[is_first], at[~is_first] = n_led + _integers(first.indices), _integers(led.indices)
        bare = pa.concat_arrays([led.dictionary, first.dictionary])

        def flags(pattern: str) -> np.ndarray:
            return pc.match_substring_regex(bare, pattern).to_numpy(zero_copy_only=False)

        # A space beside white space, or beside another space, is no place to cut.
        touched = flags(f"^{_BLANK}|^$")[at] & ~is_first
        is_last = np.zeros(len(flat), bool)
        is_last[edges[1:] - 1] = True
        touched |= flags(f"{_BLANK}$")[at] & ~is_last
        whole = np.logical_or.reduceat(touched, edges[:-1]) if len(counts) else np.zeros(0, bool)
        units = pa.concat_arrays([
            pc.binary_join_element_wise(" ", led.dictionary, ""), first.dictionary,
            texts.filter(pa.array(whole))])
        kept = ~np.repeat(whole, counts)
        counts = np.where(whole, 1, counts)
        out = np.empty(int(counts.sum()), np.int64)
        is_whole = np.repeat(whole, counts)
        out[~is_whole] = at[kept]
        out[is_whole] = len(bare) + np.arange(int(whole.sum()))
        return units, out, counts

    def _units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and ids per unit."""
        plain = pc.and_not(pc.match_substring_regex(units, _PLAIN), pc.match_substring(units, "<|"))
        ids, lengths = self._plain(units.filter(plain))
        is_plain = plain.to_numpy(zero_copy_only=False)
        if is_plain.all():
            return ids, lengths
        found = [x.ids for x in self.tokenizer.encode_batch(
            units.filter(pc.invert(plain)).to_pylist(), add_special_tokens=False)]
        other = np.fromiter(map(len, found), np.int64)
        both = np.concatenate([ids, np.fromiter(chain.from_iterable(found), np.uint32)])
        starts, sizes = np.empty(len(units), np.int64), np.empty(len(units), np.int64)
        starts[is_plain], sizes[is_plain] = offsets_of(lengths)[:-1], lengths
        starts[~is_plain], sizes[~is_plain] = len(ids) + offsets_of(other)[:-1], other
        return both[ragged(starts, sizes)], sizes

    def _plain(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(units):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        joined = _joined(units).as_py()
        pieces = (_WORD.findall(joined.lower()) if self.by_word else _BYTE.findall(joined))
        found = _strings(pieces).dictionary_encode()
        indices = _integers(found.indices)
        at = self._learned(found.dictionary, np.bincount(indices, minlength=len(found.dictionary)))
        starts, lengths = self.starts[at][indices], self.lengths[at][indices]
        ids = self.pool[ragged(starts, lengths)]
        mark = pc.index(found.dictionary, _MARK).as_py()
        ends = np.flatnonzero(indices == mark) if mark >= 0 else np.zeros(0, np.int64)
        sums = offsets_of(lengths)
        return ids, np.diff(np.concatenate([[0], sums[ends], sums[-1:]]))

    def _learned(self, pieces: pa.Array, occurrences: np.ndarray) -> np.ndarray:
        """Places of the pieces in the pool, which takes in what is new."""
        if len(self.names) > KEEP_PIECES:
            self._forget()
        at = pc.index_in(pieces, value_set=self.names)
        is_new = at.is_null()
        new = pieces.filter(is_new)
        at = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at[is_new.to_numpy(zero_copy_only=False)] = len(self.names) + np.arange(len(new))
        if len(new):
            # All pieces are mapped in one go; the mark itself has no ids.
            bare = pc.if_else(pc.equal(new, _MARK), "", new)
            mapped = _joined(bare).as_buffer().to_pybytes().decode("latin-1").translate(
                self.alphabet).split(_MARK)
            ids = [[token.id for token in self.model.tokenize(x)] if x else [] for x in mapped]
            lengths = np.fromiter(map(len, ids), np.int64)
            self.names = pa.concat_arrays([self.names, new])
            self.starts = np.concatenate([self.starts, len(self.pool) + offsets_of(lengths)[:-1]])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
            self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(ids), np.uint32)])
        self.uses[at] += occurrences
        return at

    def _forget(self) -> None:
        """Keeps the more used half."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[:KEEP_PIECES // 2])
        self.pool = self.pool[ragged(self.starts[kept], self.lengths[kept])]
        self.lengths, self.uses = self.lengths[kept], self.uses[kept] // 2
        self.starts = offsets_of(self.lengths)[:-1]
        self.names = self.names.take(pa.array(kept))
