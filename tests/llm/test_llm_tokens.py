"""Encoding, separator scan and packing against the tokenizer libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import psutil
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from envstream.llm import bpe, packing, pieces, separators, tokenfiles, units

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LIBRARY = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def known():
    with open(RANKS, "rb") as lines:
        return bpe.vocabulary(lines.read())


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(LIBRARY)
    tokenizer.encode_special_tokens = True
    return tokenizer


def some_texts(n=2000):
    rng = random.Random(5)
    parts = [" ", "  ", "a", "the", " of", "\n", "'s", "1", "é", "\t", "　", "#", "!!", "\x1c", "​",
             "日本", "😀", "<|endoftext|>", "\x00", "\u0085"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [*texts, "", "a" * 3000, "ab" * 700, "".join(rng.choice("abcdefgh") for _ in range(5000)),
            "a\n", "b a\n c", "a\n b"]


def test_encoders_agree_with_the_libraries(reference, known, library):
    texts = some_texts()
    with open(LIBRARY, encoding="utf-8") as source:
        by_pieces = pieces.PieceEncoder(source.read(), special_as_text=True)
    for encode in (bpe.unit_encoder(known, PATTERN).encode, lambda some: by_pieces.encode(pa.array(some))):
        for some in (texts, texts[::-1]):  # the second time units are known already
            ids, edges = encode(some)
            for text, a, b in zip(some, edges, edges[1:]):
                assert ids[a:b].tolist() == reference.encode_ordinary(text) == library.encode(
                    text, add_special_tokens=False).ids
                assert bpe.decode(ids[a:b].astype(np.int64), known).tobytes() == text.encode()


def test_units_are_forgotten_without_harm(known, reference, monkeypatch):
    monkeypatch.setattr(units, "KEEP_UNITS", 10)
    encoder = bpe.unit_encoder(known, PATTERN)
    for text in some_texts(100):
        assert encoder.encode([text])[0].tolist() == reference.encode_ordinary(text)


def test_encode_documents(awkward, documents, reference):
    texts = {(r.doc_id, r.text) for r in awkward.collect()}
    rows = bpe.encode_documents(awkward, RANKS, PATTERN, with_ids=True).collect()
    assert len(rows) == awkward.count()
    for row in rows:
        assert any(i == row.doc_id and reference.encode_ordinary(t or "") == row.ids
                   and row.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
                   for i, t in texts)
        assert row.n_tokens == len(row.ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(row.ids, "<u4").tobytes()).hexdigest()
    assert bpe.encode_documents(documents([]), RANKS, PATTERN).count() == 0


# Separator scan.

def expected_documents(ids, separator):
    found, start = [], 0
    for i, x in enumerate(ids):
        if x == separator:
            found.append((start, i - start, True))
            start = i + 1
    return found + ([(start, len(ids) - start, False)] if start < len(ids) else [])


@pytest.mark.parametrize("span", [2, 1024])
def test_scan_stitches_blocks(spark, tmp_path, monkeypatch, span):
    monkeypatch.setattr(separators, "SPAN", span)
    rng = random.Random(3)
    files = {
        "mixed": [rng.choice([9, 9, 9, 1, 2, 3]) for _ in range(101)], "none": [1] * 50, "empty": [],
        "only": [9] * 23, "long": [1] * 37 + [9] + [2] * 40 + [9], "edge": [1] * 7 + [9] + [2] * 8,
    }
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u4").tobytes())
    blocks = separators.read_flat_files(spark, str(tmp_path), block_ids=8)
    found = {}
    for row in separators.scan(blocks, 9, block_ids=8).collect():
        found.setdefault(row.file.rsplit("/", 1)[1], []).append(
            (row.ordinal, row.start, row.n_tokens, row.closed))
    for name, ids in files.items():
        wanted = [(i, *one) for i, one in enumerate(expected_documents(ids, 9))]
        assert sorted(found.get(name, [])) == wanted, name


def test_document_tokens(awkward, documents, reference, monkeypatch):
    monkeypatch.setattr(separators, "SPAN", 2)
    rows = separators.document_tokens(awkward, LIBRARY, 50256).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == sorted(
        (str(r.doc_id), len(reference.encode_ordinary(r.text or ""))) for r in awkward.collect())
    assert separators.document_tokens(documents([]), LIBRARY, 50256).count() == 0


def test_ragged_file_is_refused(spark, tmp_path):
    (tmp_path / "bad").write_bytes(b"\0" * 6)
    with pytest.raises(Exception, match="whole ids"):
        separators.read_flat_files(spark, str(tmp_path)).count()


# Packing.

def check_packing(rows, docs, library, capacity):
    by_doc, by_sequence = {}, {}
    for row in rows:
        by_doc.setdefault(row.doc_id, []).append(row)
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        n = -(-len(ids) // capacity)
        first = len(ids) - (n - 1) * capacity
        starts = [0] + [first + i * capacity for i in range(n - 1)]
        assert [p.start for p in pieces] == starts and [p.piece for p in pieces] == list(range(n))
        for piece, a, b in zip(pieces, starts, [*starts[1:], len(ids)]):
            assert (piece.length, piece.ids_crc32) == (
                b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
    return len(by_sequence)


def test_pack(awkward, documents, library):
    rng = random.Random(2)
    docs = [(i, " ".join("word" for _ in range(int(rng.expovariate(1 / 60)))), "en", "a", 1)
            for i in range(400)]
    docs += [(r.doc_id, r.text, r.lang, r.source, 1) for r in awkward.dropDuplicates(["doc_id"]).collect()
             if r.doc_id is not None and r.doc_id > 5]
    docs = [(k, *row[1:]) for k, row in enumerate(docs)]
    rules = packing.Rules(capacity=128)
    rows = packing.pack(documents(docs, extra=True).repartition(5), LIBRARY, rules).collect()
    used = check_packing(rows, [(d[0], d[1]) for d in docs], library, 128)
    assert used <= 1.03 * (-(-sum(r.length for r in rows) // 128)) + 1
    assert packing.pack(awkward, LIBRARY).count() >= awkward.count()
    assert packing.pack(documents([]), LIBRARY).count() == 0


def test_packed_ids_are_those_of_a_plain_library_call(documents):
    plain = Tokenizer.from_file(LIBRARY)
    texts = some_texts(300) + ["<|endoftext|>", "one <|endoftext|> two<|endoftext|>", "a <|endoftext|>b  c"]
    docs = [(i, text, "en", "a", 1) for i, text in enumerate(texts)]
    rows = packing.pack(documents(docs), LIBRARY, packing.Rules(capacity=128)).collect()
    check_packing(rows, [(d[0], d[1]) for d in docs], plain, 128)
    assert plain.encode("<|endoftext|>", add_special_tokens=False).ids == [50256]


@pytest.mark.parametrize("counts", [
    {}, {1: 1}, {2048: 5}, {1: 5000}, {1025: 10}, {700: 9, 648: 9, 1400: 9}, {300: 7, 1700: 2, 3: 100},
    {n: n % 13 for n in range(1, 2049)},
])
def test_plan_places_every_piece_once(counts):
    plan = packing.Plan(counts)
    used, placed = np.zeros(plan.sequences, np.int64), {}
    for length, rank, n, first, offset in plan.runs:
        assert (used[first:first + n] == offset).all()
        used[first:first + n] += length
        assert placed.get(length, 0) == rank or rank >= 0
        placed[length] = placed.get(length, 0) + n
    assert placed == {n: many for n, many in counts.items() if many}
    assert (used <= 2048).all() and (used > 0).all()


def test_plan_size_does_not_follow_the_input():
    few = {n: 1 + n % 17 for n in range(1, 2049)}
    many = {n: 10_000 * c for n, c in few.items()}
    assert len(packing.Plan(many).runs) < 3 * len(packing.Plan(few).runs)


def worker_memory():
    """MB of each Python worker's own memory."""
    found = {}
    for process in psutil.Process().children(recursive=True):
        try:
            if "pyspark" in " ".join(process.cmdline()) and "python" in process.name():
                found[process.pid] = process.memory_full_info().uss / 1e6
        except psutil.Error:
            pass
    return found


@pytest.mark.parametrize("encode", [
    lambda docs: tokenfiles.document_spans(docs, WORDS, 2), lambda docs: packing.pack(docs, LIBRARY)])
def test_workers_give_back_their_memory(spark, documents, encode):
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(50)), lambda i: F.md5(
        F.concat_ws("-", "id", i.cast("string")))), " ")
    docs = spark.range(16_000, numPartitions=2).select(F.col("id").alias("doc_id"), text.alias("text"))
    before = worker_memory()
    assert encode(docs).count() >= 16_000
    grown = [mb - before.get(pid, 0) for pid, mb in worker_memory().items()]
    assert max(grown) < 110


def test_small_tables_need_no_python_worker(spark, documents):
    """Plans and ranks come from the driver as Arrow; rows of Python objects are made in workers."""
    docs = documents([(1, "some words", "en", "a", 10), (2, None, None, None, None)])
    for made in (packing.pack(docs, LIBRARY), tokenfiles.write_tokens(docs, WORDS, 2)[0]):
        assert "Scan ExistingRDD" not in made._jdf.queryExecution().toString()
