"""Token files, whitening and ranked search, against the library, numpy and plain loops."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from envstream.llm import pieces, ranked, tokenfiles, whitening

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def awkward_texts(n=3000):
    rng = random.Random(5)
    parts = [" ", "  ", "a", "the", " of", "\n", "\n\n", "'s", "'S", "1", "12", "é", "É", "\t", "　", "#", "!!",
             "\x1c", "​", "日本", "😀", "<|endoftext|>", "<|startoftext|>", "\x00", "\u0085", "\xa0", "ß", "×",
             "ª", "²", "Σ", "İ", "́", " ́", "don't", "I'LL", "\r", "...", "Ö", ".", "</w>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [*texts, "", " ", "  ", "a ", " a", "a\n", "a  ", "a" * 3000, "ab " * 700]


@pytest.mark.parametrize("keep", [10, 400_000])
@pytest.mark.parametrize("file", [WORDS, BYTES])
def test_pieces_agree_with_the_library(file, keep, monkeypatch):
    monkeypatch.setattr(pieces, "KEEP_PIECES", keep)
    with open(file, encoding="utf-8") as source:
        vocabulary = source.read()
    for special_as_text in (False, True):
        library = Tokenizer.from_str(vocabulary)
        library.encode_special_tokens = special_as_text
        encoder = pieces.PieceEncoder(vocabulary, special_as_text)
        texts = awkward_texts()
        for some in (texts, texts[::-1], texts[:1], []):  # later ones find pieces known or forgotten
            ids, edges = encoder.encode(pa.array(some, pa.string()))
            assert edges[-1] == len(ids)
            wanted = library.encode_batch(some, add_special_tokens=False)
            for a, b, one in zip(edges, edges[1:], wanted):
                assert ids[a:b].tolist() == one.ids


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1))))
@settings(max_examples=200, deadline=None)
def test_numbers_come_back(values):
    packed = tokenfiles.pack_numbers(np.array(values, np.uint32))
    assert tokenfiles.unpack_numbers(*packed, len(values)).tolist() == values
    assert len(packed[0]) == -(-len(values) // 4)
    assert len(packed[1]) == sum(max(1, (v.bit_length() + 7) // 8) for v in values)


def test_damaged_numbers_are_noticed():
    control, data = tokenfiles.pack_numbers(np.array([1, 300, 70_000]))
    for broken in ((control, data[:-1]), (control, data + b"x"), (b"", data)):
        with pytest.raises(ValueError):
            tokenfiles.unpack_numbers(*broken, 3)


def test_token_files(awkward, documents, monkeypatch):
    monkeypatch.setattr(tokenfiles, "BLOCK_IDS", 500)
    library = Tokenizer.from_file(WORDS)
    extra = documents([(i % 7, f"text {i} # of <|endoftext|> {i % 3}", "en", "a", 1) for i in range(300)], True)
    for docs in (awkward, extra):
        found = tokenfiles.document_spans(docs, WORDS, 2, with_ids=True).orderBy("start").collect()
        assert len(found) == docs.count()
        wanted = Counter((r.doc_id, tuple(library.encode(r.text or "", add_special_tokens=False).ids) + (2,))
                         for r in docs.select("doc_id", "text").collect())
        assert wanted == Counter((r.doc_id, tuple(r.ids)) for r in found)
        at = 0
        for row in found:
            assert (row.start, row.n_tokens) == (at, len(row.ids))
            assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
            at += row.n_tokens
        known = [r.doc_id for r in found if r.doc_id is not None]
        assert known == sorted(known)
        assert [r.doc_id for r in found[len(known):]] == [None] * (len(found) - len(known))
    empty = tokenfiles.document_spans(documents([]), WORDS, 2)
    assert empty.count() == 0 and empty.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_frequent_ids_take_fewer_bytes(documents, tmp_path, spark):
    docs = documents([(i, "zebra zebra quagga", "en", "a", 1) for i in range(50)])
    ranks, blocks = tokenfiles.write_tokens(docs, WORDS, 2)
    tokenfiles.store_corpus(ranks, blocks, f"{tmp_path}/corpus")
    ranks, blocks = tokenfiles.read_corpus(spark, f"{tmp_path}/corpus")
    library = Tokenizer.from_file(WORDS)
    counts = Counter([i for t in ("zebra", "zebra", "quagga") for i in library.encode(t).ids] + [2])
    order = sorted(counts, key=lambda i: (-counts[i], i))
    assert tokenfiles.id_table(ranks)[:len(order)].tolist() == order
    # All ids have ranks below 256, so one byte each.
    assert all(len(r.data) == r.n_ids for r in blocks.collect())
    assert tokenfiles.read_tokens(ranks, blocks).count() == 50


def embeddings(spark, vectors):
    return spark.createDataFrame(
        [(i, v, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, whitened string")


def plain_whitening(vectors):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)) + 1_000_000
    n, apart = len(x), x - x.mean(axis=0)
    values, directions = np.linalg.eigh(apart.T @ apart / n)
    return x, values[::-1], apart @ directions[:, ::-1]


def test_whitening(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 40)) * np.linspace(3, 0.5, 40)).tolist()
    odd = [None, [], [1.0] * 39, [float("nan")] + [0.0] * 39, [float("inf")] + [0.0] * 39, [None] + [0.0] * 39]
    frame = embeddings(spark, vectors + odd)
    rows = whitening.whitened(frame).toPandas()
    x, values, scores = plain_whitening(vectors)
    n = len(x)
    assert sorted(rows.vec_id.unique()) == list(range(n)) and set(rows.component) == set(range(1, 33))
    got = rows.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    wanted = scores[:, :32] / np.sqrt(values[:32])
    signs = np.sign((got * wanted).sum(axis=0))
    assert np.abs(got - signs * wanted).max() < 1e-9
    one = rows.drop_duplicates("component").sort_values("component")
    assert np.allclose(one.explained, values[:32] / values.sum(), rtol=1e-10)
    assert 0 <= rows.identity_error.max() < 1e-10 and rows.identity_error.nunique() == 1
    sums = [int(s) for s in x.sum(axis=0)]
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert rows.drop_duplicates("vec_id").sort_values("vec_id").deviation.tolist() == exact
    assert set(rows.n) == {n}


def test_whitening_of_few_directions(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-500, 500, (50, 3)) / 64
    vectors = np.hstack([base, base[:, :2], np.zeros((50, 2))]).tolist()
    rows = whitening.whitened(embeddings(spark, vectors)).toPandas()
    assert set(rows.component) == {1, 2, 3} and rows.identity_error.max() < 1e-10
    assert abs(rows.drop_duplicates("component").explained.sum() - 1) < 1e-10
    for some in ([], [None], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 9):
        found = whitening.whitened(embeddings(spark, some))
        assert found.count() == 0 and found.columns == rows.columns.tolist()


def test_whitening_of_repeated_and_huge_rows(spark):
    frame = spark.createDataFrame(
        [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [2.0, 1.5]), (3, [3.0e38, 7.0])],
        "vec_id long, embedding array<float>")
    rows = whitening.whitened(frame).collect()
    ids = Counter(r.vec_id for r in rows)
    assert ids[1] == 2 * ids[3] == 2 * ids[None]
    # (n x - S) ** 2 of the huge entry needs more than 63 bits.
    assert {r.deviation for r in rows if r.vec_id == 3} == {None}


@pytest.mark.parametrize("kind", ["random", "graded", "deficient", "repeated"])
def test_factor_and_rotations(kind):
    rng = np.random.default_rng(9)
    a = rng.normal(size=(60, 17))
    if kind == "graded":
        a *= np.logspace(0, -6, 17)
    elif kind == "deficient":
        a[:, 5:] = a[:, :12]
    elif kind == "repeated":
        a = np.linalg.qr(a)[0]
    matrix = a.T @ a
    factor, order = whitening.pivoted_cholesky(matrix)
    assert np.allclose(factor @ factor.T, matrix[np.ix_(order, order)], atol=1e-12)
    assert np.all(np.triu(factor[:factor.shape[1]], 1) == 0)
    turned = whitening.one_sided_jacobi(factor)
    assert np.allclose(turned @ turned.T, factor @ factor.T, atol=1e-12)
    values, vectors = whitening.components(matrix)
    assert len(values) == np.linalg.matrix_rank(a) and np.all(np.diff(values) <= 0)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.allclose(matrix @ vectors, vectors * values, atol=1e-12 * values[0])


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(b): chr(b + 32) for b in range(65, 91)})


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, k):
    held = [(i, Counter(plain_terms(text))) for i, text in docs]
    sizes = [sum(c.values()) for _, c in held]
    many, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        wanted, scores = set(plain_terms(text)), []
        for (doc, counts), n in zip(held, sizes):
            score = 0
            for term in wanted & set(counts):
                tf, m = counts[term], 100 - 50 + (50 * n * many) // total
                weight = math.floor(1000 * math.log((2 * many + 2) / (2 * df[term] + 1)))
                score += weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (score, unnamed, doc) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, None if unnamed else doc, -score))
    return Counter(out)


def some_documents(rng, n):
    vocabulary = [f"w{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("window", [4, 512])
@pytest.mark.parametrize("short", [0.0, 1 / 64, 0.3, 1.0])
def test_ranked_search(spark, monkeypatch, window, short):
    monkeypatch.setattr(ranked, "BLOCK_ROWS", 150)
    monkeypatch.setattr(ranked, "WINDOW", window)
    monkeypatch.setattr(ranked, "SHORT", short)
    rng = random.Random(8)
    docs = some_documents(rng, 900)
    docs += [(5000 - i, text) for i, text in docs[:200]]  # ties by the hundred
    items = [(i, text) for i, (_, text) in enumerate(some_documents(rng, 25))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = ranked.search(frame, asked, k=10).collect()
    assert Counter(map(tuple, found)) == plain_search(docs, items, 10)


def test_ranked_search_in_parts(spark, monkeypatch):
    monkeypatch.setattr(ranked, "PART_BYTES", 300)
    rng = random.Random(9)
    docs, items = some_documents(rng, 200), some_documents(rng, 20)
    found = ranked.search(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"), k=5).collect()
    assert Counter(map(tuple, found)) == plain_search(docs, items, 5)


def test_ranked_search_of_awkward_rows(spark, awkward, documents):
    items = [(1, "WORD a text é"), (1, "word"), (2, None), (3, ""), (4, " .,-"), (None, "w1 w2 W3 w3"),
             (6, "x" * 200_000), (7, "ﬀ　ß"), (8, "nowhere")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    found = Counter(map(tuple, ranked.search(awkward, asked).collect()))
    assert found == plain_search(docs, items, 50) and found[(1, 1, None, 0)] == 0
    assert ranked.search(documents([]), asked).count() == 0
    assert ranked.search(awkward, asked.limit(0)).count() == 0


def test_terms_of_slices():
    texts = pa.array(["A-b", "", "É é\x00Zz9", None, "  x  "])
    for part in (texts, texts[2:], texts[1:2]):
        flat, n = ranked.terms(part.fill_null(""))
        values = [plain_terms(t) for t in part.to_pylist()]
        assert flat.to_pylist() == [t for v in values for t in v] and n.tolist() == [len(v) for v in values]
