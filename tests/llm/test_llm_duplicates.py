"""Fingerprints, trie join, components and repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from xxhash import xxh64_intdigest

from envstream.llm import near, simhash, spans
from envstream.llm.components import components


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = word_list(lowered)
    shingles = ([" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2
                else [" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(nodes, linked):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {n: root(n) for n in nodes}


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def near_values(n, seed, centres=8):
    """Values in dense groups, so that most have several neighbours within two bits."""
    rng = random.Random(seed)
    middle = [rng.getrandbits(64) for _ in range(centres)]
    found = {0, (1 << 64) - 1}
    while len(found) < n:
        value = rng.choice(middle)
        for _ in range(rng.randint(0, 5)):
            value ^= 1 << rng.randrange(64)
        found.add(value)
    return sorted(found)


@pytest.mark.parametrize("budget,node_rows,chunk", [
    (2, 4096, 100_000), (2, 6, 100_000), (2, 20, 20), (1, 4, 50), (3, 12, 100_000)])
def test_trie_join_finds_every_link(spark, monkeypatch, budget, node_rows, chunk):
    monkeypatch.setattr(simhash, "NODE_ROWS", node_rows)
    monkeypatch.setattr(simhash, "CHUNK_ROWS", chunk)
    values = near_values(150, budget)
    frame = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
    found = {(min(r.a, r.b), max(r.a, r.b)) for r in simhash.links(frame, budget).collect()}
    near = {(a, b) for a in map(signed, values) for b in map(signed, values)
            if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= budget}
    assert found <= near
    nodes = [signed(v) for v in values]
    assert groups_of(nodes, lambda a, b: (a, b) in found) == groups_of(
        nodes, lambda a, b: (a, b) in near)


def test_trie_links_in_one_task_are_all_pairs():
    leaves = np.array(near_values(200, 9), np.uint64)
    starts = np.zeros(len(leaves), bool)
    starts[0] = True
    pairs = simhash.trie_links(leaves, starts, np.zeros(len(leaves), bool),
                               np.zeros(len(leaves), np.int64) + 0, 2)
    wanted = {(i, j) for i in range(len(leaves)) for j in range(i + 1, len(leaves))
              if int(leaves[i] ^ leaves[j]).bit_count() <= 2}
    assert {tuple(sorted(p)) for p in pairs.T.tolist()} == wanted and pairs.shape[1] == len(wanted)


def test_fingerprints_and_groups(awkward, documents):
    rows = awkward.collect()
    prints = {(r.doc_id, r.text): fingerprint(r.text) for r in rows}
    found = simhash.groups(awkward).collect()
    assert sorted((str(r.doc_id), r.fingerprint) for r in found) == sorted(
        (str(r.doc_id), f"{prints[r.doc_id, r.text]:016x}") for r in rows)
    root = groups_of(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (doc_id, _), value in prints.items():
        if doc_id is not None:
            least[root[value]] = min(doc_id, least.get(root[value], doc_id))
    for row in found:
        assert row.component_id == least.get(root[int(row.fingerprint, 16)])
    assert simhash.groups(documents([])).count() == 0


def test_first_rows_keep_one_of_each_group(awkward, documents):
    kept = simhash.first_rows(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "6", "7", "8", "None"]
    assert simhash.first_rows(documents([])).count() == 0


@pytest.mark.parametrize("first_rows", [simhash.first_rows, near.first_rows])
def test_null_and_repeated_ids_leave_one_row_of_each_group(documents, first_rows):
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(1, one), (1, two), (None, two), (None, three), (None, three), (None, three.upper()), (2, one),
            (3, "x y"), (3, "x y"), (3, None), (3, "")]
    docs = documents([(i, text, "en", "a", 1) for i, text in rows])
    kept = [(r.doc_id, (r.text or "").lower()) for r in first_rows(docs).collect()]
    assert sorted(kept, key=str) == sorted([(1, one), (1, two), (None, three), (3, "x y"), (3, "")], key=str)


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)],
    [(random.Random(4).randrange(80), i) for i in range(80)], [(5, 9), (9, 5), (5, 9), (7, 8)],
    [(i, (i * 7 + 3) % 90) for i in range(90)]])
def test_components(spark, edges):
    found = {r.node: r.root for r in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges for x in e})
    linked = set(edges) | {(b, a) for a, b in edges}
    wanted = groups_of(nodes, lambda a, b: (a, b) in linked)
    assert found == {n: r for n, r in wanted.items() if n != r}


def test_components_of_stars_take_no_round(spark, monkeypatch):
    """Every round is a table of links; none is made only to see that nothing changes."""
    from envstream.llm import components as module

    tables, written = [], module.written
    monkeypatch.setattr(module, "written", lambda *args: tables.append(args) or written(*args))
    for edges, rounds in ([(0, 3), (3, 0), (0, 4), (1, 5)], 0), ([(4, 3), (4, 1), (1, 2)], 1), ([], 0):
        tables.clear()
        found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert found == ({3: 0, 4: 0, 5: 1} if len(edges) == 4 else {2: 1, 3: 1, 4: 1} if edges else {})
        assert len(tables) == 1 + rounds


# Near duplicates of the pipeline.

def shingle_set(text):
    words = word_list("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def near_texts(seed):
    """Chains of copies with more and more words changed, around and on both sides of 0.8."""
    rng = random.Random(seed)
    texts = []
    for start in range(6):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([60, 200, 700]))]
        for _ in range(12):
            texts.append(" ".join(words))
            if rng.random() < .7:
                words = list(words)
            for _ in range(max(1, int(len(words) * rng.choice([0, .005, .02, .05])))):
                words[rng.randrange(len(words))] = f"w{rng.randrange(500)}"
    return [*texts, "", " ", "one two", "One  two", "one three", "a b c d e", "a b c d f"]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_are_those_of_brute_force(documents, seed):
    texts = near_texts(seed)
    docs = documents([(i, text, "en", "a", 1) for i, text in enumerate(texts)])
    sets = list(map(shingle_set, texts))
    root = groups_of(range(len(texts)), lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    found = {}
    for row in near.groups(docs).collect():
        found.setdefault(row.root, set()).add(row.doc_id)
    wanted = {}
    for i, r in root.items():
        wanted.setdefault(r, set()).add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, wanted.values()))
    assert 10 < len(wanted) < len(set(texts)) - 10
    assert {r.doc_id for r in near.first_rows(docs).collect()} == set(map(min, wanted.values()))


def test_near_duplicates_need_no_shared_key(spark, documents):
    """Of similarity 0.8, and by chance without a min-hash key in common: such pairs were left out."""
    texts = ["w631 w747 w161 w242 w720 w148 w634 w891 w424", "w839 w887 w522 w789 w585 w996 w352 w280 w205"]
    for text in texts:
        a, b = (near.shingles(near.words_in(t)) for t in (text, text.rsplit(" ", 1)[0]))
        assert near.near(a, b) and not set(near.band_keys(a)) & set(near.band_keys(b))
    docs = documents([(10 * i + j, t, "en", "a", 1) for i, text in enumerate(texts)
                      for j, t in enumerate([text, text.rsplit(" ", 1)[0], text.rsplit(" ", 2)[0]])])
    # Without two words the similarity to the longest is 0.6, but 0.75 to the one between.
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == [0, 2, 10, 12]


@pytest.mark.parametrize("seed", [3, 4])
def test_near_duplicates_are_those_of_brute_force_without_any_key(documents, monkeypatch, seed):
    rng = random.Random(seed)

    def band_keys(hashes):  # no two nodes share one
        return hashes[0] ^ np.uint64(len(hashes)) ^ np.array(
            [xxh64_intdigest(hashes.tobytes(), i) for i in range(near.BANDS)], np.uint64)

    monkeypatch.setattr(near, "band_keys", band_keys)
    passage = [f"p{i}" for i in range(30)]
    texts = [t if rng.random() < .5 else " ".join([t, *passage]) for t in near_texts(seed)]
    sets = list(map(shingle_set, texts))
    root = groups_of(range(len(texts)), lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    wanted = {}
    for i, r in root.items():
        wanted.setdefault(r, set()).add(i)
    found = {}
    docs = documents([(i, text, "en", "a", 1) for i, text in enumerate(texts)])
    for row in near.groups(docs).collect():
        found.setdefault(row.root, set()).add(row.doc_id)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, wanted.values()))
    assert 10 < len(wanted) < len(set(texts)) - 5


def test_first_hashes_of_near_sets_meet():
    """Both bounds on nodes, where they are tight: sizes on both sides of each step, subsets and overlaps."""
    rng = np.random.default_rng(6)
    for size in [*range(1, 130), 1000]:
        for lacking in {0, size // 5}:
            pool = np.unique(rng.integers(0, 1 << 64, 3 * size, np.uint64))
            rng.shuffle(pool)
            a, shared = np.sort(pool[:size]), pool[lacking:size]
            more = len(shared) * 5 // 4 - size  # as many as similarity 0.8 allows
            b = np.sort(np.concatenate([shared, pool[size:size + more]]))
            assert near.near(a, b)
            met = len(np.intersect1d(near.first_hashes(a), near.first_hashes(b)))
            for one in (a, b):
                assert met >= 1 + near.NEAR * len(one) // (near.OF * near.MORE)


def test_near_duplicates_leave_the_pipeline(spark, documents):
    rng = random.Random(8)
    words = [f"w{rng.randrange(900)}" for _ in range(400)]
    other = list(words)
    for i in (20, 120, 220, 320):  # of similarity 0.9, and some bits of the fingerprint apart
        other[i] = "changed"
    docs = documents([(1, " ".join(words), "en", "a", 1), (2, " ".join(other), "en", "a", 1)])
    assert simhash.first_rows(docs).count() == 2
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()] == [1]


def test_near_duplicates_of_awkward_rows(awkward, documents):
    kept = near.first_rows(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "6", "7", "8", "None"]
    assert near.first_rows(documents([])).count() == 0


# Repeated passages.

def without_repeats(texts, window):
    words = [word_list(t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        yield len(w), sum(gone), " ".join(x for x, out in zip(w, gone) if not out)


def passage_texts(seed):
    rng = random.Random(seed)
    passages = [" ".join(f"p{k}w{rng.randrange(50)}" for _ in range(rng.randint(20, 90))) for k in range(6)]
    texts = []
    for _ in range(60):
        parts = [" ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randint(0, 40)))
                 for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            words = rng.choice(passages).split()
            if rng.random() < .5:
                words[rng.randrange(len(words))] = "edit"
            parts.insert(rng.randrange(4), " ".join(words[rng.randrange(5):]))
        texts.append(rng.choice([" ", "\n", "\t"]).join(parts))
    return [*texts, texts[0], texts[1], "same " * 100, "same " * 34, "a b " * 60, "", None,
            " ".join(f"v{i}" for i in range(35)), " ".join(f"v{i}" for i in range(35))]


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True), (3, True)])
def test_repeated_passages(documents, monkeypatch, seed, hot):
    if hot:  # every gram of more than one entry is dealt to sub-blocks
        monkeypatch.setattr(spans, "SAMPLE", 1)
        monkeypatch.setattr(spans, "HOT_LEAST", 1)
        monkeypatch.setattr(spans, "HOT_SHARE", 0.0)
        monkeypatch.setattr(spans, "SALTS", 3)
        monkeypatch.setattr(spans, "CHUNK_ROWS", 50)
    texts = passage_texts(seed)
    rows = documents([(i, t, "en", "a", 1) for i, t in enumerate(texts)], extra=True).repartition(4)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in spans.digest(rows).collect()}
    for i, (n, removed, kept) in enumerate(without_repeats(texts, 35)):
        assert found[i] == (n, removed, hashlib.sha256(kept.encode()).hexdigest()), i


def test_awkward_passages(awkward, documents):
    wanted = Counter((str(r.doc_id), *one[:2]) for r, one in zip(
        awkward.collect(), without_repeats([r.text for r in awkward.collect()], 35)))
    assert Counter((str(r.doc_id), r.n_words, r.n_removed) for r in spans.digest(awkward).collect()) == wanted
    assert spans.digest(documents([])).count() == 0


def test_least_is_a_sliding_minimum():
    values = np.array([5, 3, 3, 9, 1, 1, 7, 2], np.uint64)
    for width in range(1, 9):
        wanted = [i + int(np.argmin(values[i:i + width])) for i in range(len(values) - width + 1)]
        assert spans._least(values, width).tolist() == wanted
