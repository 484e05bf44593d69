"""Quality rules against plain Python."""

import math
import random
import re
from collections import Counter

import pytest

from envstream.llm import quality


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base_counts(text):
    words = word_list(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1
               for k in range(3)}
    lines = [line for line in (text or "").split("\n") if word_list(line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered), failed)


TEXTS = [
    "a b c a b c", "a b a b a b a", "one two three\none two three\n\none two three", "a\x0bb\x0cc d\r\ne",
    "# * $ % & | < >", "to be or not to be that is", "x y z", "\n".join(["same line"] * 60),
    " ".join(f"w{i}" for i in range(49)), " ".join(f"w{i}" for i in range(50)),
    " ".join(["again and again"] * 30 + [f"w{i}" for i in range(90)]),
]


def test_counts_agree_with_python(documents, awkward):
    rows = documents([(i, text, "en", "a", 1) for i, text in enumerate(TEXTS)])
    for frame, texts in ((rows, dict(enumerate(TEXTS))),
                         (awkward, {r.doc_id: r.text for r in awkward.collect()})):
        for row in quality.judge(frame).collect():
            assert tuple(row[1:7]) == base_counts(texts[row.doc_id]), row.doc_id
            assert not (row.base_failed and row.kept)


def test_distance_is_jensen_shannon(spark):
    from pyspark.sql import functions as F
    p, q = [3, 0, 5], [1, 4, 5]
    row = spark.range(1).select(quality.distance(
        F.array(*map(F.lit, p)).cast("array<long>"), F.array(*map(F.lit, q)).cast("array<long>"))
        .alias("d")).first()
    a, b = [x / 8 for x in p], [x / 10 for x in q]
    parts = sum(x * math.log2(2 * x / (x + y)) for u, v in ((a, b), (b, a)) for x, y in zip(u, v) if x)
    assert row.d == pytest.approx(math.sqrt(parts / 2))


def test_strange_text_goes_and_usual_text_stays(documents):
    rng = random.Random(1)
    common = "the of and to in a is that".split()
    rows = [(i, " ".join(rng.choice(common) if rng.random() < .4 else f"word{chr(97 + rng.randrange(26))}"
                         f"{chr(97 + rng.randrange(26))}" for _ in range(200)), "en", "a", 1)
            for i in range(30)]
    rows.append((90, " ".join(f"WORD{i}!!###" for i in range(120)), "en", "a", 1))
    kept = {r.doc_id: r.kept for r in quality.judge(documents(rows)).collect()}
    assert not kept[90] and all(kept[i] for i in range(30))


def test_short_texts_are_not_judged(documents):
    limits = quality.Limits(min_words=0, min_class_chars=1000, min_common_words=1000)
    kept = quality.judge(documents([(1, "### !!! ###", "en", "a", 1)]), limits).first().kept
    assert kept


def test_whole_rows_and_empty_table(documents, awkward):
    kept = quality.kept_rows(awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} == {
        r.doc_id for r in quality.judge(awkward).collect() if r.kept}
    assert quality.judge(documents([])).count() == 0
    assert quality.kept_rows(documents([])).count() == 0
