"""Vector search, classifier, shards, pages and the pipeline."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from envstream.llm import compression, pages, shards, vectors
from envstream.llm.markup import parse


# Vector search.

def vector_table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double, v int, list int")


def exact(rows, every, k):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows]
    for q, vector in usable:
        if q % every == 0:
            scored = sorted((-float((vector * w).sum()), i) for i, w in usable if i != q)
            yield q, [(i, -s) for s, i in scored[:k]]


@pytest.mark.parametrize("scale", [False, True])
def test_recall_of_the_search(spark, scale):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((12, 24))
    data = centres[rng.integers(0, 12, 1500)] + 0.7 * rng.standard_normal((1500, 24))
    if scale:
        data *= rng.uniform(0.1, 5, (1500, 1))
    rows = [(i, v.tolist(), None, None, None) for i, v in enumerate(data)]
    found = {}
    for r in vectors.search_all(vector_table(spark, rows), every=20).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    for q, best in exact(rows, 20, 20):
        got = sorted(found[q])
        assert [r for r, *_ in got] == list(range(1, 21))
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
        hits += len({i for i, _ in best} & {i for _, i, _ in got})
        total += 20
    assert hits / total >= 0.9


def test_few_ties_and_unusable_vectors(spark, monkeypatch):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [0.0, 1.0]), (3, [1.0, 0.0]), (4, [2.0, 0.0]),
            (5, None), (6, [0.0, 0.0]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]),
            (9, [1.0, None]), (10, [1.0]), (None, [1.0, 1.0]), (60, [-1.0, 0.5])]
    rows = [(*r, None, None, None) for r in rows]
    for block_rows, query_rows in ((20_000, 4096), (2, 1)):
        monkeypatch.setattr(vectors, "BLOCK_ROWS", block_rows)
        monkeypatch.setattr(vectors, "QUERY_ROWS", query_rows)
        found = vectors.search_all(vector_table(spark, rows), every=20).collect()
        got = {q: [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q]
               for q in (0, 20, 40, 60)}
        assert got == {0: [4, 3, 20, 40, 60], 20: [4, 0, 3, 40, 60], 40: [60, 0, 3, 4, 20],
                       60: [40, 0, 3, 20, 4]}
    assert vectors.search_all(vector_table(spark, [])).count() == 0
    assert vectors.search_all(vector_table(spark, [(5, [1.0, 1.0], None, None, None)])).count() == 0


def test_no_test_abandons_with_a_wide_margin():
    rng = np.random.default_rng(3)
    data, asked = rng.standard_normal((300, 32)), rng.standard_normal((20, 32))
    rotation = vectors._rotation(32, 1)
    truth = asked @ data.T
    beat = np.sort(truth, axis=1)[:, -10]
    search = vectors.Search(columns=8, epsilon=50.0)
    for scale in (1.0, 0.01):
        q, c, score = vectors.adaptive_scan(
            vectors.Side(asked, rotation, search, scale), vectors.Side(data, rotation, search, scale),
            beat * scale * scale, search)
        assert {(a, b) for a, b in zip(q, c)} >= {
            (a, b) for a in range(20) for b in np.flatnonzero(truth[a] >= beat[a])}
        assert np.allclose(score, truth[q, c])


@pytest.mark.parametrize("few", [0.0, 0.1, 1.0])
def test_columns_in_bulk_and_pair_by_pair_agree(monkeypatch, few):
    rng = np.random.default_rng(4)
    data, asked = rng.standard_normal((400, 64)), rng.standard_normal((30, 64))
    rotation, search = vectors._rotation(64, 1), vectors.Search()
    beat = np.sort(asked @ data.T, axis=1)[:, -20]
    beat[3] = -np.inf
    monkeypatch.setattr(vectors, "FEW", few)
    q, c, _ = vectors.adaptive_scan(
        vectors.Side(asked, rotation, search), vectors.Side(data, rotation, search), beat, search)
    found = np.zeros((30, 400), bool)
    found[q, c] = True
    assert found[3].all()
    # The tests of the method, written down for every pair.
    turned_q, turned_c = asked @ rotation, data @ rotation
    limit = (asked ** 2).sum(axis=1)[:, None] + (data ** 2).sum(axis=1) - 2 * beat[:, None]
    passed = np.ones((30, 400), bool)
    for end in (16, 32, 48, 64):
        apart = ((turned_q[:, None, :end] - turned_c[None, :, :end]) ** 2).sum(axis=2)
        wide = 1 if end == 64 else (1 + search.epsilon / np.sqrt(end)) ** 2
        passed &= apart * (64 / end) <= limit * wide + 1e-3
    strict = passed & (asked @ data.T > beat[:, None] + 1e-3)
    assert (found >= strict).all() and (found <= passed).all()


# Classifier.

def labelled(documents, spark, n=400):
    rng = random.Random(11)
    words = "the of and a in to is house river stone walked slowly green under morning light".split()
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < .7
        text = " ".join(rng.choice(words) if good else rng.choice(["###BUY", "CLICK!!", "$$$", "WIN!!"])
                        for _ in range(rng.randint(20, 80)))
        rows.append((i, text, "en", "a", 1))
        labels.append((i, int(good), 0))
    return documents(rows, extra=True), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"), dict((a, b) for a, b, _ in labels)


def test_held_out_accuracy(documents, spark):
    docs, labels, truth = labelled(documents, spark)
    model = compression.fit(docs, labels)
    rows = compression.classify(docs, model).collect()
    assert len(rows) == len(truth)
    right = [r.predicted == truth[r.doc_id] for r in rows if r.held_out]
    assert len(right) > 50 and sum(right) / len(right) >= 0.95
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    kept = compression.good_rows(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_held_out_labels_and_other_columns_have_no_say(documents, spark):
    docs, labels, _ = labelled(documents, spark)
    changed = labels.withColumn("quality", F.when(
        compression.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    moved = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    first, second = (sorted(compression.classify(d, compression.fit(d, x)).collect())
                     for d, x in ((docs, labels), (moved, changed)))
    assert first == second


def test_classifier_without_classes(awkward, documents, spark):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in compression.classify(awkward, compression.fit(awkward, empty)).collect()} == {0.5}
    one = spark.createDataFrame([(4, 1), (1, 1), (4, None), (None, 1)], "doc_id long, quality int")
    rows = compression.classify(awkward, compression.fit(awkward, one)).collect()
    assert len(rows) == awkward.count() and all(r.score > 0.99 for r in rows)
    docs, labels, _ = labelled(documents, spark, 100)
    model = compression.fit(docs, labels)
    assert compression.classify(awkward, model).count() == awkward.count()
    assert compression.classify(documents([]), model).count() == 0
    assert compression.fit(documents([]), labels).good == b""


def test_long_texts_score_like_short_ones(documents, spark):
    docs, labels, _ = labelled(documents, spark)
    model = compression.fit(docs, labels)
    rng = random.Random(5)
    for words, good in (("the of and a in to is house river stone walked slowly".split(), True),
                        (["###BUY", "CLICK!!", "$$$", "WIN!!"], False)):
        piece = " ".join(rng.choice(words) for _ in range(900))[:1024]
        short, long = model.densities([piece, piece * 200])
        assert abs(short - long) < 0.1 * abs(short) and (long > 0) == good
        assert (model.scores([piece * 200])[0] >= 0.7) == good
    for content in (b"", b"a", bytes(range(256)) * 40):
        assert b"".join(compression._stretches(content, 1024)) == content
        assert max(map(len, compression._stretches(content, 1024))) <= 1024


def test_curve_is_fitted_on_long_texts_too(documents, spark):
    docs, labels, _ = labelled(documents, spark)
    tail = F.when(F.crc32(F.col("text")) % 2 == 0, F.repeat(F.concat(F.lit(" "), "text"), 200)).otherwise("")
    docs = docs.withColumn("text", F.concat("text", tail))
    sizes = []
    own = compression._measured

    def measured(sample, model):
        found = own(sample, model)
        sizes.extend(found[:, 1])
        return found

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(compression, "_measured", measured)
        assert compression.fit(docs, labels).slope > 0
    assert max(sizes) > 16_384 > min(sizes)


# Shards.

def test_shards_follow_the_mixture(documents):
    rng = random.Random(1)
    rows = [(i, "t" * (i % 50), "en", rng.choice(["a"] * 6 + ["b", "c", None]), 1) for i in range(1003)]
    found = shards.assign(documents(rows, extra=True)).collect()
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and sum(sizes.values()) == 1003
    for shard, n in sizes.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))
    source = {r[0]: r[3] for r in rows}
    for name, n in Counter(source.values()).items():
        parts = Counter(r.shard for r in found if source[r.doc_id] == name)
        assert all(abs(parts[s] - n / 8) <= 1.5 for s in range(8)), name
    for r in found:
        text = rows[r.doc_id][1]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (
            len(text) + 1, zlib.crc32(text.encode()), "rows", None)


def test_shards_of_awkward_rows(awkward, documents):
    found = shards.assign(awkward).collect()
    assert Counter((str(r.doc_id), r.size, r.text_crc32) for r in found) == Counter(
        (str(r.doc_id), len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))
        for r in awkward.collect())
    assert Counter(shards.assign(awkward).collect()) == Counter(found)
    assert shards.assign(documents([])).count() == 0
    with pytest.raises(ValueError):
        shards.assign(awkward, 0)


# Pages.

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="wrap-%d with-sidebar"><div class="story post-%d"><h2>Title &amp; more</h2>
<p>First&nbsp;line<br>goes   on with <b>bold</b> and <a href="x>y">a link</a> &lt;here&gt;.
<p>Second paragraph, unclosed and %s<script>var t = "<p>no</p>";</script>
<form><input name=q>search</form><ul><li>one<li>two</ul><!-- <p>no</p> -->
<div class="comments"><p>Reader says no</p></div><span class="ad">Buy</span></div>
<div id="sidebar"><p>Side words that are not in the story</p></div></div>
<div class="cookie-notice">We use cookies</div><footer>&copy; site</footer></body></html>"""
STORY = ["Title & more", "First line goes on with bold and a link <here>.", "Second paragraph, unclosed and {}",
         "one", "two"]


def page_table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string, votes int")


def test_pages(spark):
    rows = [(i, f"http://h.example/{i}", PAGE % (i, i, "long " * 20 + str(i)), None, None, None)
            for i in range(6)]
    # The story is outweighed here, but the other pages of the host tell where it is.
    rows.append((6, "http://h.example/6", (PAGE % (6, 6, "short")).replace(
        "</body>", "<div class='x'><p>" + "filler text " * 60 + "</p></div></body>"), None, None, None))
    found = {r.page_id: r for r in pages.extract(page_table(spark, rows)).collect()}
    for i in range(7):
        tail = "short" if i == 6 else " ".join((("long " * 20) + str(i)).split())
        assert found[i].text == "\n\n".join(STORY).format(tail)
        assert found[i].n_chars == len(found[i].text) and found[i].url == rows[i][1]


def test_awkward_pages(spark):
    cases = {"": "", None: "", "<": "<", "just text": "just text", "<p>a<p>b": "a\n\nb",
             "a < b and <b>c</b>": "a < b and c", "<div>" * 5000 + "deep": "deep",
             "<p hidden>x</p><p>y</p>": "y", "<article>" + "<p>w</p>" * 20_000: "\n\n".join(["w"] * 20_000),
             "<nav>only a menu</nav>": "", "</p></div>stray": "stray", "<p>&#65;&unknown;&amp": "A&unknown;&",
             "<script>never closed": "", "<!-- never closed": ""}
    rows = [(1, None, html, None, None, None) for html in cases] + [
        (2, "no url", "<p>z</p>", None, None, None)] * 2 + [(None, "http://a/", "<p>n</p>", "", "", 1)]
    found = pages.extract(page_table(spark, rows)).collect()
    assert Counter(r.text for r in found if r.page_id == 1) == Counter(cases.values())
    assert Counter(r.text for r in found if r.page_id != 1) == Counter(["z", "z", "n"])
    assert pages.extract(page_table(spark, [])).count() == 0


def test_hosts(spark):
    urls = {"http://User@A.Example:80/x": "a.example", "https://b.c#d": "b.c", None: "", "x": "", "//y/z": ""}
    frame = spark.createDataFrame([(u,) for u in urls], "url string").select(
        "url", pages.host_of(F.col("url")).alias("host"))
    assert {r.url: r.host for r in frame.collect()} == urls


def test_paths_are_general():
    page = parse("<html><body><div class='post-17 b a'><p>t</p></div></body></html>")
    assert page.path(pages.choice(page)) == "html>body>div.a.b.post-#"


BODY = "".join(f"<p>Sentence {i} of the story goes on with plain words.</p>" for i in range(12))
SIDE = "<div class='sidebar'><p>Side words</p></div><div class='comments'><p>Reader says no</p></div>"


@pytest.mark.parametrize("open_,close", [
    ("<div class='page sidebar-right'><div class='post'>", "</div>{}</div>"),
    ("<div id='nav-open'><article>", "</article>{}</div>"),
    ("<div class='elementor-widget-theme-post-content'>", "</div>{}"),
    ("<section class='post comments-open'>", "{}</section>"),
    ("<div class='widget'><article>", "</article></div><div class='x'><p>" + "more " * 300 + "</p></div>{}"),
])
def test_a_layout_that_is_named_like_side_matter_is_kept(open_, close):
    page = parse(f"<html><body>{open_}<h1>Title</h1>{BODY}{close.format(SIDE)}</body></html>")
    text = "\n\n".join(words for words, _ in page.blocks)
    assert "Title" in text and "Sentence 0 " in text and "Sentence 11 " in text
    assert "Side words" not in text and "Reader" not in text


def test_long_comments_are_no_layout():
    talk = "<div class='comments'>" + "<article class='comment'><p>Reader says no and no</p></article>" * 40 + "</div>"
    page = parse(f"<body><div class='ad'><p>{'buy ' * 90}</p></div><article><h1>T</h1><p>short</p></article></body>")
    assert [words for words, _ in page.blocks] == ["T", "short"]
    for post in (f"<article>{BODY}</article>", f"<div class='post'>{BODY}</div>"):
        page = parse(f"<html><body>{post}{talk}</body></html>")
        text = pages.main_text(page, None)
        assert "Sentence 11 " in text and "Reader" not in text


def test_the_host_tells_that_a_name_is_a_layout(spark):
    html = "<html><body><div class='widget-post'><p>%s</p></div><div class='x'><p>%s</p></div></body></html>"
    rows = [(i, "http://w.example/", html % ("story words " * 50, "more"), None, None, None) for i in range(4)]
    rows.append((4, "http://w.example/", html % ("short story", "more words " * 50), None, None, None))
    found = {r.page_id: r.text for r in pages.extract(page_table(spark, rows)).collect()}
    assert found[4] == "short story" and found[0].startswith("story words")


@pytest.mark.parametrize("html,path", [
    (f"<div class=top><p>Site</p></div><div class=post><h1>Title</h1><p>lede</p><div class=body>{BODY}</div></div>",
     "html>body>div.post"),
    (f"<div class=post><div class=head><h1>Title</h1></div><p>lede</p><div class=body>{BODY}</div></div>",
     "html>body>div.post"),
    (f"<main><h1>Title</h1><article><p>lede</p>{BODY}</article></main>", "html>body>main"),
    (f"<p>Imprint</p><div class=post><h1>Title</h1><p>lede</p>{BODY}</div>", "html>body>div.post"),
])
def test_title_and_lede_around_the_body_are_kept(html, path):
    page = parse(f"<html><body>{html}</body></html>")
    assert page.path(pages.choice(page)) == path
    text = pages.main_text(page, path)
    assert text.startswith("Title\n\nlede\n\nSentence 0 ") and "Site" not in text and "Imprint" not in text


LONG_STORY = "".join(
    f"<p>The river walked slowly under the morning light {i} and the house was green.</p>" for i in range(8))


@pytest.mark.parametrize("wrapper", ["form", "div aria-hidden=true", "div role=form", "section role=complementary"])
def test_a_wrapper_around_everything_keeps_the_story(wrapper):
    tag = wrapper.split()[0]
    page = parse(f"<body><{wrapper}><article>{LONG_STORY}</article></{tag}></body>")
    assert pages.main_text(page, None) == pages.main_text(parse(f"<article>{LONG_STORY}</article>"), None) != ""


def test_small_forms_and_roles_go():
    html = (f"<body><div class=post>{LONG_STORY}</div><form><p>Leave your name and a message here</p></form>"
            "<div role=navigation><p>Home and away and more</p></div><p aria-hidden=true>Decoration</p></body>")
    text = pages.main_text(parse(html), None)
    assert text.count("river") == 8 and "Leave" not in text and "away" not in text and "Decoration" not in text


@pytest.mark.parametrize("deep", [3, 20, 300])
def test_paths_of_any_depth_find_the_story(deep):
    """The host's path leads below an element with an odd name, though another one outweighs it here."""
    opening = "".join(f"<div class=l{chr(97 + i % 26)}>" for i in range(deep))
    usual = parse(f"<body>{opening}<div class='page sidebar-x'><div class=story>{LONG_STORY}</div></div></body>")
    path = usual.path(pages.choice(usual))
    assert path.count(">") == deep + 2
    odd = (f"<body>{opening}<div class='page sidebar-x'><div class=story><p>A short one.</p></div></div>"
           f"{'</div>' * deep}<div class=big>{LONG_STORY}</div></body>")
    assert pages.main_text(parse(odd, path), path) == "A short one."
