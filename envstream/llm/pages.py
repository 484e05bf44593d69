"""Main text of web pages by the containers that the pages of a host agree on.

Every page is parsed and its containers are scored by the text in them, less where it is linked. It
votes for the innermost container that holds most of that text, or for one around it that adds the title
or blocks of its own, by its path of tags and classes with digits generalised. Spark adds the votes up per host, and every page is read again with the path that
won at its host. A page without that path keeps the container it voted for itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import written
from envstream.llm.markup import Page, parse

#: Share of a page's text that the chosen container must hold; less for <article> and <main>.
MOST, STORY_MOST = 0.8, 0.5


def scores(page: Page) -> list[float]:
    """Text in each container and in all below it."""
    total = [c.chars for c in page.containers]
    for i in range(len(total) - 1, -1, -1):  # children come after their parents
        if page.containers[i].parent >= 0:
            total[page.containers[i].parent] += total[i]
    return total


def choice(page: Page) -> int:
    """The innermost container with most of the page's text, or what goes with it around it, or -1."""
    total = scores(page)
    whole = max(total, default=0.0)
    if not whole:
        return -1
    fit = [(c.story and total[i] >= STORY_MOST * whole, c.depth, total[i], -i)
           for i, c in enumerate(page.containers)
           if total[i] >= (STORY_MOST if c.story else MOST) * whole]
    return _climbed(page, -max(fit)[3])


def _climbed(page: Page, chosen: int) -> int:
    """The outermost container around ``chosen`` that adds a missing title, or text directly in it.

    Text directly in the body, or around a story, may be anything; only a title is taken from there.
    """
    around = [chosen]
    while page.containers[around[-1]].parent >= 0:
        around.append(page.containers[around[-1]].parent)
    rank = {c: i for i, c in enumerate(around)}
    #: For each container, how far out of the chosen one it hangs.
    hangs: list[int] = []
    for i, container in enumerate(page.containers):
        hangs.append(rank[i] if i in rank else hangs[container.parent] if container.parent >= 0 else len(around))
    best, story = 0, page.containers[chosen].story
    titles = []
    for (_, i), weight, title in zip(page.blocks, page.weights, page.titles):
        if i < 0 or not weight or hangs[i] >= len(around):
            continue
        if title:
            titles.append(hangs[i])
        direct = i in rank and not story and page.containers[i].name.split(".")[0] not in ("html", "body")
        if direct:
            best = max(best, hangs[i])
    return around[max(best, min(titles, default=0))]


def main_text(page: Page, path: str | None) -> str:
    """Blocks below the containers with the given path, or below the page's own choice."""
    chosen: set[int] = set()
    if path:
        last, depth = path.rsplit(">", 1)[-1], path.count(">")
        chosen = {i for i, c in enumerate(page.containers)
                  if c.depth == depth and c.name == last and page.path(i) == path}
    if not chosen:
        own = choice(page)
        if own < 0 and page.blocks:
            return "\n\n".join(words for words, _ in page.blocks)
        chosen = {own}
    inside = []
    for i, container in enumerate(page.containers):
        inside.append(i in chosen or (container.parent >= 0 and inside[container.parent]))
    return "\n\n".join(words for words, i in page.blocks if i >= 0 and inside[i])


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; empty if it has none."""
    return F.lower(F.regexp_extract(
        F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def votes(pages: DataFrame) -> DataFrame:
    """host, path: the path with most votes at each host. A vote weighs its share of the page's text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, weights = [], [], []
            for host, html in zip(batch.column(0), batch.column(1)):
                page = parse(html.as_py() or "")
                chosen = choice(page)
                if chosen >= 0:
                    total = scores(page)
                    hosts.append(host.as_py())
                    paths.append(page.path(chosen))
                    weights.append(round(1000 * total[chosen] / max(total)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                 pa.array(weights, pa.int64())], names=["host", "path", "votes"])

    found = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string")).mapInArrow(
        run, "host string, path string, votes long")
    counted = found.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return counted.groupBy("host").agg(F.max_by("path", F.struct("votes", "path")).alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    A null or empty page, and one without text of its own, has an empty text. Pages with a null or odd
    URL vote together. Repeated rows vote as often as they occur and give a row each; columns other
    than page_id, url and html are not looked at. An empty table gives an empty result.
    """
    winners = written(votes(pages), "host-paths")
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"),
                        host_of(F.col("url")).alias("host"))
    joined = rows.join(winners, "host", "left").select("page_id", "url", "html", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(parse(html.as_py() or "", path.as_py()), path.as_py())
                     for html, path in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    return joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, "
                                  "n_chars long")
