"""One page of HTML as containers and blocks of text."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Fixed values of HTML: elements that contain others, that end a block of text, that hold no text.
CONTAINERS = frozenset((
    "article", "aside", "body", "center", "dd", "details", "div", "dl", "fieldset", "figure", "footer",
    "form", "header", "html", "main", "menu", "nav", "ol", "section", "table", "tbody", "td", "tr", "ul",
))
BLOCKS = CONTAINERS | frozenset((
    "address", "blockquote", "caption", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "head",
    "hr", "legend", "li", "p", "pre", "summary", "tfoot", "th", "thead", "title",
))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
                  "track", "wbr"))
RAW = frozenset(("iframe", "noscript", "script", "style", "template", "textarea", "title", "xmp"))
SKIPPED = frozenset(("aside", "button", "dialog", "footer", "head", "menu", "nav", "noscript", "object",
                     "option", "select", "svg"))
ROLES = frozenset(("alert", "banner", "complementary", "contentinfo", "dialog", "form", "menu",
                   "navigation", "search"))
STORY = frozenset(("article", "main"))
# Parts of class names and ids that stand for something other than the article.
ASIDE_WORDS = frozenset((
    "ad", "ads", "advert", "advertisement", "adverts", "alert", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "masthead",
    "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup",
    "promo", "related", "reply", "replies", "respond", "share", "sharing", "sidebar", "signup", "skip",
    "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
))
# Those of readers' words, which may outweigh a short article.
TALK_WORDS = frozenset(("comment", "comments", "disqus", "replies", "reply", "respond"))
# A name with one of these says that the element has such a neighbour, not that it is one.
HAVING = frozenset(("has", "no", "with", "without"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_DIGITS = re.compile(r"[0-9]+")
#: Share of a page's unlinked text from which an element is a layout that its name only describes.
LAYOUT, TALK_LAYOUT = 0.5, 0.9


@dataclass
class Container:
    parent: int
    depth: int
    name: str          # tag and classes, digits as #
    story: bool
    chars: float = 0.0


@dataclass
class Page:
    containers: list[Container] = field(default_factory=list)
    #: Text and container of each block outside of skipped elements, in order.
    blocks: list[tuple[str, int]] = field(default_factory=list)
    #: Of each block, its text less where it is linked, and whether it is a main heading.
    weights: list[float] = field(default_factory=list)
    titles: list[bool] = field(default_factory=list)

    def path(self, i: int) -> str:
        """Names from the outermost container to this one."""
        names = []
        while i >= 0:
            names.append(self.containers[i].name)
            i = self.containers[i].parent
        return ">".join(reversed(names))


@dataclass
class Named:
    """An element whose name speaks of something other than the article."""

    parent: int
    container: int     # -1 if it is none
    talk: bool
    chars: float = 0.0
    title: bool = False
    story: float = 0.0


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _set_apart(tag: str, attributes: dict[str, str], in_story: bool) -> bool:
    """Whether an element is not part of an article's text, whatever it holds."""
    if tag in SKIPPED or (tag == "header" and not in_story):
        return True
    if tag in ("html", "body", "article", "main") or not attributes:
        return False
    return ("hidden" in attributes
            or "display:none" in attributes.get("style", "").replace(" ", "").lower())


def _named_apart(tag: str, attributes: dict[str, str], in_story: bool) -> set[str]:
    """What in the element's names and role speaks of something other than the article.

    Whole sites lie in a form, or in an element that assistive software is to pass over for a while, so
    these are judged by what they hold as well.
    """
    found = {"form"} if tag == "form" else set()
    if tag in ("html", "body", "article", "main") or not attributes:
        return found
    if attributes.get("role") in ROLES or attributes.get("aria-hidden") == "true":
        found.add("role")
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        parts = set(_PARTS.split(name))
        if not parts & HAVING:
            found |= parts & ASIDE_WORDS
            found |= parts & {"header"} if not in_story else set()
    return found


def _keep(page: Page, named: list[Named], found: list[tuple[str, int, float, bool, int, bool]],
          path: str | None) -> None:
    """Keeps the blocks whose named elements are all layouts.

    A name may describe a layout: an element with most of the unlinked text (unless a story lies outside
    of all such elements), or with the only story, is no side matter, nor is one on the way to the
    container that the host's pages agree on.
    """
    whole = outside = 0.0
    for words, container, weight, title, at, in_story in found:
        whole += weight
        outside += weight * (in_story and at < 0)
        if at >= 0:
            named[at].chars += weight
            named[at].story += weight * in_story
            named[at].title |= title
    for one in reversed(named):  # inner ones come after those around them
        if one.parent >= 0:
            above = named[one.parent]
            above.chars, above.story, above.title = (
                above.chars + one.chars, above.story + one.story, above.title or one.title)
    kept: list[bool] = []
    for one in named:
        most = one.chars >= (TALK_LAYOUT if one.talk else LAYOUT) * whole
        layout = one.chars > 0 and (most and (one.story > 0 or not outside)
                                    or (one.talk and one.title and one.chars >= LAYOUT * whole)
                                    or (not one.talk and one.story > 0 and not outside))
        if path and not layout and one.container >= 0:
            layout = (page.containers[one.container].depth <= path.count(">")
                      and f"{path}>".startswith(f"{page.path(one.container)}>"))
        kept.append(layout and (one.parent < 0 or kept[one.parent]))
    for words, container, weight, title, at, _ in found:
        if at < 0 or kept[at]:
            page.blocks.append((words, container))
            page.weights.append(weight)
            page.titles.append(title)
            if container >= 0:
                page.containers[container].chars += weight


def parse(html: str, path: str | None = None) -> Page:
    """Reads a page of any quality: unknown, unclosed and stray tags are put up with.

    ``path`` is that of the container that is looked for, if it is known.
    """
    page = Page()
    #: Open elements: tag, container, whether set apart, whether in a story, innermost named element.
    stack: list[tuple[str, int, bool, bool, int]] = []
    named: list[Named] = []
    #: Blocks: text, container, unlinked text, whether a title, named element, whether in a story.
    found: list[tuple[str, int, float, bool, int, bool]] = []
    text: list[str] = []
    linked = 0
    links = 0
    ends: dict[str, re.Pattern] = {}

    def close_block() -> None:
        nonlocal linked
        words = " ".join("".join(text).split())
        text.clear()
        _, container, apart, in_story, at = stack[-1] if stack else ("", -1, False, False, -1)
        if words and not apart:
            share = max(0.0, 1 - linked / len(words))
            block = next((open_[0] for open_ in reversed(stack) if open_[0] in BLOCKS), "")
            found.append((words, container, len(words) * share * share, block == "h1", at, in_story))
        linked = 0

    def close_to(depth: int) -> None:
        nonlocal links
        close_block()
        for tag, *_ in stack[depth:]:
            links -= tag == "a"
        del stack[depth:]

    def add(raw: str) -> None:
        nonlocal linked
        words = unescape(raw) if "&" in raw else raw
        text.append(words)
        if links:
            linked += len(words.strip())

    at, size = 0, len(html)
    while at < size:
        match = _TOKEN.search(html, at)
        if not match:
            add(html[at:])
            break
        if match.start() > at:
            add(html[at:match.start()])
        at = match.end()
        if not match[2]:
            continue
        tag = match[2].lower()
        if match[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if tag in BLOCKS:
                if depth >= 0 and tag not in ("html", "body"):
                    close_to(depth)
                else:
                    close_block()
            elif depth >= 0 and all(open_[0] not in BLOCKS for open_ in stack[depth:]):
                links -= sum(open_[0] == "a" for open_ in stack[depth:])
                if stack[depth][2] and not (depth and stack[depth - 1][2]):
                    text.clear()  # what an inline element set apart held
                del stack[depth:]
            continue
        if tag in RAW:
            end = ends.get(tag) or ends.setdefault(tag, re.compile(f"</{tag}\\s*>", re.I))
            closing = end.search(html, at)
            at = closing.end() if closing else size
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCKS:
            # A paragraph, item or heading ends where the next block begins.
            close_block()
            if stack and (tag != "li" or stack[-1][0] != "li"):
                depth = next((i for i in range(len(stack) - 1, -1, -1)
                              if stack[i][0] in CONTAINERS), -1) + 1
                inner = next((i for i in range(depth, len(stack)) if stack[i][0] == "p"), None)
                if inner is not None:
                    close_to(inner)
            elif stack and tag == "li":
                close_to(len(stack) - 1)
        if tag in VOID:
            continue
        attributes = _attributes(match[3]) if match[3].strip(" /") else {}
        _, container, apart, in_story, inside = stack[-1] if stack else ("", -1, False, False, -1)
        in_story = in_story or tag in STORY
        set_apart = apart or _set_apart(tag, attributes, in_story)
        aside = set() if set_apart else _named_apart(tag, attributes, in_story)
        if aside and tag not in BLOCKS:
            set_apart = True  # part of a line, and no layout
        if tag in CONTAINERS and not set_apart:
            classes = sorted(set(attributes.get("class", "").lower().split()))
            name = ".".join([tag, *(_DIGITS.sub("#", c) for c in classes)])
            level = page.containers[container].depth + 1 if container >= 0 else 0
            story = tag in STORY or attributes.get("role") in STORY or attributes.get(
                "itemprop", "").lower() == "articlebody"
            page.containers.append(Container(container, level, name, story))
            container = len(page.containers) - 1
        if aside and not set_apart:
            named.append(Named(inside, container if tag in CONTAINERS else -1, bool(aside & TALK_WORDS)))
            inside = len(named) - 1
        elif set_apart and not apart and tag not in BLOCKS:
            close_block()
        if not match[3].rstrip().endswith("/") or tag in BLOCKS:
            stack.append((tag, container, set_apart, in_story, inside))
            links += tag == "a"
    close_block()
    _keep(page, named, found, path)
    return page
