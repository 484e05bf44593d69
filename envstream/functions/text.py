"""Text normalisation, city matching and dashboard filters."""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that may stand for ASCII letters or digits: the planes with scripts and symbols.
_FOLDED = range(0xA0, 0x20000)


def _base_letters(character: str) -> str:
    decomposed = unicodedata.normalize("NFKD", character)
    return "".join(c for c in decomposed if not unicodedata.combining(c))


@lru_cache(maxsize=1)
def _folding() -> tuple[str, str, dict[str, str]]:
    """Characters with one letter or digit each, these, and the forms of characters with several."""
    single, several = {}, {}
    for point in _FOLDED:
        base = _base_letters(chr(point))
        if not any(c.isascii() and c.isalnum() for c in base):
            continue
        if len(base) == 1:
            single[chr(point)] = base
        else:
            several[chr(point)] = base
    return "".join(single), "".join(single.values()), several


def fold_accents(text: Column) -> Column:
    """ASCII form of accented Latin text; Spark has no Unicode normalisation function."""
    source, target, several = _folding()
    folded = F.regexp_replace(F.translate(text, source, target), r"\p{M}+", "")
    forms = F.create_map(*[F.lit(part) for pair in several.items() for part in pair])
    single = F.regexp_extract_all(folded, F.lit("(?s)."), F.lit(0))
    expanded = F.array_join(F.transform(single, lambda c: F.coalesce(F.try_element_at(forms, c), c)), "")
    # Most texts need none of the expansions, so they are tried only where one applies.
    return F.when(folded.rlike("[" + "".join(several) + "]"), expanded).otherwise(folded)


def normalize_text(text: Column) -> Column:
    """Accents removed, every run of other characters one space, trimmed, lower case."""
    plain = F.when(text.rlike(r"[^\x00-\x7F]"), fold_accents(text)).otherwise(text)
    return F.lower(F.trim(F.regexp_replace(plain, "[^A-Za-z0-9]+", " ")))


def _normalized(name: str) -> str:
    kept = [c if c.isascii() and c.isalnum() else " " for c in _base_letters(name)]
    return " ".join("".join(kept).lower().split())


# Further names of a city, and cities whose own name must be one of the words.
CITY_ALIASES = {"Paris": ("paris", "paris city", "arrondissement")}
CITY_REQUIRED_WORD = {"Paris": "paris"}
# Fixed value: names up to this length match as whole words only.
SHORT_NAME = 5


def matches_city(candidate: Column, city: str) -> Column:
    """Whether a station's place name belongs to ``city``.

    A one-word name must be one of the words. A name of several words must occur as it is, or,
    unless it is short, also written together.
    """
    name = normalize_text(candidate)
    words = F.split(name, " ")
    tests = []
    for alias in CITY_ALIASES.get(city, (city,)):
        alias = _normalized(alias)
        compact = alias.replace(" ", "")
        if not alias:
            continue
        if " " not in alias:
            tests.append(F.array_contains(words, alias))
            continue
        tests.append(F.contains(name, F.lit(alias)))
        if city not in CITY_REQUIRED_WORD and len(compact) > SHORT_NAME:
            tests.append(F.contains(F.replace(name, F.lit(" "), F.lit("")), F.lit(compact)))
    matched = reduce(or_, tests, F.lit(False))
    if city in CITY_REQUIRED_WORD:
        matched = matched & F.array_contains(words, CITY_REQUIRED_WORD[city])
    return F.coalesce(matched, F.lit(False))


def matched_cities(candidate: Column, cities) -> Column:
    """Array of the cities a place name belongs to."""
    return F.array_compact(F.array(*[F.when(matches_city(candidate, c), c) for c in cities]))


def matches_filter(column: Column, pattern: str) -> Column:
    """Case-insensitive, unanchored regular-expression filter of a dashboard variable."""
    if pattern in (".*", ""):
        return column.isNotNull()
    return column.rlike("(?i)" + pattern)
