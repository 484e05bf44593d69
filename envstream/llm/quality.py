"""Quality rules: base rules on words, and divergence from what is usual in the document's language.

Every document has two histograms: of character classes and of the common words of its language.
Each is compared with the same histogram over all documents of that language by the Jensen-Shannon
distance. A sample of n draws from k bins lies at a divergence of about (k - 1) / (8 n ln 2) bits
from its own source, so the allowance grows for short texts, and texts below a minimum length are
not judged.

Only built-in functions are used. The features, some 30 numbers per document, are stored once; the
references are sums over them, one row per language of ``COMMON_WORDS`` and one for all others.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import SPACE_RUN, let, words_of, written

# The most frequent words of each language.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich",
           "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "was", "for",
           "it", "with", "as", "on", "be", "at", "by", "this", "are", "from"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del",
           "las", "un", "por", "con", "no", "una", "su", "para", "es", "al"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une",
           "que", "est", "pour", "qui", "dans", "par", "sur", "au", "avec", "pas"],
}
SLOTS = 20
OTHER = "other"

# Symbols that count as noise, and marks that belong to sentences.
SYMBOLS = "#*$%&|<>"
MARKS = ".,;:!?'\"()-"
CLASSES = ("lower", "upper", "digit", "space", "mark", "symbol", "rest")


@dataclass(frozen=True)
class Limits:
    """Distances allowed, and the lengths below which a histogram is not judged."""

    min_words: int = 50
    max_repeat_percent: int = 50
    class_distance: float = 0.3
    min_class_chars: int = 200
    word_distance: float = 0.22
    min_common_words: int = 50


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeated_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more.

    Windows are compared by their 64-bit hash within one text.
    """
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(found: Column) -> Column:
        sorted_windows = F.sort_array(F.transform(
            found, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

        def of_sorted(windows: Column) -> Column:
            def starts(window: Column, i: Column) -> Column:
                before, after = F.get(windows, i - 1)["h"], F.get(windows, i + 1)["h"]
                same = F.coalesce(before == window["h"], F.lit(False)) | F.coalesce(
                    after == window["h"], F.lit(False))
                at = window["at"]
                return F.when(same, F.array(at, at + 1, at + 2)).otherwise(
                    F.array().cast("array<int>"))

            return F.size(F.array_distinct(F.flatten(F.transform(windows, starts))))

        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(
            let(sorted_windows, of_sorted))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(hashes, covered))


def _common_words(profile: Column) -> Column:
    chosen = F.array(*[F.lit("")] * SLOTS)
    for language, words in COMMON_WORDS.items():
        chosen = F.when(profile == language, F.array(*map(F.lit, words))).otherwise(chosen)
    return chosen


def _of_words(words: Column, common: Column) -> Column:
    """Everything that is counted on the array of words."""
    usual = F.filter(F.transform(words, F.lower), lambda word: F.array_contains(common, word))
    counts = let(usual, lambda found: F.array(*[
        (F.size(found) - F.size(F.array_remove(found, F.get(common, F.lit(i))))).cast("long")
        for i in range(SLOTS)]))
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        _repeated_words(words).cast("long").alias("n_repeat_words"),
        counts.alias("common"))


def _of_characters(text: Column) -> Column:
    """Counts per character class. Small letters and spaces, most of a text, leave first."""
    length = F.char_length(text)

    def of_unspaced(unspaced: Column, spaced: Column) -> Column:
        n = F.char_length(unspaced)
        upper = n - F.char_length(F.regexp_replace(unspaced, r"\p{Lu}+", ""))
        digit = n - F.char_length(F.regexp_replace(unspaced, r"\p{Nd}+", ""))
        mark = n - F.char_length(_without(unspaced, MARKS))
        symbol = n - F.char_length(_without(unspaced, SYMBOLS))
        counts = [length - F.char_length(spaced), upper, digit, F.char_length(spaced) - n,
                  mark, symbol, n - upper - digit - mark - symbol]
        return F.array(*[c.cast("long") for c in counts])

    return let(F.regexp_replace(text, r"\p{Ll}+", ""), lambda spaced: let(
        F.regexp_replace(spaced, SPACE_RUN, ""), lambda rest: of_unspaced(rest, spaced)))


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found)))


def features(docs: DataFrame, limits: Limits = Limits(), whole: bool = False) -> DataFrame:
    """doc_id, profile, the counts of ``judge``, ``classes`` and ``common``.

    ``whole`` has the whole row, as a struct, in place of doc_id.
    """
    own = F.struct(*[docs[f"`{name}`"] for name in docs.columns]) if whole else F.col("doc_id")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    profile = F.when(lang.isin(list(COMMON_WORDS)), lang).otherwise(OTHER)
    rows = docs.select(own.alias("own"), profile.alias("profile"), let(text, lambda t: F.struct(
        let(words_of(t), lambda w: let(
            _common_words(profile), lambda common: _of_words(w, common))).alias("w"),
        _of_characters(t).alias("classes"),
        F.char_length(t).alias("chars"),
        _repeated_lines(t).cast("long").alias("n_dup_lines"))).alias("f"))
    rows = rows.select(
        "own", "profile", "f.w.n_words",
        (F.col("f.chars").cast("long") - F.col("f.classes")[CLASSES.index("space")])
        .alias("word_chars"),
        F.col("f.classes")[CLASSES.index("symbol")].alias("n_symbols"),
        "f.n_dup_lines", "f.w.n_repeat_words", "f.classes", "f.w.common")
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _with_other(counts: Column, total: Column) -> Column:
    """Counts of the common words and, last, of all other words."""
    known = F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)
    return F.concat(counts, F.array(total - known))


def references(found: DataFrame) -> DataFrame:
    """One row per profile: both histograms over all documents that pass the base rules.

    At most one row per language of ``COMMON_WORDS`` and one more, whatever the input.
    """
    sums = found.where(~F.col("base_failed")).groupBy("profile").agg(
        F.array(*[F.sum(F.col("classes")[i]) for i in range(len(CLASSES))]).alias("ref_classes"),
        F.array(*[F.sum(F.col("common")[i]) for i in range(SLOTS)]).alias("ref_common"),
        F.sum("n_words").alias("ref_words"))
    return sums.select("profile", "ref_classes",
                       _with_other(F.col("ref_common"), F.col("ref_words")).alias("ref_common"))


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance in bits, 0 to 1, of two histograms with the same bins."""
    def shares(histogram: Column) -> Column:
        total = F.aggregate(histogram, F.lit(0).cast("long"), lambda a, b: a + b)
        return let(F.greatest(total, F.lit(1)).cast("double"),
                   lambda n: F.transform(histogram, lambda x: x / n))

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    terms = F.zip_with(shares(counts), shares(reference), lambda p, q: part(p, q) + part(q, p))
    total = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def _allowed(limit: float, bins: int, drawn: Column) -> Column:
    noise = (bins - 1) / (8 * math.log(2)) / F.greatest(drawn, F.lit(1)).cast("double")
    return F.sqrt(F.lit(limit ** 2) + noise)


def verdicts(found: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``features`` rows with ``class_distance``, ``word_distance`` and ``kept``.

    A distance is null where the profile has no reference, and counts as passed.
    """
    joined = found.join(F.broadcast(references(found)), "profile", "left")
    chars = F.aggregate(F.col("classes"), F.lit(0).cast("long"), lambda a, b: a + b)
    joined = joined.select(
        *found.columns, chars.alias("chars"),
        distance(F.col("classes"), F.col("ref_classes")).alias("class_distance"),
        F.when(F.col("profile") != OTHER, distance(
            _with_other(F.col("common"), F.col("n_words")), F.col("ref_common")))
        .alias("word_distance"))
    strange = (F.col("chars") >= limits.min_class_chars) & (
        F.col("class_distance")
        > _allowed(limits.class_distance, len(CLASSES), F.col("chars")))
    foreign = (F.col("n_words") >= limits.min_common_words) & (
        F.col("word_distance") > _allowed(limits.word_distance, SLOTS + 1, F.col("n_words")))
    passed = ~F.coalesce(strange, F.lit(False)) & ~F.coalesce(foreign, F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & passed)


def judge(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, class_distance, word_distance.

    A null text has no words. Documents of unknown or null language share one reference of
    character classes. Repeated rows and null ids are judged like any other; columns other than
    doc_id, text and lang are not looked at. An empty table gives an empty result.
    """
    judged = verdicts(written(features(docs, limits), "quality"), limits)
    return judged.select(
        F.col("own").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")


def kept_rows(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs``, unchanged, that ``judge`` keeps."""
    judged = verdicts(written(features(docs, limits, whole=True), "quality"), limits)
    return judged.where("kept").select("own.*")
