"""Quality classifier by compression.

Two zstandard dictionaries are built from good and from bad labelled text. A text that one of them
compresses better resembles its class: the score is the difference of the two compressed sizes per
byte of text, and a logistic curve fitted on further labelled texts turns it into a probability.

A dictionary helps little once a text has a history of its own. So texts are cut into stretches of equal
size that each start from the dictionary, and a long text scores like a short one of its kind.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import written


@dataclass(frozen=True)
class Training:
    """Bounds of the labelled sample; scoring reads every document whole."""

    #: Rows of each class, and the longest text that a dictionary takes lines from.
    per_class: int = 2000
    max_bytes: int = 16_384
    dictionary_bytes: int = 262_144
    level: int = 6
    #: A text shorter than about this many bytes is mostly judged like an average one.
    inertia: int = 24
    #: Most bytes of a text that are compressed together.
    stretch: int = 1024


def _stretches(content: bytes, size: int) -> list[bytes]:
    """The whole content in pieces of equal size, up to a byte, and of at most ``size``."""
    many = max(1, -(-len(content) // size))
    edges = [len(content) * i // many for i in range(many + 1)]
    return [content[a:b] for a, b in zip(edges, edges[1:])]


@dataclass
class Model:
    good: bytes
    bad: bytes
    level: int
    inertia: int
    stretch: int
    mean: float = 0.0
    slope: float = 0.0
    offset: float = 0.0

    def densities(self, texts: list[str]) -> np.ndarray:
        """Bytes saved by the good dictionary over the bad one, per byte of text."""
        if not self.good or not self.bad:
            return np.zeros(len(texts))
        import zstandard

        encoded = [text.encode("utf-8") for text in texts]
        sizes = []
        for content in (self.good, self.bad):
            dictionary = zstandard.ZstdCompressionDict(
                content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=self.level)
            compressor = zstandard.ZstdCompressor(
                dict_data=dictionary, write_content_size=False, write_checksum=False,
                write_dict_id=False)
            sizes.append([sum(len(compressor.compress(part)) for part in _stretches(text, self.stretch))
                          for text in encoded])
        good, bad = np.array(sizes, np.float64).reshape(2, -1)
        n = np.array(list(map(len, encoded)), np.float64)
        return (bad - good + self.inertia * self.mean) / (n + self.inertia)

    def scores(self, texts: list[str]) -> np.ndarray:
        z = self.slope * self.densities(texts) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may only be used for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _dictionary(texts: list[str], others: set[str], size: int) -> bytes:
    """Lines of the class, each once, without those that the other class has too."""
    lines = dict.fromkeys(line for text in texts for line in text.split("\n") if line not in others)
    return "\n".join(lines).encode("utf-8")[:size]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method, with a weak pull to zero."""
    scale = max(float(x.std()), 1e-9)
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - 1e-3 * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta += step
        if np.abs(step).max() < 1e-10:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> Model:
    """Trains on labelled rows that aren't held out.

    The sample has at most ``per_class`` rows of each class, those of least hash. Half of its texts fill
    the dictionaries, for which those of at most ``max_bytes`` come to the driver: some tens of megabytes,
    whatever the input. The other half, of every length, is measured on the executors and fits the
    curve, weighted by how frequent the classes are. Without texts of both classes in both halves every
    score is the share of good labels, or one half without labels.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()
                         & ~held_out(F.col("doc_id"))).select("doc_id", "quality").distinct()
    counts = {row.quality: row["count"] for row in known.groupBy("quality").count().collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    prior = math.log((share + 1e-6) / (1 - share + 1e-6))
    samples, texts = {}, {}
    for quality in (0, 1):
        some = known.where(F.col("quality") == quality).orderBy(
            F.xxhash64("doc_id"), "doc_id").limit(training.per_class).select("doc_id")
        text = F.col("text").cast("string")
        # At most per_class ids, so they fit every executor.
        found = docs.join(F.broadcast(some), "doc_id", "left_semi").select(text.alias("text")).where(
            F.octet_length("text") > 0).distinct()
        # As many texts as ids, also where ids are repeated.
        samples[quality] = written(found.orderBy(F.xxhash64("text"), "text").limit(
            training.per_class).withColumn("curve", F.pmod(F.xxhash64("text"), F.lit(2)) == 1), "sample")
        short = samples[quality].where(F.octet_length("text") <= training.max_bytes)
        texts[quality] = [tuple(row) for row in short.orderBy(F.xxhash64("text"), "text").collect()]
    model = Model(b"", b"", training.level, training.inertia, training.stretch, offset=prior)
    lines = {q: {line for text, _ in some for line in text.split("\n")} for q, some in texts.items()}
    own = {q: [text for text, curve in some if not curve] for q, some in texts.items()}
    trained = Model(_dictionary(own[1], lines[0], training.dictionary_bytes),
                    _dictionary(own[0], lines[1], training.dictionary_bytes),
                    training.level, training.inertia, training.stretch)
    if not trained.good or not trained.bad:
        return model
    measured = {q: _measured(some.where("curve"), trained) for q, some in samples.items()}
    if not all(map(len, measured.values())):
        return model
    x, n = np.concatenate([measured[0], measured[1]]).T
    y = np.repeat([0.0, 1.0], [len(measured[0]), len(measured[1])])
    weight = np.where(y == 1, counts[1] / len(measured[1]), counts[0] / len(measured[0]))
    weight = weight / weight.mean()
    trained.mean = float(np.average(x, weights=weight))
    trained.slope, trained.offset = _logistic(
        x + trained.inertia * trained.mean / (n + trained.inertia), y, weight)
    return trained


def _measured(sample: DataFrame, model: Model) -> np.ndarray:
    """Density and bytes of each text; at most ``per_class`` rows."""
    rows = sample.select(_column(sample, model, Model.densities, F.col("text")).alias("density"),
                         F.octet_length("text").alias("n")).collect()
    return np.array(sorted(map(tuple, rows)), np.float64).reshape(-1, 2)


def _column(docs: DataFrame, model: Model, of: Callable[[Model, list[str]], np.ndarray],
            text: Column) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("double")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series(of(Model(**shared.value), texts.fillna("").tolist()))

    return made(text.cast("string"))


def score_column(docs: DataFrame, model: Model, text: Column) -> Column:
    """Probability that a text is good; a null text scores like an empty one."""
    return _column(docs, model, Model.scores, text)


def classify(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    A null id counts as not held out. Only the text enters the score: repeated rows and copies score
    alike, and other columns are not looked at. An empty table gives an empty result.
    """
    rows = docs.select("doc_id", score_column(docs, model, F.col("text")).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_rows(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, unchanged, that score at least ``threshold``."""
    return docs.where(score_column(docs, model, F.col("text")) >= threshold)
