import pytest

#: Rows that every operator on documents has to put up with; columns clash with results on purpose.
AWKWARD = [
    (1, "", "en", "a", 0), (2, None, None, None, None), (3, " \t\n", "xx", "a", 3),
    (None, "a text without an id", "en", "b", 20), (4, "word", "en", "a", 4), (5, "word", "en", "a", 4),
    (5, "word", "en", "a", 4), (6, "x" * 200_000, "de", "b", 200_000),
    (7, " ".join(f"w{i % 977}" for i in range(30_000)), "fr", "b", 1), (8, "ﬀ \u0000 é　ß\nA", "en", "a", 9),
]
CLASHING = ("score double, rank int, key string, node string, value long, own string, words string, "
            "shard int, length int, profile string, kept boolean, list int, spans string")


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows, extra=False):
        frame = spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            from pyspark.sql import functions as F
            for field in CLASHING.split(", "):
                name, kind = field.split(" ")
                frame = frame.withColumn(name, F.lit(None).cast(kind))
        return frame
    return make


@pytest.fixture(scope="session")
def awkward(documents):
    return documents(AWKWARD, extra=True)
