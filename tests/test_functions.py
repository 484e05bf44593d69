import unicodedata
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from envstream import rules
from envstream.functions import keys, levels, text, times, units


def values(spark, rows, ddl, expression):
    frame = spark.createDataFrame(rows, ddl)
    return [r[0] for r in frame.select(expression.alias("v")).collect()]


@pytest.mark.parametrize("form, expected", [
    ("2026-02-08T10:00:00Z", "2026-02-08 10:00:00"),
    ("2026-02-08T10:00:00.123456+00:00", "2026-02-08 10:00:00.123456"),
    ("2026-02-08T12:00:00+0200", "2026-02-08 10:00:00"),
    ("2026-02-08T10:00:00.1Z", "2026-02-08 10:00:00.1"),
    ("2026-02-08 10:00:00", "2026-02-08 10:00:00"),
    ("2026-02-08", "2026-02-08 00:00:00"),
    ("2026-02-08T10:00+00:00", None),
    ("", None), ("bad", None), (None, None), ("10:00", None),
])
def test_event_time(spark, form, expected):
    parsed = times.parse_event_time(F.col("t")).cast("string")
    assert values(spark, [(form,)], "t string", parsed) == [expected]


def test_provider_time_accepts_minutes(spark):
    parsed = times.parse_provider_time(F.col("t")).cast("string")
    rows = [("2026-02-08T10:00+00:00",), ("2026-02-08T10:00",), ("nope",)]
    assert values(spark, rows, "t string", parsed) == [
        "2026-02-08 10:00:00", "2026-02-08 10:00:00", None]


def test_iso_text(spark):
    shown = times.iso_text(F.col("t").cast("timestamp"))
    rows = [("2026-02-08 10:00:00",), ("2026-02-08 10:00:00.5",), (None,)]
    assert values(spark, rows, "t string", shown) == [
        "2026-02-08T10:00:00+00:00", "2026-02-08T10:00:00.500000+00:00", None]


def test_bucket_start_matches_engine_windows(spark):
    rows = [("1969-12-31 23:58:59.999999",), ("2024-02-29 23:59:59.999999",),
            ("2024-01-01 00:00:00",)]
    frame = spark.createDataFrame(rows, "t string").withColumn("t", F.col("t").cast("timestamp"))
    for duration in ("5 minutes", "10 minutes", "6 hours", "1 day"):
        both = frame.select(
            times.bucket_start(F.col("t"), times.duration_seconds(duration)).alias("a"),
            F.window("t", duration)["start"].alias("b"))
        assert both.filter("a <> b").count() == 0


def test_temperature_and_wind(spark):
    rows = [(212.0, "°F"), (212.0, " fahrenheit "), (20.0, " C "), (7.0, None), (7.0, "K"),
            (None, "F")]
    converted = values(spark, rows, "v double, u string",
                       units.temperature_celsius(F.col("v"), F.col("u")))
    assert converted == [100.0, 100.0, 20.0, 7.0, 7.0, None]
    rows = [(36.0, "km/h"), (36.0, "KPH"), (10.0, "mph"), (10.0, "kn"), (3.0, "m/s"),
            (3.0, None), (3.0, "furlong")]
    converted = values(spark, rows, "v double, u string",
                       units.wind_metres_per_second(F.col("v"), F.col("u")))
    assert converted == pytest.approx([10.0, 10.0, 4.4704, 5.14444, 3.0, 3.0, 3.0])


def test_status_boundaries(spark):
    cases = []
    for name, (low, high) in rules.STATUS_THRESHOLDS.items():
        cases += [(name, low - 0.01, "OK"), (name, low, "WARNING"), (name, high, "WARNING"),
                  (name, high + 0.01, "DANGER"), (name, None, "UNKNOWN")]
    cases += [("so2", 10.0, "UNKNOWN"), (None, 10.0, "UNKNOWN")]
    got = values(spark, cases, "p string, v double, e string",
                 levels.status_level(F.col("p"), F.col("v")))
    assert got == [e for *_, e in cases]


def test_range_boundaries(spark):
    cases = [("pm25", 0.0, True), ("pm25", -0.01, False), ("o3", 1000.0, True),
             ("no2", 1000.01, False), ("co", 50.0, True), ("co", 50.01, False),
             ("so2", 5.0, False), ("pm10", None, None)]
    got = values(spark, cases, "p string, v double, e boolean",
                 levels.pollutant_in_range(F.col("p"), F.col("v")))
    assert got == [e for *_, e in cases]


def test_peak_thresholds(spark):
    cases = []
    for name, rise in rules.PEAK_DELTAS.items():
        cases += [(name, rise, True), (name, rise - 0.01, False), (name, None, False)]
    cases += [("so2", 500.0, False), (None, 500.0, False)]
    got = values(spark, cases, "p string, d double, e boolean",
                 levels.is_peak(F.col("p"), F.col("d")))
    assert got == [e for *_, e in cases]


@pytest.mark.parametrize("place, city, expected", [
    ("Paris 2e Arrondissement", "Paris", True), ("Parish", "Paris", False),
    ("Londonderry", "London", False), ("PÂRIS", "Paris", True), ("Arrondissement", "Paris", False),
    ("Greater London - Bexley", "London", True), ("New-York City", "New York", True),
    ("Newyork", "New York", True), ("York New", "New York", False), ("LaPaz", "La Paz", False),
    ("La Paz centro", "La Paz", True), ("Düsseldorf-Mitte", "Düsseldorf", True),
    ("", "Paris", False), (None, "Paris", False), ("Rome", "", False),
])
def test_city_match(spark, place, city, expected):
    got = values(spark, [(place,)], "p string", text.matches_city(F.col("p"), city))
    assert got == [expected]


LATIN = st.text(st.one_of(
    st.characters(min_codepoint=0x20, max_codepoint=0x24F),
    st.characters(min_codepoint=0x300, max_codepoint=0x36F),
    st.characters(min_codepoint=0x1E00, max_codepoint=0x1EFF),
    st.characters(min_codepoint=0x2070, max_codepoint=0x24FF),
    st.characters(min_codepoint=0x3200, max_codepoint=0x33FF),
    st.characters(min_codepoint=0xFB00, max_codepoint=0xFB06),
    st.characters(min_codepoint=0xFF01, max_codepoint=0xFF5E),
    st.characters(min_codepoint=0x1D400, max_codepoint=0x1D7FF),
    st.characters(min_codepoint=0x1F100, max_codepoint=0x1F1FF),
    st.sampled_from("ẚⅧ⑽℀①５Ａ²½㎏")), max_size=20)


def normalized(name):
    base = "".join(
        c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in base)
    return " ".join(kept.lower().split())


@given(st.lists(LATIN, min_size=50, max_size=50))
@settings(max_examples=5, deadline=None)
def test_normalize_text_agrees_with_unicode(spark, names):
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    for row in frame.select("n", text.normalize_text(F.col("n")).alias("v")).collect():
        assert row["v"] == normalized(row["n"])


def test_dedup_keys(spark):
    frame = spark.sql("""SELECT * FROM VALUES
        ('m1', 'Paris', 'co', TIMESTAMP '2024-01-01 00:00:00'),
        ('', 'Paris', 'co', TIMESTAMP '2024-01-01 00:00:00'),
        (NULL, 'Paris', 'co', TIMESTAMP '2024-01-01 00:00:00')
        AS t(message_id, city, parameter, event_time)""")
    got = [r[0] for r in frame.select(keys.air_dedup_key()).collect()]
    assert got == ["m1"] + ["Paris||co||2024-01-01 00:00:00"] * 2


def test_content_id_and_publish_keys(spark):
    import hashlib

    frame = spark.createDataFrame([(12, None, "co", "")], "a int, city string, p string, c string")
    row = frame.select(
        keys.content_id(F.col("a"), F.col("city"), F.col("p")).alias("id"),
        keys.air_publish_key_of(F.col("c"), F.col("city"), F.col("p")).alias("key")).first()
    assert row["id"] == hashlib.sha1(b"12||co").hexdigest()
    assert row["key"] == "NA|NA|co"


def test_filters_are_unanchored_and_ignore_case(spark):
    rows = [("Paris",), ("comparison",), ("London",), (None,)]
    assert values(spark, rows, "c string", text.matches_filter(F.col("c"), "PARI")) == [
        True, True, False, None]
    assert values(spark, rows, "c string", text.matches_filter(F.col("c"), ".*")) == [
        True, True, True, False]


def test_literal_counts_as_utc(spark):
    moment = times.literal(datetime(2024, 1, 1, 12))
    assert spark.range(1).select(moment.cast("string")).first()[0] == "2024-01-01 12:00:00"


def test_number_text_is_what_producers_write(spark):
    numbers = [0.0, -0.0, 1.0, 0.1, 0.0005, 0.0001, 9.5e-05, 1e-05, 1.5e-07, 12345678.9, 1e7, 123456.0,
               9007199254740992.0, 1e15, 1e16, 1.25e17, 1e22, 1e100, -0.00025, -3e-09, 3.14159265358979,
               0.00012345678901234, float("inf"), float("-inf"), float("nan")]
    rows = spark.createDataFrame([(n,) for n in numbers], "n double").select(
        "n", keys.number_text(F.col("n")).alias("text"), keys.content_id(F.col("n")).alias("id")).collect()
    import hashlib
    for row in rows:
        assert row["text"] == str(row["n"])
        assert row["id"] == hashlib.sha1(str(row["n"]).encode()).hexdigest()
