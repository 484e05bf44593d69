import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from envstream import contracts, rules
from envstream.operators import peaks, series, windows

START = datetime(2024, 1, 1)
METRICS = ("window_start timestamp, window_end timestamp, city string, parameter string, "
           "rolling_avg double, status string, window_duration string")


def metric(minute, average, city="Paris", parameter="pm25", duration="5 minutes"):
    at = START + timedelta(minutes=minute)
    return (at, at + timedelta(minutes=5), city, parameter, float(average), "OK", duration)


def metrics(spark, *rows):
    return spark.createDataFrame(list(rows), METRICS)


def test_rollup_matches_brute_force(spark):
    rng = random.Random(7)
    rows = [(START + timedelta(seconds=rng.randrange(7200)), rng.choice(["Paris", "Rome"]),
             rng.choice(["co", "o3"]), float(rng.randrange(100))) for _ in range(400)]
    frame = spark.createDataFrame(rows, "event_time timestamp, city string, parameter string, "
                                        "value double")
    expected = defaultdict(list)
    for at, city, parameter, value in rows:
        for minutes in (5, 10):
            begin = at - timedelta(minutes=at.minute % minutes, seconds=at.second)
            expected[begin, begin + timedelta(minutes=minutes), city, parameter,
                     f"{minutes} minutes"].append(value)
    got = {
        (r["window_start"], r["window_end"], r["city"], r["parameter"], r["window_duration"]):
        r["rolling_avg"] for r in windows.air_averages(frame).collect()}
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert got[key] == pytest.approx(sum(values) / len(values))


def test_weather_average_ignores_missing(spark):
    rows = [(START, "Paris", 10.0, 50.0, 1.0), (START, "Paris", 20.0, None, 3.0)]
    frame = spark.createDataFrame(
        rows, "event_time timestamp, city string, temperature_c double, humidity_pct double, "
              "wind_speed_ms double")
    row = windows.weather_averages(frame, ["5 minutes"]).first()
    assert (row["avg_temperature"], row["avg_humidity"], row["avg_wind_speed"]) == (15, 50, 2)


def test_previous_row_matches_brute_force_on_a_dominant_series(spark):
    """Half of all rows are one series; gaps leave slices empty; times repeat."""
    rng = random.Random(11)
    rows = []
    for number in range(600):
        key = "hot" if number % 2 else f"k{rng.randrange(6)}"
        at = START + timedelta(hours=rng.choice([0, 1, 2, 5, 30, 31, 200]),
                               minutes=rng.randrange(60))
        rows.append((key, at, number, rng.random()))
    frame = spark.createDataFrame(rows, "k string, at timestamp, n int, v double")
    previous = {}
    by_key = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        previous[row[2]] = by_key[row[0]][-1] if by_key[row[0]] else None
        by_key[row[0]].append(row[3])
    found = series.with_previous(frame, ["k"], "at", ["n"], ["v"], "1 hour").collect()
    assert len(found) == len(rows)
    for row in found:
        assert (row["previous"]["v"] if row["previous"] else None) == previous[row["n"]]


def test_previous_row_keeps_missing_keys_and_values(spark):
    frame = spark.createDataFrame(
        [(None, START, 1, None), (None, START + timedelta(days=9), 2, 5.0)],
        "k string, at timestamp, n int, v double")
    rows = {r["n"]: r["previous"] for r in series.with_previous(
        frame, ["k"], "at", ["n"], ["v"]).collect()}
    assert rows[1] is None and rows[2] is not None and rows[2]["v"] is None


def test_change_only_matches_sequential_rule(spark):
    rng = random.Random(3)
    rows = [("Paris", START + timedelta(hours=rng.randrange(4)), n, rng.choice([1.0, 2.0, None]))
            for n in range(200)]
    frame = spark.createDataFrame(rows, "city string, at timestamp, n int, v double")
    kept, seen = [], set()
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        if (row[1], row[3]) not in seen:
            kept.append(row[2])
            seen.add((row[1], row[3]))
    got = series.change_only(frame, ["city"], "at", ["n"], ["at", "v"]).collect()
    assert sorted(r["n"] for r in got) == sorted(kept)


def test_peaks(spark):
    found = peaks.detect_peaks(metrics(
        spark, metric(0, 10), metric(5, 25), metric(10, 39.9), metric(20000, 60),
        metric(0, 5, parameter="co"), metric(5, 6, parameter="co"),
        metric(5, 500, city="Rome"))).collect()
    flags = {(r["city"], r["parameter"], r["window_start"]): r["is_peak"] for r in found}
    def at(minute): return START + timedelta(minutes=minute)
    assert flags == {
        ("Paris", "pm25", at(0)): False, ("Paris", "pm25", at(5)): True,
        ("Paris", "pm25", at(10)): False, ("Paris", "pm25", at(20000)): True,
        ("Paris", "co", at(0)): False, ("Paris", "co", at(5)): True,
        ("Rome", "pm25", at(5)): False}


def test_state_is_used_only_when_earlier(spark):
    state = peaks.latest_state(metrics(spark, metric(5, 10)))
    rows = peaks.detect_peaks(metrics(spark, metric(5, 40), metric(10, 60)), state).collect()
    assert {r["window_start"].minute: r["prev_rolling_avg"] for r in rows} == {5: None, 10: 40.0}
    rows = peaks.detect_peaks(metrics(spark, metric(10, 60)), state).collect()
    assert rows[0]["prev_rolling_avg"] == 10.0 and rows[0]["is_peak"]


def test_state_merge_prefers_newer_table_on_ties(spark):
    older = peaks.latest_state(metrics(spark, metric(5, 10), metric(20, 1, city="Rome")))
    newer = peaks.latest_state(metrics(spark, metric(5, 11), metric(0, 2, city="Rome")))
    rows = {r["city"]: r["prev_rolling_avg"] for r in peaks.merge_state(older, newer).collect()}
    assert rows == {"Paris": 11.0, "Rome": 1.0}


@pytest.mark.parametrize("seed", range(3))
def test_days_with_their_neighbours_equal_the_whole(spark, seed):
    """Days far apart, with gaps of many days: the ends of other days stand for all their windows."""
    rng = random.Random(seed)
    minutes = sorted({day * 1440 + rng.randrange(288) * 5 for day in rng.sample(range(60), 12)
                      for _ in range(rng.randint(1, 8))})
    rows = windows.with_window_date(metrics(spark, *[
        metric(m, rng.randrange(80), city) for m in minutes for city in ("Paris", "Rome")
        if rng.random() < 0.8]))
    whole = {(r["window_start"], r["city"]): r["delta"] for r in peaks.detect_peaks(rows).collect()}
    days = sorted({start.date() for start, _ in whole})
    touched = rng.sample(days, 4)
    ends = peaks.window_ends(rows).filter(~F.col("window_date").isin(touched))
    own = rows.filter(F.col("window_date").isin(touched))
    found = {(r["window_start"], r["city"]): r["delta"]
             for r in peaks.peaks_of_changes(peaks.with_neighbours(own, ends)).collect()}
    assert {k for k in whole if k[0].date() in touched} <= set(found)
    assert all(whole[k] == delta for k, delta in found.items())


def test_contract_columns(spark):
    assert peaks.detect_peaks(metrics(spark)).columns == contracts.PEAKS.fieldNames()
    assert contracts.PEAKS.fieldNames()[-1] == "is_peak"
    assert set(rules.PEAK_DELTAS) == set(rules.STATUS_THRESHOLDS) == set(rules.POLLUTANTS)


@pytest.mark.parametrize("order", [(0.1, 0.2, 0.3, 1e15), (1e15, 0.3, 0.2, 0.1), (0.3, 1e15, 0.1, 0.2)])
def test_average_does_not_depend_on_order(spark, order):
    small = [v for v in order if v < 1]
    rows = [(START, "Paris", "pm10", v) for v in small] + [
        (START, "Rome", "pm10", v) for v in (*order, None)] + [(START, "Oslo", "pm10", None)]
    frame = spark.createDataFrame(
        rows, "event_time timestamp, city string, parameter string, value double").coalesce(1)
    found = {r["city"]: r["rolling_avg"] for r in windows.air_averages(frame, ["5 minutes"]).collect()}
    assert found["Paris"] == 0.6 / 3
    assert found["Rome"] == pytest.approx((1e15 + 0.6) / 4, rel=1e-15)
    assert found["Oslo"] is None


def test_a_rise_of_exactly_the_threshold_is_a_peak(spark):
    later = START + timedelta(minutes=5)
    rows = [(START, v) for v in (6.9, 29.2, 3.3)] + [(later, v) for v in (36.9, 59.2, 33.3)]
    for mixed in (rows, rows[::-1]):
        frame = spark.createDataFrame(mixed, "event_time timestamp, value double").coalesce(1).withColumns(
            {"city": F.lit("Paris"), "parameter": F.lit("pm10")})
        met = windows.with_status(windows.air_averages(frame, ["5 minutes"]))
        assert sum(r["is_peak"] for r in peaks.detect_peaks(met).collect()) == 1
