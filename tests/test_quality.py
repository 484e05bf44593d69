from datetime import datetime

import pytest
from pyspark.sql import functions as F

from envstream import contracts
from envstream.operators import audit, dedup, parse, quality

AIR = ('{{"city":"Paris","parameter":"{parameter}","value":{value},'
       '"event_time":"{time}","message_id":"{id}"}}')


def air(parameter="pm25", value=10, time="2026-02-08T10:00:00Z", id="m"):
    return AIR.format(parameter=parameter, value=value, time=time, id=id)


def parsed(spark, texts):
    return parse.parse_air(spark.createDataFrame([(t,) for t in texts], "raw_value string"))


REJECT_CASES = [
    ("{bad", "corrupt_json"), ("[]", "corrupt_json"), ("null", "corrupt_json"),
    (air(value='"x"', time=""), "corrupt_json"),
    ("", "missing_event_time"), (None, "missing_event_time"),
    ('{"event_time":"bad","parameter":"co"}', "missing_event_time"),
    ('{"event_time":"10:00","value":1,"city":"Paris"}', "missing_event_time"),
    ('{"event_time":"2026-02-08","parameter":"co"}', "missing_value"),
    ('{"event_time":"2026-02-08","parameter":"co","value":99}', "missing_city"),
    (air("co", 50.01), "invalid_range"), (air("pm25", -0.01), "invalid_range"),
    (air("co", 50), None), (air("pm25", 1000), None), (air("so2", -5), None),
]


@pytest.mark.parametrize("message, reason", REJECT_CASES)
def test_air_reject_reason(spark, message, reason):
    rows = quality.air_rejects(parsed(spark, [message]), datetime(2026, 2, 9)).collect()
    assert [r["reject_reason"] for r in rows] == ([reason] if reason else [])


def test_every_air_row_ends_in_one_place(spark):
    rows = parsed(spark, [m for m, _ in REJECT_CASES])
    rejects = quality.air_rejects(rows).count()
    silver = quality.plausible_air(quality.usable_air(rows)).count()
    outcome = {r["disposition"]: r["n"] for r in quality.air_disposition(rows).groupBy(
        "disposition").agg(F.count("*").alias("n")).collect()}
    dropped = outcome["dropped_unsupported_parameter"]
    assert (rejects, silver, dropped) == (12, 2, 1)
    assert rejects + silver + dropped == len(REJECT_CASES) == sum(outcome.values())
    strict = quality.air_rejects(rows, strict=True).count()
    assert strict == rejects + dropped


def weather(spark, **changes):
    fields = {"city": "Paris", "event_time": "2026-02-08", "temperature": 20, "wind_speed": 3,
              "humidity": 50, **changes}
    text = "{" + ",".join(
        f'"{k}":{v}' if not isinstance(v, str) else f'"{k}":"{v}"'
        for k, v in fields.items() if v is not None) + "}"
    return parse.parse_weather(spark.createDataFrame([(text,)], "raw_value string"))


@pytest.mark.parametrize("changes, reason, kept", [
    ({}, None, True),
    ({"temperature": -50}, None, True), ({"temperature": 60}, None, True),
    ({"temperature": -50.1}, "invalid_range", False),
    ({"humidity": 0}, None, True), ({"humidity": 101}, "invalid_range", False),
    ({"wind_speed": 0}, None, True), ({"wind_speed": -0.1}, "invalid_range", False),
    ({"temperature": None}, None, False),
    ({"temperature": None, "humidity": 200}, "invalid_range", False),
    ({"humidity": "many"}, "corrupt_json", False),
    ({"city": None}, "missing_city", False),
    ({"event_time": None, "city": None}, "missing_event_time", False),
])
def test_weather_outcome(spark, changes, reason, kept):
    rows = weather(spark, **changes)
    found = [r["reject_reason"] for r in quality.weather_rejects(rows).collect()]
    assert found == ([reason] if reason else [])
    assert quality.plausible_weather(quality.usable_weather(rows)).count() == int(kept)


def test_strict_weather(spark):
    unknown = weather(spark, wind_unit="furlong")
    assert quality.weather_rejects(unknown).count() == 0
    assert quality.weather_rejects(unknown, strict_units=True).count() == 1
    assert quality.usable_weather(unknown, strict_units=True).count() == 0
    missing = weather(spark, temperature=None)
    reasons = [r["reject_reason"] for r in quality.weather_rejects(missing, strict=True).collect()]
    assert reasons == ["missing_measurement"]


def test_whole_numbers_only_in_humidity(spark):
    row = weather(spark, humidity="55.0").select("humidity", "corrupt_record").first()
    assert row["humidity"] is None and row["corrupt_record"] is not None


def test_references_become_text(spark):
    text = '{"location_id":12,"sensor_id":"s7","parameter_id":3,"unknown":true}'
    row = parsed(spark, [text]).first()
    assert (row["location_id"], row["sensor_id"], row["parameter_id"]) == ("12", "s7", 3)
    assert row["corrupt_record"] is None


def test_dedup_air(spark):
    rows = quality.usable_air(parsed(spark, [
        air(id="a"), air(id="a"), air(id=""), air(id=""), air(id="b"),
        air(id="", time="2026-02-08T10:00:01Z")]))
    assert sorted(r["message_id"] for r in dedup.dedup_air(rows).collect()) == ["", "", "a", "b"]


def test_dedup_keeps_the_earliest(spark):
    rows = quality.usable_air(parsed(spark, [
        air(id="a", value=2, time="2026-02-08T11:00:00Z"), air(id="a", value=1)]))
    assert [r["value"] for r in dedup.dedup_air(rows).collect()] == [1.0]


def test_latest_by_prefers_order_then_columns(spark):
    rows = spark.createDataFrame(
        [("k", 1, "x"), ("k", 2, "y"), ("k", 2, "z"), ("k", None, "w"), ("n", None, "q")],
        "key string, at int, v string")
    latest = dedup.latest_by(rows, ["key"], F.col("at")).collect()
    assert {(r["key"], r["v"]) for r in latest} == {("k", "z"), ("n", "q")}


def conforming():
    fields = {}
    for name, kinds in contracts.AIR_MESSAGE_KINDS.items():
        fields[name] = '"x"' if "string" in kinds else "1"
    return fields


@pytest.mark.parametrize("changes, violations", [
    ({}, []),
    ({"city": "null", "value": "null", "parameter_id": "null"}, []),
    ({"location_id": "12", "value": "1.5", "latitude": "1e-5"}, []),
    ({"city": None}, ["missing:city"]),
    ({"extra": "1"}, ["unknown:extra"]),
    ({"message_id": '""'}, ["empty:message_id"]),
    ({"source": "null"}, ["type:source"]),
    ({"value": '"12"'}, ["type:value"]),
    ({"parameter_id": "1.5"}, ["type:parameter_id"]),
    ({"city": "{}"}, ["type:city"]),
    ({"location_id": "[1]", "extra": "{}"}, ["type:location_id", "unknown:extra"]),
])
def test_contract(spark, changes, violations):
    fields = {k: v for k, v in {**conforming(), **changes}.items() if v is not None}
    text = "{" + ",".join(f'"{k}":{v}' for k, v in fields.items()) + "}"
    raw = spark.createDataFrame([(text,)], "raw_value string")
    row = audit.contract_violations(raw, contracts.AIR_MESSAGE_KINDS).first()
    assert row["violations"] == violations


def test_contract_needs_an_object(spark):
    raw = spark.createDataFrame([("[1]",), ("{bad",), (None,)], "raw_value string")
    rows = audit.contract_violations(raw, contracts.WEATHER_MESSAGE_KINDS).collect()
    assert [r["violations"] for r in rows] == [["not_an_object"]] * 3


def test_weather_constraints(spark):
    rows = spark.sql("""SELECT TIMESTAMP '2024-01-01' AS window_start, NULL AS window_end,
        'Paris' AS city, 1D AS avg_temperature, h AS avg_humidity, 1D AS avg_wind_speed,
        '1 day' AS window_duration FROM VALUES (0D), (100D), (100.5D) AS t(h)""")
    found = {r["rule"]: r["violations"] for r in audit.audit_constraints(
        rows, audit.domain_rules("weather")).collect()}
    assert found["humidity_range"] == 1 and found["duration_domain"] == 3
    assert found["window_end_not_null"] == 3 and found["city_not_null"] == 0


def test_observed_dispositions(spark):
    from pyspark.sql import Observation

    rows = quality.air_disposition(parsed(spark, [m for m, _ in REJECT_CASES]))
    observation = Observation("outcome")
    quality.observe_dispositions(rows, observation, ["kept", "corrupt_json"]).collect()
    assert observation.get == {"kept": 2, "corrupt_json": 4}
