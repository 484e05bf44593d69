import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from envstream.operators import providers
from envstream.plans import flows

NOW = datetime(2026, 2, 8, 12)
SENSORS = [{"id": 7, "parameter": {"id": 2, "name": "pm25", "units": "µg/m³"}},
           {"id": 8, "parameter": None},
           {"id": 8, "parameter": {"id": 5, "name": "no2", "units": "ppb"}},
           {"id": 8, "parameter": {"id": 6, "name": "other", "units": "x"}}]


def station(id, name, utc=None, sensors=SENSORS, **more):
    reported = {"datetimeLast": {"utc": utc}} if utc else {}
    return {"id": id, "name": name, "sensors": sensors,
            "coordinates": {"latitude": 48.0, "longitude": 2.0}, **reported, **more}


def station_responses(spark, *stations, country="FR"):
    return spark.createDataFrame(
        [(country, json.dumps({"results": list(stations)}))], "country string, body string")


def latest_responses(spark, *items, location_id="1"):
    return spark.createDataFrame(
        [(location_id, json.dumps({"results": list(items)}))],
        "location_id string, body string")


@pytest.mark.parametrize("item, expected", [
    ({"datetime": {"utc": "a", "local": "b"}}, "a"),
    ({"datetime": {"local": "b"}, "lastUpdated": "z"}, "b"),
    ({"datetime": {"other": 1}, "lastUpdated": "z"}, None),
    ({"datetime": "c", "datetimeLast": {"utc": "d"}}, "c"),
    ({"datetimeLast": {"utc": "d"}, "period": {"datetimeTo": {"utc": "e"}}}, "d"),
    ({"period": {"datetimeTo": {"utc": "e"}, "datetimeFrom": {"utc": "f"}}}, "e"),
    ({"period": {"datetimeFrom": {"utc": "f"}}}, "f"),
    ({"date": {"utc": "g"}, "date_utc": "x"}, "g"),
    ({"date": {"local": "h"}}, "h"),
    ({"date_utc": "i", "lastUpdated": "j"}, "i"),
    ({"lastUpdated": "j", "date": "k"}, "j"),
    ({"date": "k"}, "k"), ({"value": 1}, None),
])
def test_reading_time(spark, item, expected):
    items = providers.latest_items(latest_responses(spark, item))
    assert items.select(providers.reading_time_text()).first()[0] == expected


def message(spark, item, **more):
    chosen = providers.city_stations(providers.stations(
        station_responses(spark, station(1, "Paris 5e", **more))))
    items = providers.latest_items(latest_responses(spark, item))
    return providers.air_messages(items, chosen, NOW).first()


def test_message_with_own_fields(spark):
    row = message(spark, {
        "value": "12.5", "sensorsId": 7, "parameter": {"id": 9, "name": "o3", "units": "ppm"},
        "coordinates": {"latitude": 1, "longitude": "x"}, "datetime": {"utc": "2026-02-08T11:00Z"}},
        provider={"name": "net"})
    assert (row["parameter"], row["unit"], row["parameter_id"]) == ("o3", "ppm", 9)
    assert (row["value"], row["latitude"], row["longitude"]) == (12.5, 1.0, None)
    assert (row["city"], row["station_city"], row["country"]) == ("Paris", "Paris 5e", "FR")
    assert (row["provider"], row["sensor_id"], row["location_id"]) == ("net", "7", "1")
    assert row["ingestion_time"] == "2026-02-08T12:00:00+00:00"
    assert row["event_time"] == "2026-02-08T11:00Z"


def test_message_completed_from_the_first_usable_sensor(spark):
    row = message(spark, {"value": 3, "sensor": {"id": 8}}, owner="someone")
    assert (row["parameter"], row["unit"], row["parameter_id"]) == ("no2", "ppb", 5)
    assert (row["latitude"], row["longitude"], row["provider"]) == (48.0, 2.0, "someone")
    row = message(spark, {"value": None, "sensorId": 7, "parameter": "co", "unit": ""})
    assert (row["parameter"], row["unit"], row["parameter_id"]) == ("co", "µg/m³", 2)
    assert row["value"] is None
    row = message(spark, {"value": True, "sensorsId": 99, "coordinates": {}})
    assert (row["parameter"], row["value"], row["latitude"]) == (None, None, 48.0)


def test_best_station(spark):
    responses = station_responses(
        spark, station(1, "Paris A", "2026-02-08T10:00:00Z"),
        station(2, "Paris B", "2026-02-08T11:00:00Z"), station(3, "Paris C"),
        station(4, "Parish", "2026-02-08T12:00:00Z"),
        station(5, "Paris D", "2026-02-08T12:00:00Z", sensors=[]),
        station(6, "Paris E", "2026-02-08T11:00:00Z"))
    candidates = providers.city_stations(providers.stations(responses))
    assert sorted(r["id"] for r in candidates.collect()) == ["1", "2", "3", "6"]
    assert [r["id"] for r in providers.best_stations(candidates).collect()] == ["2"]
    items = latest_responses(spark, {"value": 1, "sensorsId": 7}, location_id="1")
    rows = flows.air_ingestion(responses, items, NOW).collect()
    assert [(r["location_id"], r["parameter"]) for r in rows] == [("1", "pm25")]


def weather_responses(spark, body):
    return spark.createDataFrame(
        [("FR", "Paris", 48.0, 2.0, json.dumps(body))],
        "country string, city string, latitude double, longitude double, body string")


def test_forecast_message(spark):
    row = providers.forecast_messages(weather_responses(spark, {
        "current": {"time": "2026-02-08T10:00", "temperature_2m": 50, "wind_speed_10m": 36,
                    "relative_humidity_2m": 55},
        "current_units": {"temperature_2m": "°F", "wind_speed_10m": "km/h"}}), NOW).first()
    assert (row["temperature"], row["wind_speed"], row["humidity"]) == (10.0, 10.0, 55)
    assert row["event_time"] == "2026-02-08T10:00:00+00:00"
    assert (row["temperature_unit"], row["wind_unit"], row["humidity_unit"]) == ("C", "m/s", "%")


def test_observation_message(spark):
    row = providers.observation_messages(weather_responses(spark, {
        "main": {"temp": 10.5, "humidity": 55}, "wind": {"speed": 2}, "dt": 1770544800}),
        NOW).first()
    assert (row["temperature"], row["wind_speed"], row["humidity"]) == (10.5, 2.0, 55)
    assert row["event_time"] == "2026-02-08T10:00:00+00:00"
    empty = providers.observation_messages(weather_responses(spark, {"dt": "x"}), NOW).first()
    assert empty["event_time"] is None and empty["temperature"] is None


@pytest.mark.parametrize("event_time, late, expected", [
    ("2026-02-08T06:00:00Z", True, True), ("2026-02-08T05:59:59Z", True, False),
    ("2026-02-08T11:15:00Z", False, True), ("2026-02-08T11:14:59Z", False, False),
    ("2026-02-08T13:00:00Z", False, True), ("bad", True, False), (None, True, False)])
def test_recency(spark, event_time, late, expected):
    rows = spark.createDataFrame([(event_time,)], "event_time string")
    assert providers.recent_only(rows, NOW, late).count() == int(expected)


def test_ingestion_dispositions(spark):
    rows = spark.createDataFrame(
        [(None, False), ("2026-02-01T00:00:00Z", True), ("2026-02-08T11:00:00Z", True),
         ("2026-02-08T11:00:00Z", False)], "event_time string, again boolean")
    found = providers.ingestion_disposition(rows, NOW, F.col("again")).collect()
    assert [r["disposition"] for r in found] == [
        "missing_time", "skipped_old", "skipped_dup", "produced"]


def test_newest_keys(spark):
    rows = spark.sql("""SELECT * FROM VALUES ('a', TIMESTAMP '2026-02-08 11:00:00'),
        ('b', TIMESTAMP '2026-02-07 12:00:00'), ('c', TIMESTAMP '2026-02-07 11:59:59'),
        ('d', NULL) AS t(k, updated_at)""")
    def kept(n): return sorted(r["k"] for r in providers.newest_keys(rows, NOW, n).collect())
    assert kept(10) == ["a", "b", "d"] and kept(2) == ["a", "d"]
