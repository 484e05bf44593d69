import json
import time
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from envstream import contracts
from envstream.operators import windows
from envstream.plans.flows import AirFlow, WeatherFlow
from envstream.session import work_dir
from envstream.sources import streams
from envstream.sources.tables import read_or_empty
from envstream.streaming import queries, state
from envstream.streaming.batches import AirMetricsBatch, PeaksBatch, table_writer

START = datetime(2024, 1, 1)


def message(minute, value=10.0, id=None, city="Paris", parameter="pm25"):
    at = START + timedelta(minutes=minute)
    return json.dumps({
        "city": city, "parameter": parameter, "value": value,
        "event_time": at.isoformat() + "Z", "message_id": id or f"{city}-{minute}-{value}"})


def send(spark, root, *texts):
    rows = [(t, START, "air_quality_raw", 0, n) for n, t in enumerate(texts)]
    spark.createDataFrame(rows, contracts.SOURCE_RECORD).coalesce(1).write.mode(
        "append").parquet(f"{root}/in")


def settings(root, **options):
    return queries.StreamSettings(root, f"{root}/ck", available_now=True, **options)


def raw(spark, root, **options):
    return streams.file_stream(spark, f"{root}/in", **options)


def table(spark, root, contract):
    return read_or_empty(spark, f"{root}/{contract.location}", contract.schema)


def run_gold(spark, root):
    rows = windows.with_window_date(AirFlow(raw(spark, root), ["5 minutes"]).metrics)
    query = queries.start_layer(rows, contracts.GOLD_AIR, settings(root))
    query.awaitTermination()
    return query


def averages(spark, root):
    return {((r["window_start"] - START).total_seconds() / 60, r["city"]): r["rolling_avg"]
            for r in table(spark, root, contracts.GOLD_AIR).collect()}


def test_duplicates_late_rows_and_state(spark):
    root = work_dir(spark, "t")
    send(spark, root, message(0, 10, "a"), message(1, 20, "b"), message(1, 20, "b"))
    run_gold(spark, root)
    assert averages(spark, root) == {}
    # The same message again in a later batch, and enough time for the first window to close.
    send(spark, root, message(1, 20, "b"), message(2, 30, "c"), message(400, 1, "d"))
    run_gold(spark, root)
    assert averages(spark, root) == {(0, "Paris"): 20.0}
    # The watermark is now at minute 40: minute 3 is late, minute 45 is not.
    send(spark, root, message(3, 999, "e"), message(45, 7, "f"), message(900, 1, "g"))
    query = run_gold(spark, root)
    assert averages(spark, root) == {
        (0, "Paris"): 20.0, (45, "Paris"): 7.0, (400, "Paris"): 1.0}
    operators = query.lastProgress["stateOperators"]
    assert all(op["numRowsTotal"] <= 2 for op in operators)


def test_admission_control_splits_the_input(spark):
    root = work_dir(spark, "t")
    for n in range(3):
        send(spark, root, message(n))
    query = queries.start_layer(
        AirFlow(raw(spark, root, max_files_per_trigger=1)).bronze, contracts.BRONZE_AIR,
        settings(root))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert table(spark, root, contracts.BRONZE_AIR).count() == 3


def test_open_windows_are_revised(spark):
    """Peaks and gold follow every revision and end as one batch over everything would."""
    root = work_dir(spark, "t")
    live = contracts.TableContract(
        "air_quality_metrics", "serving/air", contracts.GOLD_AIR.schema, ("window_date",))

    def run():
        queries.run_to_end(queries.start_air(
            AirFlow(raw(spark, root), ["5 minutes"]), settings(root),
            table_writer(live, root, contracts.AIR_METRIC_KEY)))
        queries.run_to_end([queries.start_peaks(spark, settings(root), ["5 minutes"])])
        peaks = table(spark, root, contracts.GOLD_PEAKS).collect()
        return {(r["window_start"] - START).total_seconds() / 60: r["delta"] for r in peaks}

    send(spark, root, message(0, 10), message(6, 30), "{bad", message(7, -1))
    assert run() == {5: 20.0}
    send(spark, root, message(1, 50))        # first window now 30: no rise any more
    assert run() == {}
    send(spark, root, message(8, 170), message(11, 101))
    assert run() == {5: 70.0}
    assert averages(spark, root) == {(0, "Paris"): 30.0, (5, "Paris"): 100.0, (10, "Paris"): 101.0}
    assert table(spark, root, live).count() == 3
    assert table(spark, root, contracts.REJECTS_AIR).count() == 2
    assert table(spark, root, contracts.SILVER_AIR).count() == 5
    assert table(spark, root, contracts.BRONZE_AIR).count() == 7


def test_repeated_batch_changes_nothing(spark):
    root = work_dir(spark, "t")
    callback, peaks = AirMetricsBatch(root, preview=True), PeaksBatch(root, preview=True)

    def batch(*rows):
        full = [(START + timedelta(minutes=m), START + timedelta(minutes=m + 5), "Paris", "pm25",
                 float(a), "OK", "5 minutes", 1.0, float(d), True) for m, a, d in rows]
        return spark.createDataFrame(full, contracts.PEAKS)

    def state():
        return [sorted(table(spark, root, t).collect())
                for t in (contracts.GOLD_AIR, contracts.REVISIONS_AIR, contracts.GOLD_PEAKS)]

    for number, rows in enumerate([[(0, 1, 2), (5, 30, 3)], [(5, 40, 4), (10, 80, 5)]]):
        callback(batch(*rows), number)
        peaks(batch(*rows), number)
    once = state()
    callback(batch((5, 40, 4), (10, 80, 5)), 1)
    peaks(batch((5, 40, 4), (10, 80, 5)), 1)
    assert state() == once and [len(rows) for rows in once] == [3, 4, 3]
    callback(batch(), 2)
    peaks(batch(), 2)
    assert state() == once


def test_peak_state_is_kept_per_series(spark):
    """Only touched series are updated, windows leave once they are closed, and silent series at last."""
    root, found = work_dir(spark, "t"), []
    schema = "window_start timestamp, window_end timestamp, city string, parameter string, " \
             "rolling_avg double, status string, window_duration string, revision long"

    def send_windows(*rows):
        spark.createDataFrame([
            (START + timedelta(minutes=m), START + timedelta(minutes=m + 5), city, "pm25", float(a),
             None, "5 minutes", revision) for m, city, a, revision in rows], schema).coalesce(
            1).write.mode("append").parquet(f"{root}/in")

    def run():
        found.clear()
        rows = state.peak_rows(
            spark.readStream.schema(schema).parquet(f"{root}/in"), "30 minutes", ["5 minutes"], "2 days")
        with state.keyed_store(spark):
            query = queries.start_batches(
                rows, lambda b, _: found.extend(b.collect()), "peaks", settings(root))
        query.awaitTermination()
        deltas = {(r["city"], (r["window_start"] - START).total_seconds() / 60): r["delta"] for r in found}
        store = [p["stateOperators"][0] for p in query.recentProgress]
        return deltas, max(s["numRowsUpdated"] for s in store), store[-1]["numRowsTotal"]

    send_windows((0, "Paris", 10, 0), (5, "Paris", 99, 0), (5, "Paris", 30, 1), (0, "Rome", 1, 0))
    assert run() == ({("Paris", 0): None, ("Paris", 5): 20.0, ("Rome", 0): None}, 2, 2)
    # An earlier window is revised, which the one after it is compared with again.
    send_windows((0, "Paris", 20, 2))
    assert run() == ({("Paris", 0): None, ("Paris", 5): 10.0}, 1, 2)
    # Much later: the last window before is still known, the one before that is not.
    send_windows((1000, "Paris", 50, 3))
    assert run()[0] == {("Paris", 1000): 20.0}
    send_windows((1005, "Paris", 50, 4), (3080, "Oslo", 1, 4))
    assert run()[2] == 3 - 1  # Rome left: its time ran out
    send_windows((3085, "Rome", 7, 5))
    assert run()[0] == {("Rome", 3085): None}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != state.STORE_SETTINGS[
        "spark.sql.streaming.stateStore.providerClass"]


def test_weather_gold_is_final_and_serving_is_live(spark):
    root = work_dir(spark, "t")
    live = contracts.TableContract(
        "weather_metrics", "serving/weather", contracts.GOLD_WEATHER.schema, ("window_date",))
    texts = [json.dumps({
        "city": "Paris", "event_time": (START + timedelta(minutes=m)).isoformat() + "Z",
        "temperature": t, "humidity": 50, "wind_speed": 1.0, "message_id": f"m{m}"})
        for m, t in ((0, 10.0), (1, 20.0), (500, 5.0))]
    send(spark, root, *texts)
    queries.run_to_end(queries.start_weather(
        WeatherFlow(raw(spark, root), ["10 minutes"]), settings(root),
        table_writer(live, root, contracts.WEATHER_METRIC_KEY)))
    final = table(spark, root, contracts.GOLD_WEATHER).collect()
    assert [r["avg_temperature"] for r in final] == [15.0]
    assert table(spark, root, live).count() == 2


READINGS = "city string, event_time timestamp, n int, value double"


def run_changes(spark, root, ttl, *rows):
    """Numbers of the readings that one more batch hands on."""
    kept = []
    spark.createDataFrame(
        [(c, None if h is None else START + timedelta(hours=h), n, v) for c, h, n, v in rows],
        READINGS).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(READINGS).parquet(f"{root}/in")
    queries.start_changes(
        stream, lambda b, _: kept.extend(r["n"] for r in b.collect()), "changes", settings(root),
        ["city"], "event_time", ["n"], ["event_time", "value"], ttl).awaitTermination()
    return sorted(kept)


def test_change_only_across_batches(spark):
    root = work_dir(spark, "t")
    first = [("Paris", 0, 2, 5.0), ("Paris", 0, 1, 5.0), ("Rome", 0, 3, 1.0), ("Rome", None, 4, None)]
    assert run_changes(spark, root, "1 day", *first) == [1, 3, 4]
    # A reading from the far future forgets nobody, and sensors that report in turn bring nothing new.
    assert run_changes(spark, root, "1 day", ("Oslo", 600_000, 5, 1.0), ("Paris", 1, 6, 5.0),
                       ("Paris", 0, 7, 5.0), ("Rome", None, 8, None)) == [5, 6]
    assert run_changes(spark, root, "1 day", ("Paris", 0, 9, 5.0), ("Paris", 1, 10, 5.0),
                       ("Rome", 0, 11, 2.0), ("Oslo", 600_000, 12, 1.0)) == [11]


def test_known_readings_expire_by_the_clock(spark):
    root = work_dir(spark, "t")
    for _ in range(2):
        assert run_changes(spark, root, "1 second", ("Paris", 0, 1, 5.0)) == [1]
        time.sleep(1.5)


def test_contents_share_entries_of_the_state(spark, monkeypatch):
    monkeypatch.setattr(state, "CONTENT_BUCKETS", 4)
    root, kept, big = work_dir(spark, "t"), [], 2**53 + 1
    rows = [("Paris", None if n % 3 == 0 else START, None if n % 5 == 0 else big + n, float(n))
            for n in range(40)]
    schema = READINGS.replace("n int", "n bigint")
    spark.createDataFrame(rows + rows, schema).write.parquet(f"{root}/in")
    query = queries.start_changes(
        spark.readStream.schema(schema).parquet(f"{root}/in"),
        lambda b, _: kept.extend((r["event_time"] is None, r["n"], r["value"]) for r in b.collect()),
        "changes", settings(root), ["city"], "event_time", ["n"], ["event_time", "value"], "1 day")
    query.awaitTermination()
    assert sorted(kept, key=lambda r: r[2]) == [(t is None, n, v) for _, t, n, v in rows]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4


def test_a_day_of_a_batch_has_few_files(spark):
    root = work_dir(spark, "t")
    rows = [(message(n), START, "air_quality_raw", 0, n) for n in range(64)]
    spark.createDataFrame(rows, contracts.SOURCE_RECORD).repartition(16).write.parquet(f"{root}/in")
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(128 << 20))  # a task for each file
    try:
        queries.start_layer(
            AirFlow(raw(spark, root)).bronze, contracts.BRONZE_AIR, settings(root)).awaitTermination()
    finally:
        spark.conf.set(name, before)
    files = list(Path(root).glob(f"{contracts.BRONZE_AIR.location}/*/*/*.parquet"))
    assert 0 < len(files) <= queries.PARTITION_TASKS
    assert table(spark, root, contracts.BRONZE_AIR).count() == 64


def test_one_end_stops_all(spark):
    root = work_dir(spark, "t")
    send(spark, root, message(0))
    running = queries.StreamSettings(root, f"{root}/ck", trigger_interval="1 second")
    bronze = queries.start_layer(AirFlow(raw(spark, root)).bronze, contracts.BRONZE_AIR, running)

    def failing(batch, batch_id):
        raise ValueError("broken sink")

    broken = queries.start_batches(AirFlow(raw(spark, root)).metrics, failing, "broken", running)
    with pytest.raises(Exception, match="broken sink"):
        queries.run_until_any_ends(spark, [bronze, broken])
    assert not bronze.isActive and not broken.isActive
    spark.streams.resetTerminated()


def test_console_and_fresh_run(spark):
    root = work_dir(spark, "t")
    send(spark, root, message(0))
    for run in ("one", "two"):
        fresh = settings(root).fresh(run)
        query = queries.start_console(AirFlow(raw(spark, root)).metrics, "console", fresh)
        query.awaitTermination()
        assert query.exception() is None
        assert sum(p["numInputRows"] for p in query.recentProgress) > 0


def test_silver_as_a_source(spark):
    root = work_dir(spark, "t")
    send(spark, root, message(0), message(1))
    queries.start_layer(
        AirFlow(raw(spark, root), silver_dedup=True).silver, contracts.SILVER_AIR,
        settings(root)).awaitTermination()
    stream = streams.table_stream(spark, root, contracts.SILVER_AIR)
    query = stream.groupBy("city").agg(F.count("*").alias("n")).writeStream.outputMode(
        "complete").format("memory").queryName("silver_counts").option(
        "checkpointLocation", f"{root}/ck2").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [tuple(r) for r in spark.table("silver_counts").collect()] == [("Paris", 2)]


def test_payload_stream_to_records(spark):
    from envstream.operators import providers
    from envstream.sinks import messages
    from envstream.sources import payloads

    root = work_dir(spark, "t")
    body = json.dumps({
        "current": {"time": "2024-01-01T10:00", "temperature_2m": 1.5, "wind_speed_10m": 2.0,
                    "relative_humidity_2m": 50}})
    spark.createDataFrame(
        [("FR", "Paris", 48.0, 2.0, body)], payloads.WEATHER_RESPONSES).write.json(f"{root}/in")
    responses = payloads.responses(
        spark, f"{root}/in", payloads.WEATHER_RESPONSES, streaming=True)
    records = messages.weather_records(
        providers.recent_only(providers.forecast_messages(responses, START), START))
    query = records.writeStream.format("memory").queryName("published").option(
        "checkpointLocation", f"{root}/ck").trigger(availableNow=True).start()
    query.awaitTermination()
    row = spark.table("published").first()
    sent = json.loads(row["value"])
    assert row["key"] == "Paris|open-meteo"
    assert sent["temperature"] == 1.5 and sent["event_time"] == "2024-01-01T10:00:00+00:00"
    assert list(sent) == contracts.WEATHER_MESSAGE.fieldNames()
