from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import feed
from envstream import contracts
from envstream.operators import parse, serving, windows
from envstream.plans import backfill
from envstream.session import work_dir
from envstream.sinks import catalog, jdbc, messages, tables
from envstream.sources import files, streams
from envstream.sources.jdbc import JdbcSettings
from envstream.sources.tables import read_folders, read_or_empty

DAY = datetime(2024, 1, 1)
GOLD = contracts.GOLD_AIR


def gold(spark, *rows):
    """Rows of (day, city, average)."""
    full = [(DAY + timedelta(days=d), DAY + timedelta(days=d, minutes=5), c, "co", float(a), "OK",
             "5 minutes") for d, c, a in rows]
    frame = spark.createDataFrame(
        full, "window_start timestamp, window_end timestamp, city string, parameter string, "
              "rolling_avg double, status string, window_duration string")
    return windows.with_window_date(frame)


def merge(spark, root, merge_id, *rows, **options):
    tables.merge_by_key(
        gold(spark, *rows), GOLD, root, contracts.AIR_METRIC_KEY, merge_id, **options)


def content(spark, root):
    rows = read_or_empty(spark, f"{root}/{GOLD.location}", GOLD.schema).collect()
    return sorted(((r["window_start"] - DAY).days, r["city"], r["rolling_avg"]) for r in rows)


def test_merge_inserts_replaces_and_repeats(spark):
    root = work_dir(spark, "t")
    merge(spark, root, "0", (0, "A", 1), (0, "A", 2), (1, "A", 3))
    assert content(spark, root) == [(0, "A", 2.0), (1, "A", 3.0)]
    for _ in range(2):
        merge(spark, root, "1", (1, "A", 0), (1, "B", 4), (2, "B", 5))
        assert content(spark, root) == [
            (0, "A", 2.0), (1, "A", 0.0), (1, "B", 4.0), (2, "B", 5.0)]
    merge(spark, root, "2")
    assert len(content(spark, root)) == 4


def test_merge_leaves_other_days_alone(spark):
    root = work_dir(spark, "t")
    merge(spark, root, "0", (0, "A", 1), (1, "A", 1))
    untouched = files.child_names(spark, f"{root}/{GOLD.location}/window_date=2024-01-01")
    merge(spark, root, "1", (1, "B", 1))
    assert files.child_names(
        spark, f"{root}/{GOLD.location}/window_date=2024-01-01") == untouched


def test_merge_keep_empties_a_day(spark):
    root = work_dir(spark, "t")
    keep = F.col("rolling_avg") > 0
    merge(spark, root, "0", (0, "A", 1), (1, "A", 1), keep=keep)
    merge(spark, root, "1", (0, "A", -1), (1, "B", -1), (3, "B", -1), keep=keep)
    assert content(spark, root) == [(1, "A", 1.0)]


@pytest.mark.parametrize("crash_at", range(1, 4))
def test_merge_goes_on_after_a_crash(spark, monkeypatch, crash_at):
    """The run ends anywhere after the staging; running the same merge again completes it."""
    root = work_dir(spark, "t")
    keep = F.col("rolling_avg") > 0
    before = [(d, "A", 1) for d in range(3)]
    merge(spark, root, "0", *before, keep=keep)
    calls = {"n": 0}
    original = files.delete

    def failing(session, path):
        calls["n"] += 1
        if calls["n"] == crash_at:
            for day in range(1, 3):  # as if the overwrite had removed days and not yet replaced them
                original(session, f"{root}/{GOLD.location}/window_date=2024-01-0{day + 1}")
            raise OSError("lost")
        original(session, path)

    batch = [(0, "A", -1), (1, "A", -1), (1, "B", 2), (2, "B", 2)]
    monkeypatch.setattr(files, "delete", failing)
    try:
        merge(spark, root, "1", *batch, keep=keep)
    except OSError:
        monkeypatch.setattr(files, "delete", original)
        merge(spark, root, "1", *batch, keep=keep)
    assert content(spark, root) == [(1, "B", 2.0), (2, "A", 1.0), (2, "B", 2.0)]


def test_merge_looks_at_touched_days_only(spark, monkeypatch):
    root = work_dir(spark, "t")
    merge(spark, root, "0", *[(d, "A", 1) for d in range(6)])
    asked = []
    original = files.exists
    monkeypatch.setattr(files, "exists", lambda s, p: asked.append(p) or original(s, p))
    monkeypatch.setattr(files, "child_names", lambda *_: pytest.fail("lists the table"))
    merge(spark, root, "1", (2, "B", 1))
    days = [p for p in asked if "window_date=" in p]
    assert len(days) == 1 and days[0].endswith("window_date=2024-01-03")


def test_append_happens_once(spark):
    root, table = work_dir(spark, "t"), contracts.REVISIONS_AIR
    rows = gold(spark, (0, "A", 1), (1, "A", 2), (2, "A", 3)).withColumn("revision", F.lit(1).cast("long"))

    def stored():
        found = read_or_empty(spark, f"{root}/{table.location}", table.schema).collect()
        return sorted((r["city"], r["rolling_avg"]) for r in found)

    tables.append_layer(rows.limit(1), table, root, "7", balanced=False)  # as if the rest was lost
    for _ in range(2):
        tables.append_layer(rows, table, root, "7", balanced=False)
        assert stored() == [("A", 1.0), ("A", 2.0), ("A", 3.0)]
    before = files.child_names(spark, f"{root}/{table.location}/merge_id=7")
    tables.append_layer(rows.withColumn("city", F.lit("B")), table, root, "77", balanced=False)
    assert len(stored()) == 6
    assert files.child_names(spark, f"{root}/{table.location}/merge_id=7") == before


def test_replaced_days(spark):
    root = work_dir(spark, "t")
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    tables.replace_days(gold(spark, (0, "A", 1), (1, "A", 2), (2, "A", 3)), GOLD, root, [])
    tables.replace_days(gold(spark, (1, "B", 5)), GOLD, root, days[:2])
    assert content(spark, root) == [(1, "B", 5.0), (2, "A", 3.0)]


def test_partitions_are_added_without_listing(spark, monkeypatch):
    root, database = work_dir(spark, "t"), "added_test"
    catalog.register(spark, root, database)
    rejects = spark.createDataFrame(
        [("x", None, None, None, None, "it's", DAY, DAY.date())], contracts.REJECTS_AIR.schema)
    tables.append_layer(rejects, contracts.REJECTS_AIR, root, "7")
    merge(spark, root, "0", *[(d, "A", 1) for d in range(4)])
    monkeypatch.setattr(files, "child_names", lambda *_: pytest.fail("lists the table"))
    monkeypatch.setattr(catalog, "sync_partitions", lambda *_: pytest.fail("lists the table"))
    for _ in range(2):
        catalog.add_partitions(gold(spark, (2, "A", 1), (3, "A", 1)), GOLD, database)
        catalog.add_partitions(rejects, contracts.REJECTS_AIR, database, "7")
    known = [r[0] for r in spark.sql(f"SHOW PARTITIONS {database}.{GOLD.name}").collect()]
    assert known == ["window_date=2024-01-03", "window_date=2024-01-04"]
    counts = {r["table_name"]: r["rows"] for r in catalog.table_counts(spark, database).collect()}
    assert counts[GOLD.name] == 2 and counts["rejects_air_quality"] == 1
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_merge_order_beats_arrival(spark):
    root = work_dir(spark, "t")
    order = [F.col("rolling_avg")]
    merge(spark, root, "0", (0, "A", 5), order=order)
    merge(spark, root, "1", (0, "A", 3), order=order)
    assert content(spark, root) == [(0, "A", 5.0)]


def test_panel_prunes_partitions(spark):
    root = work_dir(spark, "t")
    merge(spark, root, "0", *[(d, "A", 1) for d in range(5)])
    panel = serving.PanelFilter(DAY, DAY + timedelta(days=3))
    rows = panel.apply(read_or_empty(spark, f"{root}/{GOLD.location}", GOLD.schema), "24 hours")
    assert rows.count() == 2
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan
    assert "PushedFilters: [IsNotNull(window_start), GreaterThanOrEqual(window_start" in plan


def test_catalog(spark):
    root, database = work_dir(spark, "t"), "catalog_test"
    catalog.register(spark, root, database)
    names = [r["tableName"] for r in catalog.list_tables(spark, database).collect()]
    assert names == sorted(t.name for t in contracts.TABLES)
    merge(spark, root, "0", *[(d, "A", 1) for d in range(4)])

    def count():
        rows = catalog.table_counts(spark, database).collect()
        return {r["table_name"]: r["rows"] for r in rows}[GOLD.name]

    assert count() == 0
    catalog.sync_partitions(spark, database)
    assert count() == 4
    now = DAY + timedelta(days=92)
    assert catalog.drop_expired(spark, GOLD, now, database) == ["2024-01-01", "2024-01-02"]
    assert count() == 2 and len(content(spark, root)) == 2
    assert catalog.drop_expired(spark, GOLD, now, database) == []
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_schema_inference_falls_back(spark):
    root = work_dir(spark, "t")
    known = contracts.GOLD_PEAKS.schema
    assert catalog.infer_schema(spark, root, known) == known
    files.make_dirs(spark, root)
    assert catalog.infer_schema(spark, root, known) == known
    spark.range(1).write.mode("overwrite").parquet(root)
    assert catalog.infer_schema(spark, root, known).fieldNames() == ["id"]
    shown = catalog.columns_table(spark, contracts.PEAKS).collect()
    assert (shown[0]["column_name"], shown[0]["data_type"]) == ("window_start", "timestamp")


def test_table_statement():
    sql = catalog.create_table_sql(contracts.REJECTS_AIR, "file:/a'b", "db")
    assert sql.startswith("CREATE TABLE IF NOT EXISTS db.rejects_air_quality (`raw_value` string")
    assert "PARTITIONED BY (reject_date, reject_reason, merge_id)" in sql
    assert sql.endswith("LOCATION 'file:/a''b'")


def test_upsert_statement():
    sql = jdbc.upsert_statement("m", "m_staging", ["k", "v"], ["k"])
    assert sql == ("INSERT INTO m (k, v) SELECT k, v FROM m_staging ON CONFLICT (k) "
                   "DO UPDATE SET v = EXCLUDED.v, ingested_at = NOW()")
    with pytest.raises(ValueError):
        jdbc.upsert_statement("m; drop", "s", ["k"], ["k"])


def test_jdbc_options():
    options = JdbcSettings("jdbc:x:y", "d.D", "u", "p").write_options()
    assert options["batchsize"] == "1000" and options["numPartitions"] == "8"
    assert options["isolationLevel"] == "READ_COMMITTED" and options["user"] == "u"
    assert "password" not in JdbcSettings("jdbc:x:y", "d.D").read_options()


def test_retries():
    calls = []

    def failing():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")

    assert jdbc.with_retries(failing, retries=3, delay_seconds=0)
    assert len(calls) == 3

    def broken():
        raise OSError("gone")

    assert not jdbc.with_retries(broken, retries=1, delay_seconds=0, fail_fast=False)
    with pytest.raises(OSError):
        jdbc.with_retries(broken, retries=1, delay_seconds=0)


def test_write_partitions(spark):
    rows = spark.range(100).repartition(6)
    assert jdbc.with_partitions(rows, 2).rdd.getNumPartitions() == 2
    assert jdbc.with_partitions(rows, 9, grow=True).rdd.getNumPartitions() == 9


def test_kafka_options():
    options = streams.kafka_options("h:1", "t", "earliest", 500)
    assert options["subscribe"] == "t" and options["maxOffsetsPerTrigger"] == "500"
    assert options["failOnDataLoss"] == "false" and options["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in streams.kafka_options("h:1", "t")


def test_weather_records(spark):
    rows = spark.createDataFrame([(None, "s", 1)], "city string, source string, humidity int")
    row = messages.weather_records(rows).first()
    assert (row["key"], row["value"]) == ("NA|s", '{"city":null,"source":"s","humidity":1}')


def test_backfill_writes_few_files_from_many_tasks(spark):
    root = work_dir(spark, "few-files")
    raw = feed.raw_air(spark, "/root/testdata/sf0.001").repartition(16)
    backfill.write_air(raw, root, "0")
    days = list(Path(root).glob("bronze/air_quality/ingest_date=*/merge_id=*"))
    assert days and all(len(list(day.glob("*.parquet"))) == 1 for day in days)


def test_backfill_raises_what_fails_beside_gold(spark):
    root = work_dir(spark, "failing-bronze")
    raw = feed.raw_air(spark, "/root/testdata/sf0.001")
    broken = raw.withColumn("topic", F.when(F.col("offset") >= 0, F.raise_error(F.lit("lost source"))))
    with pytest.raises(Exception, match="lost source"):
        backfill.write_air(broken, root, "0")


def test_backfill_parses_a_message_once(spark):
    root = work_dir(spark, "parsed-once")
    made = spark.sparkContext.accumulator(0)
    records = feed.raw_air(spark, "/root/testdata/sf0.001").limit(100).collect()

    def count(text):
        made.add(1)
        return text

    counted = F.udf(count, "string").asNondeterministic()
    raw = spark.createDataFrame(records, contracts.RAW_ENVELOPE).withColumn(
        "raw_value", counted("raw_value"))
    backfill.write_air(raw, root, "0")
    assert made.value == 2 * len(records)  # bronze, and the parsed rows that silver and rejects share
    kept = spark.read.parquet(f"{root}/{contracts.REJECTS_AIR.location}")
    assert kept.count() > 0 and kept.filter("raw_value IS NULL").count() == 0


def test_missing_folders_leave_no_work(spark):
    nothing = read_folders(spark, work_dir(spark, "missing"), contracts.GOLD_AIR, ["2024-01-01"])
    assert nothing.schema == contracts.GOLD_AIR.schema
    left = spark.createDataFrame([("Paris",)], "city string").join(nothing, "city", "left_anti")
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_gone_readings_take_their_message_along(spark):
    rows = spark.sql("""SELECT * FROM VALUES
        (TIMESTAMP '2024-01-02 10:00:00', 'a', 1D), (TIMESTAMP '2024-01-02 09:00:00', 'a', 2D),
        (TIMESTAMP '2024-01-02 10:00:00', 'b', 3D), (TIMESTAMP '2024-01-02 10:00:00', 'c', 4D)
        AS t(event_time, message_id, value)""")
    gone = spark.sql("""SELECT * FROM VALUES
        ('a', TIMESTAMP '2024-01-02 10:00:00'), ('c', TIMESTAMP '2024-01-02 10:00:00')
        AS t(dedup_key, event_time)""")
    found = backfill.counting_readings(rows, gone, F.col("message_id"))
    assert sorted((r.message_id, r.value) for r in found.collect()) == [("a", 2.0), ("b", 3.0)]


def test_held_rows_are_merged_into_few_partitions(spark):
    held = spark.range(1000).selectExpr("id % 10 AS a").distinct().persist()
    held.count()
    assert held.rdd.getNumPartitions() == 1
    held.unpersist()


def test_backfill_leaves_nothing_held(spark):
    root = work_dir(spark, "held")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    again = F.col("offset") % 2 == 1
    records = feed.air_records(spark, "/root/testdata/sf0.001")
    moved = feed.air_records(spark, "/root/testdata/sf0.001", moved=True)
    for merge_id, batch in (("0", records.filter(~again)), ("1", moved.filter(again))):
        backfill.write_air(parse.raw_envelope(batch), root, merge_id)
    gone = spark.read.parquet(f"{root}/{contracts.displaced_readings('air').location}")
    assert gone.count() > 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
