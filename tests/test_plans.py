"""Shape of the physical plans: shuffles, pruning, and nothing row-wise in Python."""

import re

import pytest

from checks import feed, queries
from envstream.operators import peaks, windows
from envstream.plans.flows import AirFlow

SF_DIR = "/root/testdata/sf0.001"


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(frame):
    return len(re.findall(r"Exchange (hash|range)partitioning", physical(frame)))


def test_all_window_lengths_share_one_shuffle(spark):
    rows = queries.clean_readings(spark, SF_DIR)
    many = windows.air_averages(rows, ["5 minutes", "10 minutes", "1 hour"])
    plan = physical(many)
    assert shuffles(many) == 1 and plan.count("FileScan") == 1
    assert "partial_avg" in plan


def test_flow_parses_each_text_once(spark):
    flow = AirFlow(feed.raw_air(spark, SF_DIR))
    for branch in (flow.silver, flow.rejects, flow.metrics):
        assert physical(branch).count("from_json") == 1
    assert shuffles(flow.silver) == 0 and shuffles(flow.rejects) == 0
    assert shuffles(flow.metrics) == 2


def test_metrics_shuffle_only_what_they_use(spark):
    plan = physical(AirFlow(feed.raw_air(spark, SF_DIR)).metrics)
    assert "station_city" not in plan.split("SortAggregate")[1]


def test_scan_reads_only_needed_columns(spark):
    plan = physical(queries.QUERIES["scan_parquet"](spark, SF_DIR))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_filters_reach_the_scan(spark):
    plan = physical(queries.clean_readings(spark, SF_DIR).select("value"))
    assert re.search(r"PushedFilters: \[.*IsNotNull\(value\)", plan)


def test_previous_window_reads_the_metrics_once(spark):
    found = peaks.detect_peaks(queries.metrics(spark, SF_DIR))
    found.collect()
    final = found._jdf.queryExecution().executedPlan()
    assert "ReusedExchange" in final.toString()
    assert "CartesianProduct" not in final.toString()


@pytest.mark.parametrize("name", sorted(
    n for n in queries.QUERIES
    if not n.startswith("stream_") and n not in (
        "gold_merge", "peaks_merge", "layers", "catalog_counts", "inferred_schema", "retention_drop")))
def test_no_python_and_no_cross_join(spark, name):
    plan = physical(queries.QUERIES[name](spark, SF_DIR))
    for forbidden in ("Python", "ArrowEval", "CartesianProduct", "Cross"):
        assert forbidden not in plan


def test_top_k_sorts_only_the_top(spark):
    for name in ("recent_alerts", "top_offenders", "preview_latest", "capacity_trim"):
        assert "TakeOrderedAndProject" in physical(queries.QUERIES[name](spark, SF_DIR))


def test_latest_row_is_found_before_the_shuffle(spark):
    plan = physical(queries.QUERIES["keep_latest"](spark, SF_DIR))
    assert "partial_max(struct" in plan and "Window" not in plan


@pytest.mark.parametrize("kind", ["air", "weather"])
def test_live_metrics_have_one_source_and_one_deduplication(spark, tmp_path, kind):
    from envstream.plans.flows import WeatherFlow
    from envstream.sources import streams

    (tmp_path / "in").mkdir()
    raw = streams.file_stream(spark, f"{tmp_path}/in")
    flow = AirFlow(raw) if kind == "air" else WeatherFlow(raw)

    def counts(frame):
        plan = frame._jdf.queryExecution().analyzed().toString()
        return [plan.count(word) for word in ("StreamingRelation", "DeduplicateWithinWatermark", "Aggregate ")]

    assert counts(flow.live_metrics) == [1, 1, 1]
    assert counts(flow.metrics) == [2, 2, 2]


PANELS = ("active_danger", "active_warning", "cities_impacted", "worst_offender", "recent_alerts",
          "active_pairs", "top_offenders", "last_danger", "status_trend")


@pytest.mark.parametrize("name", PANELS)
def test_panels_read_the_days_they_show(spark, name):
    plan = physical(queries.QUERIES[name](spark, SF_DIR))
    assert re.search(r"PartitionFilters: \[isnotnull\(window_date#\d+\), \(window_date", plan)
    assert "from_json" not in plan and "events.parquet" not in plan
