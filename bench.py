"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the warm runs per query
(the median counts), and ``BENCH_QUERIES`` a comma-separated choice of queries.

The events are first written as several files per core, untimed: the given file has one row group, which
Spark reads in one task, so that all JSON would be made and parsed by one core.
"""

from __future__ import annotations

import json
import os
import statistics
import time

HEADLINE = (
    "raw_envelope", "parsed_air", "parsed_weather", "rejects_air", "rejects_weather",
    "silver_air", "silver_weather", "dedup_air", "dedup_weather", "air_metrics",
    "weather_metrics", "win_multi", "win_weather", "peak_detection", "keep_latest",
    "recent_alerts", "top_offenders", "last_danger", "status_trend", "bi_average", "constraints",
    "contract_check", "change_only", "payload_air", "payload_forecast",
)
# Write-and-read-back runs, timed once: they start from an empty folder every time.
SINGLE = ("gold_merge", "stream_silver", "stream_win_air", "stream_update")


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def many_files(spark, sf_dir: str) -> str:
    """A folder with all events of ``sf_dir``, four files for each core."""
    from envstream.session import work_dir

    root = work_dir(spark, "bench")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(4 * spark.sparkContext.defaultParallelism).write.parquet(f"{root}/events.parquet")
    return root


def main() -> None:
    from checks.queries import QUERIES
    from checks.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else [*HEADLINE, *SINGLE]
    spark = local_session()
    data = many_files(spark, sf_dir)
    seconds = {}
    for name in names:
        query = QUERIES[name]
        if name not in SINGLE:
            timed(query, spark, data)
        times = [timed(query, spark, data) for _ in range(1 if name in SINGLE else runs)]
        seconds[name] = round(statistics.median(times), 3)
    cores = spark.sparkContext.defaultParallelism
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
        "events_files": 4 * cores}))


if __name__ == "__main__":
    main()
