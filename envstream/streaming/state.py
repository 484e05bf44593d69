"""Keyed state in the engine: peaks of revised windows, and readings that bring something new.

State lives in the state store, one entry per series or per bucket of contents. A batch touches the entries of its
own keys only, and what changed is all that is written when it commits. The state of a key travels with
its rows in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegralType, TimestampType

from envstream import contracts, rules
from envstream.functions import levels, times
from envstream.operators import peaks

# With change logs a commit uploads what a batch changed, not the whole store.
STORE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# State that expires by the clock asks for batches without data for ever. A run over what is there would
# never end with them; without them expired state leaves with the next data.
DATA_ONLY = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}


@contextmanager
def keyed_store(spark: SparkSession, data_only: bool = False) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; others are left alone."""
    settings = {**STORE_SETTINGS, **(DATA_ONLY if data_only else {})}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


# Times are microseconds. The windows of a series lie side by side, in order.
_WINDOWS = "starts array<long>, ends array<long>, averages array<double>"
_CONTENT = ("_content_a", "_content_b")
#: Buckets of contents; a stream keeps the number it began with.
CONTENT_BUCKETS = 4096
_COMPARED = ["start", "end", "rolling_avg", "status", "prev_rolling_avg"]


def peak_state(lifetime: int):
    """Compares the revised windows of a series with those before them, and the ones after with them.

    The state holds the windows that may still be revised and the last one before these. Once the
    watermark has passed the newest window's end only that one is kept, and after ``lifetime`` without
    news nothing is.
    """
    def settle(held: dict[int, tuple], state: GroupState) -> None:
        passed = state.getCurrentWatermarkMs() * 1000
        newest = max(held)
        if newest + lifetime <= passed:
            state.remove()
            return
        for start in sorted(s for s, (end, _) in held.items() if end <= passed)[:-1]:
            del held[start]
        order = sorted(held)
        state.update((order, [held[s][0] for s in order], [held[s][1] for s in order]))
        # Next, its end closes the newest window, or else its time runs out.
        closes = held[newest][0]
        state.setTimeoutTimestamp((closes if closes > passed else newest + lifetime) // 1000 + 1)

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = {s: (e, a) for s, e, a in zip(*state.get)} if state.exists else {}
        if state.hasTimedOut:
            settle(held, state)
            return
        revised: dict[int, tuple] = {}
        for part in parts:
            for start, end, average, status, revision in part[
                    ["start", "end", "rolling_avg", "status", "revision"]].itertuples(index=False):
                if start not in revised or revision >= revised[start][3]:
                    revised[start] = (int(end), float(average), status, revision)
        statuses = {start: row[2] for start, row in revised.items()}
        held.update({int(start): row[:2] for start, row in revised.items()})
        order, found = sorted(held), []
        for before, start in zip([None, *order], order):
            if start in revised or before in revised:
                # The status follows from the average; of a window from the state it is left open.
                found.append((*key, start, *held[start], statuses.get(start),
                              None if before is None else held[before][1]))
        settle(held, state)
        made = pd.DataFrame(found, columns=[*contracts.SERIES_KEY, *_COMPARED])
        yield made.astype({"prev_rolling_avg": "float64"})

    return update


def peak_rows(revisions: DataFrame, delay: str = rules.WATERMARK_DELAY,
              durations: Sequence[str] = rules.WINDOW_DURATIONS,
              lifetime: str = rules.SERIES_LIFETIME) -> DataFrame:
    """Peaks results of a stream of revised windows, and of the windows after them.

    ``revisions`` has the metric columns and ``revision``; the larger one wins within a batch. A window
    may be revised until ``delay`` has passed its end, so nothing that can still come is late here. A
    series without news for ``lifetime`` of event time starts over. The stream's mode is update.
    """
    reach = times.duration_seconds(delay) + max(map(times.duration_seconds, durations))
    marked = revisions.withWatermark("window_start", f"{reach} seconds").select(
        *contracts.SERIES_KEY, "window_start", F.unix_micros("window_start").alias("start"),
        F.unix_micros("window_end").alias("end"), "rolling_avg", "status", "revision")
    names = ", ".join(f"{c} {contracts.AIR_METRIC_TYPES[c]}" for c in contracts.SERIES_KEY)
    found = marked.groupBy(*contracts.SERIES_KEY).applyInPandasWithState(
        peak_state(times.duration_seconds(lifetime) * 1_000_000),
        f"{names}, start long, end long, rolling_avg double, status string, prev_rolling_avg double",
        _WINDOWS, "update", GroupStateTimeout.EventTimeTimeout)
    status = F.coalesce("status", levels.status_level(F.col("parameter"), F.col("rolling_avg")))
    timed = found.withColumns({
        "window_start": F.timestamp_micros("start"), "window_end": F.timestamp_micros("end"),
        "status": status, "prev_rolling_avg": F.nanvl("prev_rolling_avg", F.lit(None).cast("double"))})
    return peaks.flag_peaks(timed).select(*contracts.PEAKS.fieldNames())


def first_of_contents(columns: Sequence[str], order: Sequence[str], ttl: int):
    """Passes the first reading of each content of a bucket, until it was passed ``ttl`` milliseconds ago.

    The state holds the contents passed, by the two hashes in ``_CONTENT``, and when each was.
    """
    def first(rows: pd.DataFrame, held: dict[tuple[int, int], int]) -> pd.DataFrame:
        new = rows[[pair not in held for pair in _pairs(rows)]]
        return new if len(new) < 2 else new.sort_values(list(order)).drop_duplicates(list(_CONTENT))

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        held = {(a, b): at for a, b, at in zip(*state.get) if now - at < ttl} if state.exists else {}
        if not state.hasTimedOut:
            found = [first(part, held) for part in parts]
            passed = found[0] if len(found) == 1 else first(pd.concat(found), held)
            held.update(dict.fromkeys(_pairs(passed), now))
            yield passed[list(columns)]
        if not held:
            state.remove()
            return
        state.update(([a for a, _ in held], [b for _, b in held], list(held.values())))
        state.setTimeoutDuration(max(min(held.values()) + ttl - now, 1))

    return update


def _pairs(rows: pd.DataFrame) -> list[tuple[int, int]]:
    return list(zip(*[rows[name].tolist() for name in _CONTENT]))


def _content_hash(columns: Sequence[str], salt: int) -> Column:
    # A hash passes over missing values, so it takes in which ones are missing.
    return F.xxhash64(F.lit(salt), *[part for c in columns for part in (F.col(c), F.col(c).isNull())])


def changed_readings(readings: DataFrame, key: Sequence[str], time_column: str,
                     tie_break: Sequence[str], compared: Sequence[str],
                     ttl: str = rules.CHANGE_STATE_TTL) -> DataFrame:
    """The first reading of each content in its series, as the batch form has it, for streams.

    A content is known for ``ttl`` of processing time after it was passed on, whatever its event time;
    it leaves the state then, and counts as new again. Contents are told apart by 128 bits of hashes and
    dealt by them into buckets: a call of Python takes a bucket, not a single content, and a series with
    a large share of the readings is dealt over all tasks. The stream's mode is append.
    """
    content = list(dict.fromkeys((*key, *compared)))
    stamps = [f.name for f in readings.schema.fields if isinstance(f.dataType, TimestampType)]
    numbered = readings.withColumns({c: F.unix_micros(c) for c in stamps}) if stamps else readings
    hashed = numbered.withColumns(
        {name: _content_hash(content, salt) for salt, name in enumerate(_CONTENT)})
    # Whole numbers beside missing ones would become fractions in Python and lose digits, so what is
    # missing travels as a mark of its own. False sorts first, as a missing value does in an aggregate.
    whole = [f.name for f in numbered.schema.fields if isinstance(f.dataType, IntegralType)]
    marked = hashed.withColumns({
        **{f"_there_{c}": F.col(c).isNotNull() for c in whole},
        **{c: F.coalesce(F.col(c), F.lit(0).cast(numbered.schema[c].dataType)) for c in whole}})
    order = [c for c in (time_column, *tie_break) if c not in compared] or list(key)[:1]
    order = [name for c in order for name in ([f"_there_{c}", c] if c in whole else [c])]
    columns = [c for c in marked.columns if c not in _CONTENT]
    bucket = F.pmod(F.col(_CONTENT[0]), F.lit(CONTENT_BUCKETS))
    found = marked.withColumn("_bucket", bucket).groupBy("_bucket").applyInPandasWithState(
        first_of_contents(columns, order, times.duration_seconds(ttl) * 1000),
        marked.select(*columns).schema, "a array<long>, b array<long>, at array<long>",
        "append", GroupStateTimeout.ProcessingTimeTimeout)
    filled = found.withColumns({c: F.when(F.col(f"_there_{c}"), F.col(c)) for c in whole})
    return filled.withColumns({c: F.timestamp_micros(c) for c in stamps}).select(*readings.columns)
