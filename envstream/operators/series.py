"""Previous-row operators over time series, split in time so that no series is one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envstream.functions import times

# Series are cut at this length of time; a piece holds at most one window per step of it.
DEFAULT_SLICE = "7 days"


def with_previous(rows: DataFrame, key: Sequence[str], time_column: str,
                  tie_break: Sequence[str], values: Sequence[str],
                  slice_length: str = DEFAULT_SLICE) -> DataFrame:
    """Adds ``previous``, a struct of ``values`` of the row before in the same series, or null.

    Rows are ordered by time and then ``tie_break``. Every series is cut into time slices which
    shuffle and sort on their own. Within a slice the row before is at hand; the first row of a
    slice finds it among the first and last rows of the series' slices, which are few. Both parts
    read the same shuffle. Batch only.
    """
    order = [time_column, *tie_break]
    carried = F.struct(*[F.col(v) for v in values])
    within = Window.partitionBy(*key, "_slice").orderBy(*order)
    across = Window.partitionBy(*key).orderBy(*order)
    sliced = rows.withColumn(
        "_slice", times.bucket_start(F.col(time_column), times.duration_seconds(slice_length)))
    lagged = sliced.withColumns({
        "_position": F.row_number().over(within),
        "_is_last": F.lead(F.lit(True), 1, False).over(within) == F.lit(False),
        "previous": F.lag(carried).over(within)})
    first = F.col("_position") == 1
    inner = lagged.filter(~first)
    ends = lagged.filter(first | F.col("_is_last"))
    heads = ends.withColumn("previous", F.lag(carried).over(across)).filter(first)
    columns = [*rows.columns, "previous"]
    return inner.select(*columns).unionByName(heads.select(*columns))


def mark_repeats(readings: DataFrame, key: Sequence[str], time_column: str,
                 tie_break: Sequence[str], compared: Sequence[str]) -> DataFrame:
    """Adds ``repeated``: whether an earlier reading of the batch has the same content.

    ``compared`` holds the event time and the measurements, which ids are hashes of. A reading that
    equals the one before it in its series and one whose id was seen before are the same thing then,
    so readings meet by key and content, and no series lies in one task.
    """
    same = Window.partitionBy(*key, *compared).orderBy(time_column, *tie_break)
    return readings.withColumn("repeated", F.row_number().over(same) > 1)


def change_only(readings: DataFrame, key: Sequence[str], time_column: str,
                tie_break: Sequence[str], compared: Sequence[str]) -> DataFrame:
    """The first reading of each content in its series.

    It is an aggregate, so each map task sends a content once, however often it was delivered.
    """
    order = [c for c in (time_column, *tie_break) if c not in compared]
    others = [c for c in readings.columns if c not in (*key, *compared)]
    content = list(dict.fromkeys((*key, *compared)))
    first = F.min(F.struct(*order, *[c for c in others if c not in order])).alias("_first")
    return readings.groupBy(*content).agg(first).select(*content, "_first.*").select(*readings.columns)
