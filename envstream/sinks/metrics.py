"""Preparing metric rows for a serving table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream import contracts
from envstream.operators import dedup


def _prepare(rows: DataFrame, types: Mapping[str, str], key: Sequence[str]) -> DataFrame:
    """Typed columns, no missing values, one row per natural key."""
    typed = rows.select(*[F.col(name).cast(kind).alias(name) for name, kind in types.items()])
    complete = typed
    for name in types:
        complete = complete.filter(F.col(name).isNotNull())
    return dedup.latest_by(complete, key)


def prepare_air(rows: DataFrame) -> DataFrame:
    return _prepare(rows, contracts.AIR_METRIC_TYPES, contracts.AIR_METRIC_KEY)


def prepare_weather(rows: DataFrame) -> DataFrame:
    return _prepare(rows, contracts.WEATHER_METRIC_TYPES, contracts.WEATHER_METRIC_KEY)
