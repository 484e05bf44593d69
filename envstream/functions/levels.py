"""Range checks, status levels and the peak flag, generated from the rule tables."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from envstream import rules


def is_supported_pollutant(parameter: Column) -> Column:
    return parameter.isin(*rules.POLLUTANTS)


def pollutant_in_range(parameter: Column, value: Column) -> Column:
    """Inclusive range per pollutant. Pollutants that share a range share one test."""
    by_range: dict[tuple[float, float], list[str]] = {}
    for name, bounds in rules.POLLUTANT_RANGES.items():
        by_range.setdefault(bounds, []).append(name)
    return reduce(or_, [
        parameter.isin(*names) & value.between(low, high)
        for (low, high), names in by_range.items()
    ])


def weather_in_range() -> Column:
    tests = []
    for name, (low, high) in rules.WEATHER_RANGES.items():
        column = F.col(name)
        tests.append(column >= low if high is None else column.between(low, high))
    return reduce(and_, tests)


def status_level(parameter: Column, average: Column) -> Column:
    level = F.when(average.isNull(), "UNKNOWN")
    for name, (warning_from, warning_to) in rules.STATUS_THRESHOLDS.items():
        same = parameter == name
        level = (
            level.when(same & (average < warning_from), "OK")
            .when(same & (average <= warning_to), "WARNING")
            .when(same, "DANGER")
        )
    return level.otherwise("UNKNOWN")


def is_peak(parameter: Column, delta: Column) -> Column:
    """False for the first window of a series, whose delta is null."""
    tests = [(parameter == name) & (delta >= rise) for name, rise in rules.PEAK_DELTAS.items()]
    return F.coalesce(reduce(or_, tests), F.lit(False))
