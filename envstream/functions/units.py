"""Unit normalisation. Unknown and missing units pass the number through."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from envstream import rules


def _spelling(unit: Column) -> Column:
    return F.lower(F.trim(unit))


def temperature_celsius(value: Column, unit: Column) -> Column:
    fahrenheit = _spelling(unit).isin(*rules.FAHRENHEIT_UNITS)
    return F.when(fahrenheit, (value - 32) * 5 / 9).otherwise(value)


def wind_metres_per_second(value: Column, unit: Column) -> Column:
    converted = None
    for spellings, operation, operand in rules.WIND_CONVERSIONS:
        result = value / operand if operation == "divide" else value * operand
        matches = _spelling(unit).isin(*spellings)
        converted = F.when(matches, result) if converted is None else converted.when(
            matches, result)
    return converted.otherwise(value)


def humidity_percent(value: Column) -> Column:
    return value.cast("double")


def has_known_units(temperature_unit: Column, wind_unit: Column, humidity_unit: Column) -> Column:
    """True when every unit is missing or one of the known spellings."""
    wind = rules.METRE_PER_SECOND_UNITS + tuple(
        spelling for spellings, _, _ in rules.WIND_CONVERSIONS for spelling in spellings)
    known = (
        (temperature_unit, rules.CELSIUS_UNITS + rules.FAHRENHEIT_UNITS),
        (wind_unit, wind),
        (humidity_unit, rules.PERCENT_UNITS),
    )
    ok = F.lit(True)
    for unit, spellings in known:
        ok = ok & (unit.isNull() | _spelling(unit).isin(*spellings))
    return ok
