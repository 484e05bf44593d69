"""Keys and ids built from message fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def dedup_key(message_id: Column, *fallback: Column) -> Column:
    """The message id when there is one, else the identifying fields joined."""
    return F.when(F.length(message_id) > 0, message_id).otherwise(F.concat_ws("||", *fallback))


def air_dedup_key() -> Column:
    return dedup_key(
        F.col("message_id"), F.col("city"), F.col("parameter"),
        F.col("event_time").cast("string"))


def weather_dedup_key() -> Column:
    return dedup_key(
        F.col("message_id"), F.col("city"), F.col("event_time").cast("string"), F.col("source"),
        *[_text(F.col(c)) for c in ("temperature_c", "humidity_pct", "wind_speed_ms")])


def number_text(number: Column) -> Column:
    """A double as the producers write it: plain from 1e-4 up to 1e16, with an exponent beyond."""
    text = number.cast("string")
    # 21 digits after the point hold every double from 1e-4 on, and 17 before it those below 1e16.
    plain = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    sign = F.when(text.contains("E-"), "e-").otherwise("e+")
    power = F.regexp_extract(text, "E-?([0-9]+)$", 1)
    power = F.when(F.length(power) < 2, F.lpad(power, 2, "0")).otherwise(power)
    mantissa = F.regexp_replace(F.regexp_extract(text, "^([^E]+)E", 1), "[.]0$", "")
    size = F.abs(number)
    return (F.when(F.isnan(number), "nan")
            .when(size == float("inf"), F.when(number > 0, "inf").otherwise("-inf"))
            .when((size >= 1e-4) & (size < 1e16), plain)
            .when(size == 0, text)
            .otherwise(F.concat(mantissa, sign, power)))


def _id_text(part: Column) -> Column:
    fraction = F.typeof(part).isin("double", "float")
    return F.coalesce(F.when(fraction, number_text(part.try_cast("double"))).otherwise(
        part.cast("string")), F.lit(""))


def content_id(*parts: Column) -> Column:
    """SHA-1 of the parts joined by ``|``, a missing part counting as empty."""
    return F.sha1(F.concat_ws("|", *[_id_text(p) for p in parts]))


def _or_default(column: Column, default: str) -> Column:
    return F.coalesce(F.nullif(column, F.lit("")), F.lit(default))


def air_publish_key_of(country: Column, city: Column, parameter: Column) -> Column:
    return F.concat_ws(
        "|", _or_default(country, "NA"), _or_default(city, "NA"),
        _or_default(parameter, "unknown"))


def air_publish_key() -> Column:
    return air_publish_key_of(F.col("country"), F.col("city"), F.col("parameter"))


def weather_publish_key() -> Column:
    return F.concat_ws(
        "|", _or_default(F.col("city"), "NA"), _or_default(F.col("source"), "unknown"))
