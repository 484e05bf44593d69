"""Event-time parsing and time arithmetic."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO patterns accepted besides the default form.
EVENT_TIME_PATTERNS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ssX",
)
# ISO forms without seconds, seen in provider payloads only.
MINUTE_PATTERNS = ("yyyy-MM-dd'T'HH:mmXXX", "yyyy-MM-dd'T'HH:mmX")

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def parse_event_time(text: Column) -> Column:
    """Timestamp of an ISO text, null when it is not one.

    The default form reads nearly every spelling, so it goes first and the pattern forms run
    only for what it leaves. A text without a leading date would be read as a time of today,
    hence the guard.
    """
    forms = [F.try_to_timestamp(text)]
    forms += [F.try_to_timestamp(text, F.lit(p)) for p in EVENT_TIME_PATTERNS]
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), F.coalesce(*forms))


def parse_provider_time(text: Column) -> Column:
    """As ``parse_event_time``, and also ISO texts that stop at the minute with an offset."""
    return F.coalesce(
        parse_event_time(text), *[F.try_to_timestamp(text, F.lit(p)) for p in MINUTE_PATTERNS]
    )


def iso_text(moment: Column) -> Column:
    """ISO text with offset, with six decimals when the moment has a fraction."""
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ssxxx")
    fraction = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.date_trunc("second", moment) == moment, whole).otherwise(fraction)


def duration_seconds(duration: str) -> int:
    """Seconds of a fixed-length duration such as ``"10 minutes"`` or ``"1 day"``."""
    amount, unit = duration.strip().lower().split()
    return int(amount) * _UNIT_SECONDS[unit.removesuffix("s")]


def literal(moment: datetime) -> Column:
    """Timestamp column of a moment; one without a zone counts as UTC."""
    return F.lit(moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc))


def delta(duration: str) -> timedelta:
    return timedelta(seconds=duration_seconds(duration))


def bucket_start(moment: Column, seconds: Column | int) -> Column:
    """Start of the epoch-aligned bucket holding ``moment``, exact to the microsecond."""
    micros = F.unix_micros(moment)
    width = (F.lit(seconds) if isinstance(seconds, int) else seconds).cast("bigint") * 1_000_000
    return F.timestamp_micros(micros - F.pmod(micros, width))
