"""Every branch of the air-quality and weather flows, from the raw envelope on."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame

from envstream import rules
from envstream.operators import dedup, parse, providers, quality, windows


def air_ingestion(station_responses: DataFrame, latest_responses: DataFrame,
                  ingestion_time: datetime) -> DataFrame:
    """Canonical messages of the best station of every target city, from raw responses.

    The best station is the one that reported last among those whose readings arrived.
    """
    items = providers.latest_items(latest_responses)
    candidates = providers.city_stations(providers.stations(station_responses))
    best = providers.best_stations(providers.with_readings(candidates, items))
    return providers.air_messages(items, best, ingestion_time)


class AirFlow:
    """Branches of the air-quality flow; on a stream each is a query of its own.

    Silver keeps duplicates unless asked otherwise; metrics never count one twice.
    """

    def __init__(self, raw: DataFrame, durations: Sequence[str] = rules.WINDOW_DURATIONS,
                 delay: str = rules.WATERMARK_DELAY, silver_dedup: bool = False,
                 strict: bool = False):
        self.bronze = raw
        self.durations, self.delay = durations, delay
        self.silver_dedup, self.strict = silver_dedup, strict

    @cached_property
    def parsed(self) -> DataFrame:
        return parse.parse_air(self.bronze)

    def hold_parsed(self) -> DataFrame:
        """Persists the parsed rows for the branches that are made from now on. Batch only."""
        self.parsed = quality.text_of_rejects(
            self.parsed, quality.air_reject_reason(self.strict)).persist()
        return self.parsed

    @cached_property
    def usable(self) -> DataFrame:
        return quality.usable_air(self.parsed)

    @cached_property
    def rejects(self) -> DataFrame:
        return quality.air_rejects(self.parsed, strict=self.strict)

    @cached_property
    def silver(self) -> DataFrame:
        rows = dedup.dedup_air(self.usable, self.delay) if self.silver_dedup else self.usable
        return quality.with_event_date(quality.plausible_air(rows))

    @cached_property
    def metrics(self) -> DataFrame:
        return self._averages(together=False)

    @cached_property
    def live_metrics(self) -> DataFrame:
        """The metrics of a stream in update mode, all lengths from one aggregation."""
        return self._averages(together=True)

    def _averages(self, together: bool) -> DataFrame:
        # The metrics need few columns, so only these go through the shuffles.
        measured = self.usable.select("event_time", "city", "parameter", "value", "message_id")
        clean = quality.plausible_air(dedup.dedup_air(measured, self.delay))
        return windows.with_status(windows.air_averages(clean, self.durations, together))


class WeatherFlow:
    """Branches of the weather flow. Silver is free of duplicates unless asked otherwise."""

    def __init__(self, raw: DataFrame, durations: Sequence[str] = rules.WINDOW_DURATIONS,
                 delay: str = rules.WATERMARK_DELAY, silver_dedup: bool = True,
                 strict: bool = False, strict_units: bool = False):
        self.bronze = raw
        self.durations, self.delay, self.silver_dedup = durations, delay, silver_dedup
        self.strict, self.strict_units = strict, strict_units

    @cached_property
    def parsed(self) -> DataFrame:
        return parse.parse_weather(self.bronze)

    def hold_parsed(self) -> DataFrame:
        """Persists the parsed rows for the branches that are made from now on. Batch only."""
        self.parsed = quality.text_of_rejects(
            self.parsed, quality.weather_reject_reason(self.strict, self.strict_units)).persist()
        return self.parsed

    @cached_property
    def usable(self) -> DataFrame:
        return quality.usable_weather(self.parsed, self.strict_units)

    @cached_property
    def rejects(self) -> DataFrame:
        return quality.weather_rejects(
            self.parsed, strict=self.strict, strict_units=self.strict_units)

    @cached_property
    def silver(self) -> DataFrame:
        rows = dedup.dedup_weather(self.usable, self.delay) if self.silver_dedup else self.usable
        return quality.with_event_date(quality.plausible_weather(rows))

    @cached_property
    def metrics(self) -> DataFrame:
        return self._averages(together=False)

    @cached_property
    def live_metrics(self) -> DataFrame:
        """The metrics of a stream in update mode, all lengths from one aggregation."""
        return self._averages(together=True)

    def _averages(self, together: bool) -> DataFrame:
        measured = self.usable.select(
            "event_time", "city", "source", "message_id", "temperature_c", "humidity_pct",
            "wind_speed_ms")
        clean = quality.plausible_weather(dedup.dedup_weather(measured, self.delay))
        return windows.weather_averages(clean, self.durations, together)
