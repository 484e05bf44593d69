"""Domain rules as plain data. Every operator builds its column expressions from these values."""

from __future__ import annotations

# Inclusive plausible range of a reading, per pollutant.
POLLUTANT_RANGES = {
    "pm25": (0.0, 1000.0),
    "pm10": (0.0, 1000.0),
    "co": (0.0, 50.0),
    "no2": (0.0, 1000.0),
    "o3": (0.0, 1000.0),
}
POLLUTANTS = tuple(POLLUTANT_RANGES)

# Fixed values: (first WARNING average, last WARNING average); below is OK, above is DANGER.
STATUS_THRESHOLDS = {
    "pm25": (25.0, 50.0),
    "pm10": (50.0, 100.0),
    "co": (2.0, 9.0),
    "no2": (100.0, 200.0),
    "o3": (120.0, 180.0),
}
STATUSES = ("OK", "WARNING", "DANGER", "UNKNOWN")

# Smallest rise between consecutive windows that counts as a peak.
PEAK_DELTAS = {"pm25": 15.0, "pm10": 30.0, "co": 1.0, "no2": 50.0, "o3": 60.0}

# Inclusive weather plausibility bounds; None means unbounded.
WEATHER_RANGES = {
    "temperature_c": (-50.0, 60.0),
    "humidity_pct": (0.0, 100.0),
    "wind_speed_ms": (0.0, None),
}

# Unit spellings, compared after trimming and lower-casing.
CELSIUS_UNITS = ("c", "°c", "celsius")
FAHRENHEIT_UNITS = ("f", "°f", "fahrenheit")
METRE_PER_SECOND_UNITS = ("m/s", "ms")
PERCENT_UNITS = ("%", "percent", "pct")

# Wind units and how to reach metres per second, as (operation, operand).
WIND_CONVERSIONS = (
    (("km/h", "kmh", "kph"), "divide", 3.6),
    (("mph",), "multiply", 0.44704),
    (("kn", "kt", "knot", "knots"), "multiply", 0.514444),
)

# Units written into canonical weather messages.
CANONICAL_TEMPERATURE_UNIT = "C"
CANONICAL_WIND_UNIT = "m/s"
CANONICAL_HUMIDITY_UNIT = "%"

# Tumbling windows of the metric tables.
WINDOW_DURATIONS = ("5 minutes", "10 minutes")

# Time policies.
WATERMARK_DELAY = "6 hours"
TRIGGER_INTERVAL = "5 seconds"
LATE_EVENT_WINDOW = "6 hours"
REALTIME_WINDOW = "45 minutes"
CHANGE_STATE_TTL = "24 hours"
CHANGE_STATE_CAPACITY = 5000
RETENTION_DAYS = 90

# A series without any window for so long is compared with nothing when it comes back.
SERIES_LIFETIME = "60 days"

# JDBC sink settings.
JDBC_BATCH_SIZE = 1000
JDBC_ISOLATION_LEVEL = "READ_COMMITTED"
JDBC_WRITE_PARTITIONS = 8
JDBC_MAX_RETRIES = 3
JDBC_RETRY_DELAY_SECONDS = 5

# Dashboard and report limits.
RECENT_ALERTS_LIMIT = 100
TOP_PAIRS_LIMIT = 10
PREVIEW_LIMIT = 20
BI_ROW_LIMIT = 5000
NO_DANGER_LABEL = "No active DANGER"

# Target cities with country and coordinates.
CITIES = (
    ("Berlin", "DE", 52.52, 13.405),
    ("London", "GB", 51.5074, -0.1278),
    ("Paris", "FR", 48.8566, 2.3522),
)

# Message envelope written by the payload normalisers.
SCHEMA_VERSION = "1.0"
AIR_PIPELINE_NAME = "openaq_ingestion"
WEATHER_PIPELINE_NAME = "weather_ingestion"
AIR_SOURCE = "openaq"
FORECAST_SOURCE = "open-meteo"
OBSERVATION_SOURCE = "openweather"

# Topics.
AIR_TOPIC = "air_quality_raw"
WEATHER_TOPIC = "weather_raw"
