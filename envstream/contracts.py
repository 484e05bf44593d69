"""Schemas of messages, payloads and tables, and the natural keys of the metric tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DoubleType, IntegerType, LongType, StringType,
    StructType, TimestampType,
)

CORRUPT_COLUMN = "_corrupt_record"

_TYPES = {
    "string": StringType(), "double": DoubleType(), "int": IntegerType(), "bigint": LongType(),
    "timestamp": TimestampType(), "date": DateType(), "boolean": BooleanType(),
}


def struct(columns: str, **nested: DataType) -> StructType:
    """Schema of ``name type`` pairs, usable before a session exists; ``nested`` come last."""
    schema = StructType()
    for column in columns.split(", ") if columns else ():
        name, kind = column.split(" ")
        schema = schema.add(name, _TYPES[kind])
    for name, kind in nested.items():
        schema = schema.add(name, kind)
    return schema


AIR_MESSAGE = struct(
    "source string, schema_version string, pipeline string, pipeline_version string, "
    "country string, city string, station_city string, target_city string, parameter string, "
    "value double, unit string, latitude double, longitude double, event_time string, "
    "ingestion_time string, location_id string, sensor_id string, provider string, "
    "parameter_id bigint, message_id string"
)

WEATHER_MESSAGE = struct(
    "source string, schema_version string, pipeline string, pipeline_version string, "
    "country string, city string, latitude double, longitude double, temperature double, "
    "temperature_unit string, wind_speed double, wind_unit string, humidity int, "
    "humidity_unit string, event_time string, ingestion_time string, message_id string"
)

# What a message source delivers, before the value is decoded.
SOURCE_RECORD = struct(
    "value string, timestamp timestamp, topic string, partition int, offset bigint"
)

RAW_ENVELOPE = struct(
    "raw_value string, kafka_timestamp timestamp, topic string, partition int, offset bigint, "
    "ingest_date date"
)

# Newest window per series.
PEAK_STATE = struct(
    "city string, parameter string, window_duration string, prev_rolling_avg double, "
    "prev_window_start timestamp"
)

# Provider payloads. Fields that are sometimes an object and sometimes a scalar stay JSON text.
SENSOR = struct("id string", parameter=struct("id bigint, name string, units string"))
STATION_PAYLOAD = struct(
    "id string, name string, locality string, city string, provider string, owner string, "
    "sourceName string, coordinates string, datetimeLast string",
    sensors=ArrayType(SENSOR))
LATEST_PAYLOAD = struct(
    "value string, sensorsId string, sensorId string, sensor_id string, sensor string, "
    "parameter string, parameter_id bigint, unit string, units string, coordinates string, "
    "datetime string, datetimeLast string, period string, date string, date_utc string, "
    "lastUpdated string"
)
FORECAST_PAYLOAD = struct(
    "",
    current=struct(
        "time string, temperature_2m double, wind_speed_10m double, relative_humidity_2m double"),
    current_units=struct(
        "temperature_2m string, wind_speed_10m string, relative_humidity_2m string"))
OBSERVATION_PAYLOAD = struct(
    "dt string", main=struct("temp double, humidity double"), wind=struct("speed double"))

AIR_METRIC_COLUMNS = (
    "window_start", "window_end", "city", "parameter", "rolling_avg", "status", "window_duration",
)
WEATHER_METRIC_COLUMNS = (
    "window_start", "window_end", "city", "avg_temperature", "avg_humidity", "avg_wind_speed",
    "window_duration",
)
AIR_METRIC_KEY = ("window_start", "window_end", "city", "parameter", "window_duration")
WEATHER_METRIC_KEY = ("window_start", "window_end", "city", "window_duration")
SERIES_KEY = ("city", "parameter", "window_duration")

AIR_METRIC_TYPES = {
    "window_start": "timestamp", "window_end": "timestamp", "city": "string",
    "parameter": "string", "rolling_avg": "double", "status": "string",
    "window_duration": "string",
}
WEATHER_METRIC_TYPES = {
    "window_start": "timestamp", "window_end": "timestamp", "city": "string",
    "avg_temperature": "double", "avg_humidity": "double", "avg_wind_speed": "double",
    "window_duration": "string",
}

PEAKS = struct(
    "window_start timestamp, window_end timestamp, city string, parameter string, "
    "rolling_avg double, status string, window_duration string, prev_rolling_avg double, "
    "delta double, is_peak boolean"
)


BATCH_COLUMN = "merge_id"


@dataclass(frozen=True)
class TableContract:
    """One lakehouse table: where it lives under the root, its columns and its partitioning."""

    name: str
    location: str
    schema: StructType
    partitions: tuple[str, ...] = ()
    may_be_empty: bool = False
    #: Whether batches are appended. The last folder level then names the batch, so that a batch
    #: that comes back replaces what it wrote the first time. It is no column of the contract.
    appended: bool = False

    @property
    def stored_partitions(self) -> tuple[str, ...]:
        return (*self.partitions, BATCH_COLUMN) if self.appended else self.partitions


def _message_table(message: StructType, extra: str) -> StructType:
    fields = [
        f"{f.name} {'timestamp' if f.name == 'event_time' else f.dataType.simpleString()}"
        for f in message.fields
    ]
    return struct(", ".join(fields) + extra)


BRONZE_AIR = TableContract(
    "bronze_air_quality", "bronze/air_quality", RAW_ENVELOPE, ("ingest_date",), appended=True)
BRONZE_WEATHER = TableContract(
    "bronze_weather", "bronze/weather", RAW_ENVELOPE, ("ingest_date",), appended=True)
SILVER_AIR = TableContract(
    "silver_air_quality", "silver/air_quality",
    _message_table(AIR_MESSAGE, ", event_date date"), ("event_date", "city"), appended=True)
SILVER_WEATHER = TableContract(
    "silver_weather", "silver/weather",
    _message_table(
        WEATHER_MESSAGE,
        ", temperature_c double, wind_speed_ms double, humidity_pct double, event_date date"),
    ("event_date", "city"), appended=True)
GOLD_AIR = TableContract(
    "gold_air_quality_metrics", "gold/air_quality_aggregates",
    struct(
        "window_start timestamp, window_end timestamp, city string, parameter string, "
        "rolling_avg double, status string, window_duration string, window_date date"),
    ("window_date",))
# Beside the metrics rather than inside them, so that each directory is one table, and
# partitioned by day so that a merge rewrites only the days it touches.
GOLD_PEAKS = TableContract(
    "gold_air_quality_peaks", "gold/air_quality_peaks",
    StructType(list(PEAKS.fields)).add("window_date", "date"), ("window_date",), True)
# Every change of a window, with the number of its batch, which the peaks of a stream are made from.
REVISIONS_AIR = TableContract(
    "air_quality_revisions", "revisions/air_quality",
    struct(
        "window_start timestamp, window_end timestamp, city string, parameter string, "
        "rolling_avg double, status string, window_duration string, revision bigint"),
    may_be_empty=True, appended=True)
# First and last window of every series and day, so that a batch needs no other day's windows.
WINDOW_ENDS_AIR = TableContract(
    "air_quality_window_ends", "index/air_quality_window_ends", GOLD_AIR.schema, ("window_date",))


def reading_index(kind: str, series: str) -> TableContract:
    """First time and series that every batch had for a message id, in buckets by the id."""
    return TableContract(
        f"{kind}_reading_index", f"index/{kind}_readings",
        struct(f"dedup_key string, event_time timestamp, {series}, bucket int"), ("bucket",),
        appended=True)


def displaced_readings(kind: str) -> TableContract:
    """Readings of silver that count no more, as their message was also sent with an earlier time."""
    return TableContract(
        f"{kind}_displaced", f"index/{kind}_displaced",
        struct("dedup_key string, event_time timestamp, event_date date"), ("event_date",),
        appended=True)


GOLD_WEATHER = TableContract(
    "gold_weather_metrics", "gold/weather_aggregates",
    struct(
        "window_start timestamp, window_end timestamp, city string, avg_temperature double, "
        "avg_humidity double, avg_wind_speed double, window_duration string, window_date date"),
    ("window_date",))
REJECTS_AIR = TableContract(
    "rejects_air_quality", "rejects/air_quality",
    struct(
        "raw_value string, corrupt_record string, event_time_raw string, value_raw double, "
        "city_raw string, reject_reason string, rejected_at timestamp, reject_date date"),
    ("reject_date", "reject_reason"), True, appended=True)
REJECTS_WEATHER = TableContract(
    "rejects_weather", "rejects/weather",
    struct(
        "raw_value string, corrupt_record string, event_time_raw string, city_raw string, "
        "reject_reason string, rejected_at timestamp, reject_date date"),
    ("reject_date", "reject_reason"), True, appended=True)

TABLES = (
    BRONZE_AIR, BRONZE_WEATHER, SILVER_AIR, SILVER_WEATHER, GOLD_AIR, GOLD_PEAKS, GOLD_WEATHER,
    REJECTS_AIR, REJECTS_WEATHER,
)

# Message contract, checked by operators.audit.contract_violations. JSON kinds per field.
_NULLABLE_TEXT = ("string", "null")
_NULLABLE_NUMBER = ("number", "null")
_REFERENCE = ("integer", "string", "null")

AIR_MESSAGE_KINDS = {
    "source": ("string",), "schema_version": ("string",), "pipeline": ("string",),
    "pipeline_version": ("string",), "country": _NULLABLE_TEXT, "city": _NULLABLE_TEXT,
    "station_city": _NULLABLE_TEXT, "target_city": _NULLABLE_TEXT, "parameter": _NULLABLE_TEXT,
    "value": _NULLABLE_NUMBER, "unit": _NULLABLE_TEXT, "latitude": _NULLABLE_NUMBER,
    "longitude": _NULLABLE_NUMBER, "event_time": _NULLABLE_TEXT, "ingestion_time": ("string",),
    "location_id": _REFERENCE, "sensor_id": _REFERENCE, "provider": _NULLABLE_TEXT,
    "parameter_id": ("integer", "null"), "message_id": ("string",),
}
WEATHER_MESSAGE_KINDS = {
    "source": ("string",), "schema_version": ("string",), "pipeline": ("string",),
    "pipeline_version": ("string",), "country": _NULLABLE_TEXT, "city": _NULLABLE_TEXT,
    "latitude": _NULLABLE_NUMBER, "longitude": _NULLABLE_NUMBER,
    "temperature": _NULLABLE_NUMBER, "temperature_unit": _NULLABLE_TEXT,
    "wind_speed": _NULLABLE_NUMBER, "wind_unit": _NULLABLE_TEXT,
    "humidity": ("integer", "null"), "humidity_unit": _NULLABLE_TEXT,
    "event_time": _NULLABLE_TEXT, "ingestion_time": ("string",), "message_id": ("string",),
}
NON_EMPTY_FIELDS = ("message_id",)
