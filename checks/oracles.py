"""The SQL each registered query is compared with, over the same driver tables.

Common table expressions derive the readings, records and metrics from ``events``; they are the
SQL side of ``checks.feed`` and do not go through JSON where the fields are known anyway. Numbers
are rounded as in ``checks.queries.comparable``.
"""

from __future__ import annotations

from checks import feed

NOW = "TIMESTAMP '2024-01-15 12:00:00'"
MIDDLE = "TIMESTAMP '2024-01-16 00:00:00'"


def _pick(index: str, values) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} % {len(values)} {cases} END"


def _mapped(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(
        f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def _ranges(parameter: str = "parameter", value: str = "value") -> str:
    return (f"(({parameter} = 'co' AND {value} BETWEEN 0 AND 50) OR "
            f"({parameter} IN ('pm25','pm10','no2','o3') AND {value} BETWEEN 0 AND 1000))")


def _rounded(*columns: str) -> str:
    return ", ".join(f"round({c} + 1.23456e-9, 8) AS {c}" for c in columns)


STATUS = """CASE
  WHEN parameter = 'pm25' THEN CASE WHEN rolling_avg < 25 THEN 'OK' WHEN rolling_avg <= 50
    THEN 'WARNING' ELSE 'DANGER' END
  WHEN parameter = 'pm10' THEN CASE WHEN rolling_avg < 50 THEN 'OK' WHEN rolling_avg <= 100
    THEN 'WARNING' ELSE 'DANGER' END
  WHEN parameter = 'co' THEN CASE WHEN rolling_avg < 2 THEN 'OK' WHEN rolling_avg <= 9
    THEN 'WARNING' ELSE 'DANGER' END
  WHEN parameter = 'no2' THEN CASE WHEN rolling_avg < 100 THEN 'OK' WHEN rolling_avg <= 200
    THEN 'WARNING' ELSE 'DANGER' END
  WHEN parameter = 'o3' THEN CASE WHEN rolling_avg < 120 THEN 'OK' WHEN rolling_avg <= 180
    THEN 'WARNING' ELSE 'DANGER' END
  ELSE 'UNKNOWN' END"""

OBS = f"""
obs_base AS (
  SELECT event_id, user_id, ts AS event_time, value,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
    {_pick('user_id', feed.COUNTRIES)} AS city,
    CASE WHEN event_id % 50 = 7 THEN 'so2' ELSE {_mapped('event_type', feed.PARAMETERS)} END
      AS parameter,
    CASE WHEN event_id % 11 = 0 THEN '' ELSE CAST(event_id AS VARCHAR) END AS message_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS time_text,
    event_id % 40 = 3 AS cut, event_id % 40 = 5 AS no_time, event_id % 40 = 7 AS no_value,
    event_id % 40 = 9 AS no_city
  FROM events),
obs AS (
  SELECT *, {_mapped('city', feed.COUNTRIES)} AS country,
    CASE WHEN NOT no_value THEN round(value - 60, 2) END AS temperature,
    CASE WHEN event_id % 13 <> 0 THEN {_pick('event_id', feed.TEMPERATURE_UNITS)} END
      AS temperature_unit,
    round(value / 10, 3) AS wind_speed,
    CASE WHEN event_id % 17 <> 0 THEN {_pick('event_id', feed.WIND_UNITS)} END AS wind_unit
  FROM obs_base),
units AS (
  SELECT *,
    CASE WHEN lower(trim(temperature_unit)) IN ('f', '°f', 'fahrenheit')
      THEN (temperature - 32) * 5 / 9 ELSE temperature END AS temperature_c,
    CASE WHEN lower(trim(wind_unit)) IN ('km/h', 'kmh', 'kph') THEN wind_speed / 3.6
      WHEN lower(trim(wind_unit)) = 'mph' THEN wind_speed * 0.44704
      WHEN lower(trim(wind_unit)) IN ('kn', 'kt', 'knot', 'knots') THEN wind_speed * 0.514444
      ELSE wind_speed END AS wind_speed_ms,
    CAST(k AS DOUBLE) AS humidity_pct
  FROM obs),
rec AS (
  SELECT *, UNNEST(CASE WHEN event_id % 10 = 0 THEN [0, 1] ELSE [0] END) AS delivery
  FROM units)"""

AIR_TEXT = """('{"source":"feed","schema_version":"1.0","country":"' || country || '"'
  || CASE WHEN no_city THEN '' ELSE ',"city":"' || city || '"' END
  || ',"event_time":"' || CASE WHEN no_time THEN '' ELSE time_text END
  || '","message_id":"' || message_id || '","parameter":"' || parameter || '"'
  || CASE WHEN no_value THEN '' ELSE ',"value":' || CAST(value AS VARCHAR) END
  || ',"location_id":' || CAST(user_id AS VARCHAR) || '}')"""
WEATHER_TEXT = """('{"source":"feed","schema_version":"1.0","country":"' || country || '"'
  || CASE WHEN no_city THEN '' ELSE ',"city":"' || city || '"' END
  || ',"event_time":"' || CASE WHEN no_time THEN '' ELSE time_text END
  || '","message_id":"' || message_id || '"'
  || CASE WHEN temperature IS NULL THEN '' ELSE ',"temperature":' || CAST(temperature AS VARCHAR)
     END
  || CASE WHEN temperature_unit IS NULL THEN '' ELSE ',"temperature_unit":"' || temperature_unit
     || '"' END
  || ',"wind_speed":' || CAST(wind_speed AS VARCHAR)
  || CASE WHEN wind_unit IS NULL THEN '' ELSE ',"wind_unit":"' || wind_unit || '"' END
  || ',"humidity":' || CAST(k AS VARCHAR) || ',"humidity_unit":"%"}')"""


def _sent(text: str) -> str:
    return f"CASE WHEN cut THEN left({text}, length({text}) - 4) ELSE {text} END"


PARSED = """
parsed AS (
  SELECT event_id, delivery, cut, {raw} AS raw_value,
    CASE WHEN cut THEN {raw} END AS corrupt_record,
    CASE WHEN cut THEN NULL WHEN no_time THEN '' ELSE time_text END AS event_time_raw,
    CASE WHEN NOT cut AND NOT no_time THEN event_time END AS event_time,
    CASE WHEN NOT cut THEN country END AS country,
    CASE WHEN NOT cut AND NOT no_city THEN city END AS city,
    CASE WHEN NOT cut THEN parameter END AS parameter,
    CASE WHEN NOT cut AND NOT no_value THEN value END AS value,
    CASE WHEN NOT cut THEN CAST(user_id AS VARCHAR) END AS location_id,
    CASE WHEN NOT cut THEN message_id END AS message_id,
    CASE WHEN NOT cut THEN temperature END AS temperature,
    CASE WHEN NOT cut THEN temperature_unit END AS temperature_unit,
    CASE WHEN NOT cut THEN wind_speed END AS wind_speed,
    CASE WHEN NOT cut THEN wind_unit END AS wind_unit,
    CASE WHEN NOT cut THEN k END AS humidity,
    CASE WHEN NOT cut THEN '%' END AS humidity_unit,
    CASE WHEN NOT cut THEN temperature_c END AS temperature_c,
    CASE WHEN NOT cut THEN wind_speed_ms END AS wind_speed_ms,
    CASE WHEN NOT cut THEN humidity_pct END AS humidity_pct
  FROM rec)"""
PARSED_AIR = PARSED.format(raw=_sent(AIR_TEXT))
PARSED_WEATHER = PARSED.format(raw=_sent(WEATHER_TEXT))

WEATHER_RANGE = ("(temperature_c BETWEEN -50 AND 60 AND humidity_pct BETWEEN 0 AND 100 "
                 "AND wind_speed_ms >= 0)")
AIR_REASON = f"""CASE WHEN corrupt_record IS NOT NULL THEN 'corrupt_json'
    WHEN event_time IS NULL THEN 'missing_event_time' WHEN value IS NULL THEN 'missing_value'
    WHEN city IS NULL THEN 'missing_city'
    WHEN parameter IN ('pm25','pm10','co','no2','o3') AND NOT {_ranges()}
    THEN 'invalid_range' END"""
WEATHER_REASON = f"""CASE WHEN corrupt_record IS NOT NULL THEN 'corrupt_json'
    WHEN event_time IS NULL THEN 'missing_event_time' WHEN city IS NULL THEN 'missing_city'
    WHEN NOT {WEATHER_RANGE} THEN 'invalid_range' END"""
KNOWN_UNITS = """(coalesce(lower(trim(temperature_unit)) IN
    ('c', '°c', 'celsius', 'f', '°f', 'fahrenheit'), true)
  AND coalesce(lower(trim(wind_unit)) IN ('m/s', 'ms', 'km/h', 'kmh', 'kph', 'mph', 'kn', 'kt',
    'knot', 'knots'), true))"""

USABLE_AIR = "usable AS (SELECT * FROM parsed WHERE NOT cut AND event_time IS NOT NULL " \
    "AND value IS NOT NULL AND city IS NOT NULL)"
USABLE_WEATHER = "usable AS (SELECT * FROM parsed WHERE NOT cut AND event_time IS NOT NULL " \
    "AND city IS NOT NULL)"
# Both deliveries of an event are equal, and no two events share time, city and pollutant.
DEDUP = """deduped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY message_id,
    CASE WHEN message_id = '' THEN event_id END ORDER BY delivery) AS rn FROM usable)
    WHERE rn = 1)"""


def _chain(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


AIR = (OBS, PARSED_AIR)
WEATHER = (OBS, PARSED_WEATHER)
AIR_FLOW = (*AIR, USABLE_AIR, DEDUP, f"clean AS (SELECT * FROM deduped WHERE {_ranges()})")
WEATHER_FLOW = (
    *WEATHER, USABLE_WEATHER, DEDUP, f"clean AS (SELECT * FROM deduped WHERE {WEATHER_RANGE})")
# The second delivery has an earlier time, so it counts where the message has an id.
MOVED_FLOW = (
    OBS, """moved AS (SELECT * REPLACE (CASE WHEN delivery = 1 THEN event_time - INTERVAL 2 DAY
      - (event_id % 70) * INTERVAL 1 MINUTE ELSE event_time END AS event_time) FROM rec)""",
    PARSED_AIR.replace("FROM rec)", "FROM moved)"), USABLE_AIR,
    f"""clean AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY message_id,
      CASE WHEN message_id = '' THEN city || parameter || event_time END
      ORDER BY event_time) AS rn FROM usable WHERE {_ranges()}) WHERE rn = 1)""")
CLEAN_OBS = (OBS, f"clean AS (SELECT * FROM obs WHERE {_ranges()})")

DEFAULT = (("5 minutes", "5 MINUTE"), ("10 minutes", "10 MINUTE"))
COARSE = (("6 hours", "6 HOUR"), ("1 day", "1 DAY"))


def _averages(name: str, durations, keys: str, measures: str, source: str = "clean") -> str:
    parts = [
        f"SELECT time_bucket(INTERVAL {width}, event_time) AS window_start, "
        f"time_bucket(INTERVAL {width}, event_time) + INTERVAL {width} AS window_end, {keys}, "
        f"{measures}, '{label}' AS window_duration FROM {source} GROUP BY ALL"
        for label, width in durations]
    return f"{name} AS (" + "\nUNION ALL ".join(parts) + ")"


def _air_windows(durations=DEFAULT, source: str = "clean") -> tuple[str, str]:
    return (
        _averages("win", durations, "city, parameter", "avg(value) AS rolling_avg", source),
        f"met AS (SELECT window_start, window_end, city, parameter, rolling_avg, {STATUS} AS "
        "status, window_duration FROM win)")


def _weather_windows(durations=DEFAULT) -> str:
    return _averages(
        "met", durations, "city", "avg(temperature_c) AS avg_temperature, "
        "avg(humidity_pct) AS avg_humidity, avg(wind_speed_ms) AS avg_wind_speed")


METRICS = (*CLEAN_OBS, *_air_windows())
SHOW_WINDOW = ("window_start, window_end, city, parameter, "
               "round(rolling_avg + 1.23456e-9, 8) AS rolling_avg, window_duration")
SHOW_AIR = SHOW_WINDOW + ", status"
SHOW_WEATHER = ("window_start, window_end, city, " + _rounded(
    "avg_temperature", "avg_humidity", "avg_wind_speed") + ", window_duration")
TWO_PLACES = "CAST(round(CAST(rolling_avg AS DECIMAL(18, 6)), 2) AS DOUBLE)"
PEAK_TEST = """coalesce((parameter = 'pm25' AND delta >= 15) OR (parameter = 'pm10' AND delta >= 30)
  OR (parameter = 'co' AND delta >= 1) OR (parameter = 'no2' AND delta >= 50)
  OR (parameter = 'o3' AND delta >= 60), false)"""
LAGGED = """lagged AS (SELECT *, lag(rolling_avg) OVER (PARTITION BY city, parameter,
  window_duration ORDER BY window_start) AS prev_rolling_avg FROM met)"""
PEAKS = (LAGGED, "peaks AS (SELECT *, rolling_avg - prev_rolling_avg AS delta FROM lagged)")
SHOW_PEAKS = (SHOW_AIR + ", round(prev_rolling_avg + 1.23456e-9, 8) AS prev_rolling_avg, "
              f"round(delta + 1.23456e-9, 8) AS delta, {PEAK_TEST} AS is_peak")
REVISIONS = """revisions AS (
  SELECT * REPLACE (rolling_avg + revision AS rolling_avg),
    window_end + revision * INTERVAL 1 MINUTE AS ingested_at
  FROM (SELECT *, UNNEST(range(CAST(floor(minute(window_start) / 5) AS BIGINT) % 3 + 1))
    AS revision FROM met))"""
LATEST = """SELECT city, parameter, window_duration,
  round(rolling_avg + 1.23456e-9, 8) AS prev_rolling_avg, window_start AS prev_window_start FROM (SELECT *, row_number() OVER (PARTITION BY city,
  parameter, window_duration ORDER BY window_start DESC) AS rn FROM met) WHERE rn = 1"""


def _panel(span: str | None = None, extra: str = "", time_from: str = "TIMESTAMP '2024-01-01'",
           time_to: str = NOW) -> str:
    within = f" AND window_start >= {time_to} - INTERVAL {span}" if span else ""
    return f"window_start BETWEEN {time_from} AND {time_to}{within}{extra}"


ACTIVE = _panel("10 MINUTE", " AND status = 'DANGER'")
DAY = _panel("24 HOUR", " AND status = 'DANGER'")


def _worst(condition: str, time: str) -> str:
    """An aggregate over the pairs always has a row, whose nulls say that there is no pair."""
    return _chain(*METRICS, f"""pairs AS (SELECT city, parameter, count(*) AS windows FROM met
      WHERE {condition} GROUP BY city, parameter)""") + f"""
      SELECT {time} AS time, coalesce(first(city || ' / ' || parameter
          ORDER BY windows DESC, city || ' / ' || parameter), 'No active DANGER') AS metric,
        coalesce(max(windows), 0)::DOUBLE AS value FROM pairs"""


def _iso(column: str = "event_time") -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%fZ')"


TWICE = """twice AS (SELECT country, city, parameter, event_time, value, event_id, delivery
  FROM rec)"""
REPEATED = """marked AS (SELECT *, coalesce(lag(event_time) OVER w = event_time
  AND lag(value) OVER w = value, false) AS repeated FROM twice
  WINDOW w AS (PARTITION BY country, city, parameter ORDER BY event_time, event_id, delivery))"""

# Only the forms with a time; the sixth form carries none.
ITEM_TIME = "CASE WHEN event_id % 6 <> 5 THEN time_text END"
PLACES = f"{_pick('user_id', feed.PLACE_NAMES)}"
STATIONS = f"""stations AS (SELECT user_id, country, {PLACES} AS place,
    CASE WHEN user_id % 3 = 0 THEN {PLACES} ELSE '' END AS locality,
    max(event_time) AS last_time FROM obs GROUP BY ALL)"""
# What the ten place names match.
STATION_CITY = """CASE WHEN user_id % 10 IN (0, 6) THEN 'Paris' WHEN user_id % 10 IN (3, 7)
  THEN 'London' WHEN user_id % 10 IN (4, 8) THEN 'Berlin' END"""
CITY_STATIONS = f"""city_stations AS (SELECT *, {STATION_CITY} AS target_city FROM stations
  WHERE user_id % 7 <> 0 AND {STATION_CITY} IS NOT NULL)"""
SENSORS = """sensor_rows AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS location_id,
    CAST(user_id * 10 + length(parameter) AS VARCHAR) AS sensor_id,
    upper(parameter) AS sensor_parameter, 'µg/m³' AS sensor_unit,
    CAST(length(parameter) AS BIGINT) AS sensor_parameter_id FROM obs WHERE user_id % 7 <> 0),
  sensors AS (SELECT location_id, sensor_id, min(sensor_parameter) AS sensor_parameter,
    sensor_unit, sensor_parameter_id FROM sensor_rows GROUP BY ALL)"""

MISSING_FIELDS = ("ingestion_time", "latitude", "longitude", "parameter_id", "pipeline",
                  "pipeline_version", "provider", "sensor_id", "station_city", "target_city",
                  "unit")

CLOSED = """closed AS (SELECT met.* FROM met, (SELECT max(event_time) - INTERVAL 6 HOUR AS wm
  FROM usable) WHERE window_end <= wm)"""


def _counts(rows: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows FROM {source}"
        for name, source in rows.items())


def _layer_sources() -> tuple[str, dict[str, str]]:
    """CTEs of every layer under distinct names, and the relation of each table."""
    def renamed(parts: tuple[str, ...], prefix: str) -> list[str]:
        names = ("parsed", "usable", "deduped", "clean", "win", "met", "lagged", "peaks")
        out = []
        for part in parts:
            for name in names:
                for before, after in (
                        (f"{name} AS (", f"{prefix}_{name} AS ("),
                        (f"FROM {name})", f"FROM {prefix}_{name})"),
                        (f"FROM {name} ", f"FROM {prefix}_{name} ")):
                    part = part.replace(before, after)
            out.append(part)
        return out

    air = renamed((PARSED_AIR, USABLE_AIR, DEDUP, AIR_FLOW[-1], *_air_windows(), *PEAKS), "a")
    weather = renamed((PARSED_WEATHER, USABLE_WEATHER, DEDUP, WEATHER_FLOW[-1],
                       _weather_windows()), "w")
    sources = {
        "bronze_air_quality": "rec",
        "bronze_weather": "rec",
        "silver_air_quality": f"a_usable WHERE {_ranges()}",
        "silver_weather": "w_clean",
        "gold_air_quality_metrics": "a_met",
        "gold_air_quality_peaks": f"a_peaks WHERE {PEAK_TEST}",
        "gold_weather_metrics": "w_met",
        "rejects_air_quality": f"a_parsed WHERE {AIR_REASON} IS NOT NULL",
        "rejects_weather": f"w_parsed WHERE {WEATHER_REASON} IS NOT NULL",
    }
    return _chain(OBS, *air, *weather), sources


LAYER_CTES, LAYER_SOURCES = _layer_sources()
LOCATIONS = {
    "bronze_air_quality": "bronze/air_quality", "bronze_weather": "bronze/weather",
    "silver_air_quality": "silver/air_quality", "silver_weather": "silver/weather",
    "gold_air_quality_metrics": "gold/air_quality_aggregates",
    "gold_air_quality_peaks": "gold/air_quality_peaks",
    "gold_weather_metrics": "gold/weather_aggregates",
    "rejects_air_quality": "rejects/air_quality", "rejects_weather": "rejects/weather",
}
OPTIONAL = "('gold/air_quality_peaks', 'rejects/air_quality', 'rejects/weather')"
PEAK_COLUMNS = (
    ("window_start", "timestamp"), ("window_end", "timestamp"), ("city", "string"),
    ("parameter", "string"), ("rolling_avg", "double"), ("status", "string"),
    ("window_duration", "string"), ("prev_rolling_avg", "double"), ("delta", "double"),
    ("is_peak", "boolean"), ("window_date", "date"))

ENVELOPE = f"""SELECT {_sent(AIR_TEXT)} AS raw_value,
  event_time + INTERVAL 2 SECOND AS kafka_timestamp, 'air_quality_raw' AS topic,
  CAST(user_id % 8 AS INTEGER) AS partition, event_id * 2 + delivery AS "offset",
  CAST(event_time + INTERVAL 2 SECOND AS DATE) AS ingest_date FROM rec"""
SILVER_WEATHER = f"""SELECT message_id, event_time, city, {_rounded('temperature_c')},
  humidity_pct, {_rounded('wind_speed_ms')}, CAST(event_time AS DATE) AS event_date FROM clean"""
AIR_REJECTS = f"""SELECT raw_value, corrupt_record, event_time_raw, value AS value_raw,
  city AS city_raw, {AIR_REASON} AS reject_reason"""
STATE_BEFORE = f"""older AS (SELECT city, parameter, window_duration, rolling_avg AS state_avg
  FROM (SELECT *, row_number() OVER (PARTITION BY city, parameter, window_duration
  ORDER BY window_start DESC) AS rn FROM met WHERE window_start < {MIDDLE}) WHERE rn = 1)"""

ORACLES: dict[str, str] = {
    "raw_envelope": _chain(OBS) + ENVELOPE,
    "stream_bronze": _chain(OBS) + ENVELOPE,
    "scan_parquet": "SELECT event_id, event_type FROM events",
    "scan_empty": _chain(*METRICS) + LATEST,
    "parsed_air": _chain(*AIR) + """SELECT corrupt_record, event_time_raw, event_time, country,
      city, parameter, value, location_id, message_id FROM parsed""",
    "parsed_weather": _chain(*WEATHER) + f"""SELECT corrupt_record, event_time_raw, event_time,
      city, temperature, temperature_unit, wind_speed, wind_unit, humidity, humidity_unit,
      {_rounded('temperature_c', 'wind_speed_ms', 'humidity_pct')}, message_id FROM parsed""",
    "unit_conversion": _chain(OBS) + f"""SELECT event_id,
      {_rounded('temperature_c', 'wind_speed_ms', 'humidity_pct')}, {KNOWN_UNITS} AS known_units
      FROM units""",
    "rejects_air": _chain(*AIR) + f"""SELECT *, TIMESTAMP '2024-02-01' AS rejected_at,
      DATE '2024-02-01' AS reject_date FROM ({AIR_REJECTS} FROM parsed)
      WHERE reject_reason IS NOT NULL""",
    "stream_rejects": _chain(*AIR) + f"""SELECT * FROM ({AIR_REJECTS} FROM parsed)
      WHERE reject_reason IS NOT NULL""",
    "stream_rejects_weather": _chain(*WEATHER) + f"""SELECT * FROM (SELECT raw_value,
      corrupt_record, event_time_raw, city AS city_raw, {WEATHER_REASON} AS reject_reason
      FROM parsed) WHERE reject_reason IS NOT NULL""",
    "rejects_weather": _chain(*WEATHER) + f"""SELECT *, TIMESTAMP '2024-02-01' AS rejected_at,
      DATE '2024-02-01' AS reject_date FROM (SELECT raw_value, corrupt_record, event_time_raw,
      city AS city_raw, {WEATHER_REASON} AS reject_reason FROM parsed)
      WHERE reject_reason IS NOT NULL""",
    "rejects_strict": _chain(*WEATHER) + f"""SELECT reject_reason, count(*) AS rows FROM (
      SELECT coalesce({WEATHER_REASON}, CASE WHEN {WEATHER_RANGE} IS NULL
        THEN 'missing_measurement' WHEN NOT {KNOWN_UNITS} THEN 'unknown_unit' END)
        AS reject_reason FROM parsed) WHERE reject_reason IS NOT NULL GROUP BY 1""",
    "silver_air": _chain(*AIR, USABLE_AIR) + f"""SELECT message_id, event_time, country, city,
      parameter, value, location_id, CAST(event_time AS DATE) AS event_date
      FROM usable WHERE {_ranges()}""",
    "stream_silver": _chain(*AIR, USABLE_AIR) + f"""SELECT message_id, event_time, city,
      parameter, value, CAST(event_time AS DATE) AS event_date FROM usable WHERE {_ranges()}""",
    "silver_weather": _chain(*WEATHER_FLOW) + SILVER_WEATHER,
    "stream_silver_weather": _chain(*WEATHER_FLOW) + SILVER_WEATHER.replace(
        "\n  humidity_pct,", ""),
    "dispositions_air": _chain(*AIR) + f"""SELECT city, coalesce({AIR_REASON},
      CASE WHEN parameter NOT IN ('pm25','pm10','co','no2','o3')
      THEN 'dropped_unsupported_parameter' END, 'kept') AS disposition, count(*) AS rows
      FROM parsed GROUP BY ALL""",
    "dispositions_weather": _chain(*WEATHER) + f"""SELECT city, coalesce({WEATHER_REASON},
      CASE WHEN {WEATHER_RANGE} IS NULL THEN 'dropped_null_measurement' END, 'kept')
      AS disposition, count(*) AS rows FROM parsed GROUP BY ALL""",
    "contract_check": _chain(OBS) + """SELECT event_id * 2 + delivery AS "offset",
      CASE WHEN cut THEN 'not_an_object' ELSE
        CASE WHEN message_id = '' THEN 'empty:message_id,' ELSE '' END
        || CASE WHEN no_city THEN 'missing:city,' ELSE '' END
        || '""" + ",".join(f"missing:{m}" for m in MISSING_FIELDS) + """'
        || CASE WHEN no_value THEN ',missing:value' ELSE '' END END AS violations FROM rec""",
    "dedup_air": _chain(*AIR, USABLE_AIR, DEDUP) + """SELECT message_id, city, parameter,
      event_time, value FROM deduped""",
    "dedup_weather": _chain(*WEATHER, USABLE_WEATHER, DEDUP) + f"""SELECT message_id, city,
      event_time, {_rounded('temperature_c', 'wind_speed_ms')} FROM deduped""",
    "air_metrics": _chain(*AIR_FLOW, *_air_windows()) + f"SELECT {SHOW_AIR} FROM met",
    "weather_metrics": _chain(*WEATHER_FLOW, _weather_windows())
    + f"SELECT {SHOW_WEATHER} FROM met",
    "win_air": _chain(*CLEAN_OBS, *_air_windows(DEFAULT[:1])) + f"""SELECT {SHOW_WINDOW}
      FROM win""",
    "win_multi": _chain(*CLEAN_OBS, *_air_windows(COARSE)) + f"""SELECT {SHOW_WINDOW}
      FROM win""",
    "win_weather": _chain(OBS, f"clean AS (SELECT * FROM units WHERE {WEATHER_RANGE})",
                          _weather_windows(COARSE)) + f"SELECT {SHOW_WEATHER} FROM met",
    "status_levels": _chain(*CLEAN_OBS, *_air_windows(COARSE)) + f"SELECT {SHOW_AIR} FROM met",
    "peak_detection": _chain(*METRICS, *PEAKS) + f"SELECT {SHOW_PEAKS} FROM peaks",
    "peaks_with_state": _chain(
        *METRICS, STATE_BEFORE, LAGGED.replace(
            "FROM met)", f"FROM met WHERE window_start >= {MIDDLE})"),
        """filled AS (SELECT lagged.* REPLACE (coalesce(prev_rolling_avg, state_avg)
          AS prev_rolling_avg) FROM lagged LEFT JOIN older USING (city, parameter,
          window_duration))""",
        "peaks AS (SELECT *, rolling_avg - prev_rolling_avg AS delta FROM filled)")
    + f"SELECT {SHOW_PEAKS} FROM peaks",
    "latest_state": _chain(*METRICS) + LATEST,
    # The older table holds the later windows, so it wins wherever it has the series.
    "state_merge": _chain(*METRICS) + f"""SELECT city, parameter, window_duration,
      round(rolling_avg + CASE WHEN window_start < {MIDDLE} THEN 1 ELSE 0 END + 1.23456e-9, 8)
      AS prev_rolling_avg, window_start AS prev_window_start FROM (SELECT *, row_number() OVER (
      PARTITION BY city, parameter, window_duration ORDER BY window_start DESC) AS rn FROM met)
      WHERE rn = 1""",
    "keep_latest": _chain(*METRICS, REVISIONS) + f"""SELECT {SHOW_AIR},
      CAST(revision AS INTEGER) AS revision, ingested_at FROM (SELECT *, row_number() OVER (
      PARTITION BY window_start, window_end, city, parameter, window_duration
      ORDER BY ingested_at DESC) AS rn FROM revisions) WHERE rn = 1""",
    "active_danger": _chain(*METRICS) + f"""SELECT CAST(count(*) AS DOUBLE) AS value FROM met
      WHERE {ACTIVE}""",
    "active_warning": _chain(*METRICS) + f"""SELECT CAST(count(*) AS DOUBLE) AS value FROM met
      WHERE {_panel('10 MINUTE', " AND status = 'WARNING'")}""",
    "cities_impacted": _chain(*METRICS) + f"""SELECT CAST(count(DISTINCT city) AS DOUBLE)
      AS value FROM met
      WHERE {_panel('10 MINUTE', " AND status IN ('DANGER', 'WARNING')")}""",
    "worst_offender": _worst(ACTIVE, NOW),
    "worst_offender_default": _worst(
        _panel("10 MINUTE", " AND status = 'DANGER'", "TIMESTAMP '2025-01-01'",
               "TIMESTAMP '2025-01-02'"), "TIMESTAMP '2025-01-02'"),
    "recent_alerts": _chain(*METRICS) + f"""SELECT window_start, window_end, city, parameter,
      {TWO_PLACES} AS rolling_avg, status, window_duration FROM met WHERE {ACTIVE}
      ORDER BY window_start DESC, city, parameter, window_duration LIMIT 100""",
    "active_pairs": _chain(*METRICS) + f"""SELECT city || ' / ' || parameter AS city_parameter,
      CAST(count(*) AS DOUBLE) AS danger_count FROM met WHERE {ACTIVE} GROUP BY 1
      ORDER BY danger_count DESC, city_parameter LIMIT 10""",
    "top_offenders": _chain(*METRICS) + f"""SELECT city || ' / ' || parameter AS offender,
      CAST(count(*) AS DOUBLE) AS danger_count FROM met WHERE {DAY} GROUP BY 1
      ORDER BY danger_count DESC, offender LIMIT 10""",
    "top_offenders_filtered": _chain(*METRICS) + f"""SELECT city || ' / ' || parameter
      AS offender, CAST(count(*) AS DOUBLE) AS danger_count FROM met WHERE {DAY}
      AND regexp_matches(city, '^(par|LON)', 'i') AND regexp_matches(parameter, 'pm', 'i')
      AND regexp_matches(window_duration, '^10', 'i') AND regexp_matches(status, 'danger', 'i')
      GROUP BY 1 ORDER BY danger_count DESC, offender LIMIT 10""",
    "last_danger": _chain(*METRICS) + f"""SELECT city, window_start AS last_danger_at, parameter,
      {TWO_PLACES} AS rolling_avg, window_duration FROM (SELECT *, row_number() OVER (
      PARTITION BY city ORDER BY window_start DESC, parameter DESC, window_duration DESC) AS rn
      FROM met WHERE {DAY}) WHERE rn = 1""",
    "status_trend": _chain(*METRICS) + f"""SELECT time_bucket(INTERVAL 6 HOUR, window_start)
      AS time, city || ' / ' || status AS metric, CAST(count(*) AS DOUBLE) AS value FROM met
      WHERE {_panel(None, " AND status IN ('WARNING', 'DANGER')")} GROUP BY 1, 2""",
    "filter_values": _chain(*METRICS) + " UNION ALL ".join(
        f"SELECT DISTINCT '{v}' AS variable, {v} AS choice FROM met"
        for v in ("city", "parameter", "window_duration", "status")),
    "bi_average": _chain(*METRICS) + """SELECT city, parameter,
      round(avg(rolling_avg) + 1.23456e-9, 8) AS avg_rolling_avg FROM met GROUP BY 1, 2
      ORDER BY city, parameter LIMIT 5000""",
    "preview_latest": _chain(*METRICS) + f"""SELECT {SHOW_AIR} FROM met ORDER BY met.window_start
      DESC, met.window_end, city, parameter, met.rolling_avg, status, window_duration LIMIT 20""",
    "city_join": _chain(*METRICS) + """SELECT city,
      CASE city WHEN 'Paris' THEN 48.8566 ELSE CAST(count(*) AS DOUBLE) END AS latitude,
      CASE city WHEN 'Paris' THEN 2.3522 ELSE 0.5 END::DOUBLE AS longitude, count(*) AS rows,
      round(max(rolling_avg) + 1.23456e-9, 8) AS highest FROM met GROUP BY city""",
    "serving_rows": _chain(*METRICS, REVISIONS) + f"""SELECT {SHOW_AIR} FROM (SELECT *,
      row_number() OVER (PARTITION BY window_start, window_end, city, parameter,
      window_duration ORDER BY rolling_avg DESC) AS rn FROM revisions WHERE parameter <> 'o3')
      WHERE rn = 1""",
    "retention": _chain(*METRICS) + f"""SELECT {SHOW_AIR} FROM met
      WHERE window_start >= {MIDDLE} - INTERVAL 7 DAY""",
    "constraints": _chain(OBS, *_air_windows((DEFAULT[0], COARSE[1]), "obs"), """
      rules(rule, violations) AS (
        SELECT 'parameter_domain', count(*) FROM met
          WHERE parameter NOT IN ('pm25','pm10','co','no2','o3')
        UNION ALL SELECT 'status_domain', count(*) FROM met
          WHERE status NOT IN ('OK','WARNING','DANGER','UNKNOWN')
        UNION ALL SELECT 'duration_domain', count(*) FROM met
          WHERE window_duration NOT IN ('5 minutes', '10 minutes')""" + "".join(
            f" UNION ALL SELECT '{c}_not_null', count(*) FROM met WHERE {c} IS NULL"
            for c in ("window_start", "window_end", "city", "parameter", "rolling_avg", "status",
                      "window_duration")) + ")") + "SELECT rule, violations FROM rules",
    "dup_keys": _chain(*METRICS, REVISIONS) + """SELECT count(*) AS duplicate_keys FROM (
      SELECT 1 FROM revisions GROUP BY window_start, window_end, city, parameter,
      window_duration HAVING count(*) > 1)""",
    "nonempty": _chain(*METRICS, f"good AS (SELECT * FROM units WHERE {WEATHER_RANGE})", _averages(
        "wmet", DEFAULT, "city", "avg(temperature_c) AS t", "good")) + """
      SELECT *, rows > 0 AS ok FROM (
        SELECT 'air_quality_metrics' AS table_name, count(*) AS rows FROM met UNION ALL
        SELECT 'weather_metrics', count(*) FROM wmet)""",
    "message_id": _chain(OBS) + """SELECT event_id, sha1(concat_ws('|',
      CAST(user_id AS VARCHAR), parameter, message_id, CAST(k AS VARCHAR))) AS content_id
      FROM obs""",
    "recency": _chain(OBS) + f"""SELECT CAST(user_id AS VARCHAR) AS location_id,
      time_text AS event_time FROM obs
      WHERE event_id % 6 <> 5 AND event_time >= {NOW} - INTERVAL 6 HOUR""",
    "change_only": _chain(OBS, TWICE, REPEATED) + """SELECT country, city, parameter,
      event_time, value, event_id, delivery FROM marked WHERE NOT repeated""",
    # The stream that forgets hands the first deliveries on twice.
    "stream_change_only": _chain(OBS, TWICE, REPEATED, """
      kept AS (SELECT country, city, parameter, event_time, value, event_id, delivery
        FROM marked WHERE NOT repeated)""") + """SELECT *, 'long' AS ttl FROM kept
      UNION ALL SELECT * REPLACE (TIMESTAMP '2099-01-01' AS event_time), 'long' FROM (
        SELECT country, city, parameter, event_time, value, event_id, 0 AS delivery FROM obs
        ORDER BY event_id DESC LIMIT 1)
      UNION ALL SELECT *, 'short' FROM kept UNION ALL SELECT *, 'short' FROM kept""",
    "ingestion_counters": _chain(OBS, TWICE, REPEATED) + f"""SELECT city,
      CASE WHEN event_id % 40 = 5 THEN 'missing_time'
        WHEN date_trunc('second', event_time) < {NOW} - INTERVAL 6 HOUR THEN 'skipped_old'
        WHEN repeated THEN 'skipped_dup' ELSE 'produced' END AS disposition, count(*) AS rows
      FROM marked GROUP BY 1, 2""",
    "capacity_trim": _chain(OBS) + f"""SELECT user_id, parameter, event_time AS updated_at,
      event_id FROM obs WHERE event_time >= {MIDDLE} - INTERVAL 24 HOUR
      ORDER BY event_time DESC, user_id, parameter, event_id LIMIT 5000""",
    "raw_payloads": _chain(OBS) + """SELECT country, city,
      strftime(event_time, '%Y-%m-%dT%H:%M') AS time, temperature AS temperature_2m,
      temperature_unit FROM obs""",
    "payload_times": _chain(OBS) + f"""SELECT CAST(user_id AS VARCHAR) AS location_id,
      CAST(value AS VARCHAR) AS value, {ITEM_TIME} AS event_time FROM obs""",
    "city_match": _chain(OBS) + f"""SELECT place, count(*) AS rows,
      coalesce(max({STATION_CITY}), '') AS cities FROM (
        SELECT *, {PLACES} || ' ' || parameter AS place FROM obs) GROUP BY place""",
    "best_location": _chain(OBS, STATIONS, CITY_STATIONS) + """SELECT country, target_city,
      CAST(user_id AS VARCHAR) AS id, CASE WHEN user_id % 5 <> 0 THEN last_time END
      AS last_reported FROM (SELECT *, row_number() OVER (PARTITION BY country, target_city
      ORDER BY CASE WHEN user_id % 5 <> 0 THEN last_time END DESC NULLS LAST, user_id) AS rn
      FROM city_stations) WHERE rn = 1""",
    "sensor_lookup": _chain(OBS, SENSORS) + "SELECT * FROM sensors",
    "payload_air": _chain(OBS, STATIONS, CITY_STATIONS, SENSORS, f"""
      items AS (SELECT 'openaq' AS source, c.country, c.target_city AS city,
        coalesce(nullif(c.locality, ''), c.place) AS station_city, c.target_city,
        CASE WHEN event_id % 4 IN (0, 1) THEN parameter ELSE sensor_parameter END AS parameter,
        value, CASE WHEN event_id % 4 = 0 THEN 'ppm' ELSE sensor_unit END AS unit,
        CASE WHEN event_id % 3 = 0 THEN 1.5::DOUBLE ELSE CAST(o.user_id % 90 AS DOUBLE) END
          AS latitude,
        CASE WHEN event_id % 3 = 0 THEN 2.5::DOUBLE ELSE CAST(o.user_id % 180 AS DOUBLE) END
          AS longitude,
        {ITEM_TIME} AS event_time, '2024-02-01T00:00:00+00:00' AS ingestion_time,
        s.location_id, s.sensor_id, 'net-' || CAST(o.user_id % 4 AS VARCHAR) AS provider,
        CASE WHEN event_id % 4 = 0 THEN 77 ELSE sensor_parameter_id END AS parameter_id
      FROM obs o JOIN city_stations c ON o.user_id = c.user_id AND o.country = c.country
      JOIN sensors s ON s.location_id = CAST(o.user_id AS VARCHAR)
        AND s.sensor_id = CAST(o.user_id * 10 + length(o.parameter) AS VARCHAR))""")
    + """SELECT *, sha1(concat_ws('|', location_id, coalesce(parameter, ''),
      coalesce(event_time, ''), CAST(value AS VARCHAR), coalesce(unit, ''))) AS message_id
      FROM items""",
    "ingest_air": _chain(OBS, STATIONS, CITY_STATIONS, """
      best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, target_city
        ORDER BY CASE WHEN user_id % 5 <> 0 THEN last_time END DESC NULLS LAST, user_id) AS rn
        FROM city_stations) WHERE rn = 1)""") + f"""SELECT o.country, b.target_city AS city,
      CAST(o.user_id AS VARCHAR) AS location_id,
      CAST(o.user_id * 10 + length(o.parameter) AS VARCHAR) AS sensor_id,
      CASE WHEN event_id % 4 IN (0, 1) THEN o.parameter ELSE s.parameter END AS parameter,
      value, {ITEM_TIME} AS event_time
      FROM obs o JOIN best b USING (user_id, country)
      JOIN (SELECT user_id, length(parameter) AS n, min(upper(parameter)) AS parameter FROM obs
        GROUP BY ALL) s ON s.user_id = o.user_id AND s.n = length(o.parameter)""",
    "payload_forecast": _chain(OBS) + f"""SELECT 'open-meteo' AS source, country, city,
      CAST(user_id % 90 AS DOUBLE) AS latitude, CAST(user_id % 180 AS DOUBLE) AS longitude,
      round(temperature_c + 1.23456e-9, 8) AS temperature, 'C' AS temperature_unit,
      round(wind_speed_ms + 1.23456e-9, 8) AS wind_speed, 'm/s' AS wind_unit, k AS humidity,
      '%' AS humidity_unit, strftime(event_time, '%Y-%m-%dT%H:%M:00+00:00') AS event_time,
      '2024-02-01T00:00:00+00:00' AS ingestion_time FROM units""",
    "payload_observation": _chain(OBS, """seen AS (SELECT 'openweather' AS source, country, city,
      CAST(user_id % 90 AS DOUBLE) AS latitude, CAST(user_id % 180 AS DOUBLE) AS longitude,
      temperature, 'C' AS temperature_unit, wind_speed, 'm/s' AS wind_unit, k AS humidity,
      '%' AS humidity_unit, CASE WHEN NOT no_time THEN
        strftime(event_time, '%Y-%m-%dT%H:%M:%S+00:00') END AS event_time,
      '2024-02-01T00:00:00+00:00' AS ingestion_time FROM obs)""") + """SELECT *,
      sha1(concat_ws('|', source, city, coalesce(event_time, ''),
        coalesce(CAST(temperature AS VARCHAR), ''), CAST(wind_speed AS VARCHAR),
        CAST(humidity AS VARCHAR), 'C', 'm/s', '%')) AS message_id FROM seen""",
    "publish_air": _chain(OBS) + """SELECT country || '|' || city || '|' || parameter AS key,
      '{"country":"' || country || '","city":"' || city || '","parameter":"' || parameter
      || '","value":' || CAST(value AS VARCHAR) || ',"message_id":"' || message_id
      || '","sensor_id":' || CASE WHEN event_id % 3 = 0 THEN CAST(k AS VARCHAR) ELSE 'null' END
      || '}' AS value FROM obs""",
    "publish_weather": _chain(OBS) + """SELECT
      CASE WHEN event_id % 9 <> 0 THEN city ELSE 'NA' END || '|feed' AS key,
      '{"city":' || CASE WHEN event_id % 9 <> 0 THEN '"' || city || '"' ELSE 'null' END
      || ',"source":"feed","humidity":' || CAST(k AS VARCHAR) || '}' AS value FROM obs""",
    "gold_merge": _chain(*METRICS) + f"""SELECT window_start, window_end, city, parameter,
      round(rolling_avg + CASE WHEN window_start < {MIDDLE} THEN 1 ELSE 0 END + 1.23456e-9, 8)
      AS rolling_avg, status, window_duration, CAST(window_start AS DATE) AS window_date
      FROM met""",
    "peaks_merge": _chain(*METRICS, *PEAKS) + f"""SELECT *, CAST(window_start AS DATE)
      AS window_date FROM (SELECT {SHOW_PEAKS} FROM peaks) WHERE is_peak AND city <> 'Paris'""",
    "layers": LAYER_CTES + "SELECT *, rows > 0 OR NOT required AS ok FROM (SELECT layer, rows, "
    f"layer NOT IN {OPTIONAL} AS required FROM (" + " UNION ALL ".join(
        f"SELECT '{LOCATIONS[name]}' AS layer, count(*) AS rows FROM {source}"
        for name, source in LAYER_SOURCES.items()) + "))",
    "catalog_counts": LAYER_CTES + _counts(LAYER_SOURCES),
    "backfill_retry": LAYER_CTES + _counts(LAYER_SOURCES),
    "backfill_two_batches": _chain(*AIR_FLOW, *_air_windows()) + f"""SELECT {SHOW_AIR},
      CAST(met.window_start AS DATE) AS window_date FROM met""",
    "backfill_peaks": _chain(*AIR_FLOW, *_air_windows(), *PEAKS) + f"""SELECT *,
      CAST(window_start AS DATE) AS window_date FROM (SELECT {SHOW_PEAKS} FROM peaks)
      WHERE is_peak""",
    "backfill_displaced": _chain(*MOVED_FLOW, *_air_windows()) + f"""SELECT {SHOW_AIR},
      CAST(met.window_start AS DATE) AS window_date FROM met""",
    "backfill_displaced_peaks": _chain(*MOVED_FLOW, *_air_windows(), *PEAKS) + f"""SELECT *,
      CAST(window_start AS DATE) AS window_date FROM (SELECT {SHOW_PEAKS} FROM peaks)
      WHERE is_peak""",
    "retention_drop": LAYER_CTES + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows FROM (SELECT * FROM "
        f"{LAYER_SOURCES[name]}) WHERE window_start >= {MIDDLE} - INTERVAL 7 DAY"
        for name in ("gold_air_quality_metrics", "gold_air_quality_peaks", "gold_weather_metrics")),
    "preview_peaks": _chain(*METRICS, *PEAKS) + f"""SELECT window_start, window_end, city, parameter,
      rolling_avg, status, delta, is_peak, window_duration FROM (SELECT {SHOW_PEAKS} FROM peaks)
      WHERE is_peak ORDER BY window_start DESC, window_end, city, parameter, rolling_avg, status, delta,
      is_peak, window_duration LIMIT 20""",
    "change_only_interleaved": _chain(OBS, TWICE) + """SELECT country, city, parameter,
      date_trunc('day', event_time)::TIMESTAMP AS event_time, (floor(value) % 3)::DOUBLE AS value,
      min(event_id) AS event_id, 0 AS delivery FROM twice GROUP BY 1, 2, 3, 4, 5""",
    "message_id_numbers": _chain(OBS) + """SELECT event_id, sha1(parameter || '|' || CAST(CAST(
      (event_id % 997 + 1) || 'e' || (event_id % 27 - 9) AS DOUBLE) AS VARCHAR)) AS content_id
      FROM obs""",
    "inferred_schema": LAYER_CTES + "SELECT column_name, data_type, rows FROM (VALUES "
    + ", ".join(f"('{n}', '{t}')" for n, t in PEAK_COLUMNS)
    + ") v(column_name, data_type), (SELECT count(*) AS rows FROM "
    + LAYER_SOURCES["gold_air_quality_peaks"] + ")",
    "stream_win_air": _chain(*AIR_FLOW, *_air_windows(), CLOSED) + f"""SELECT {SHOW_AIR},
      CAST(closed.window_start AS DATE) AS window_date FROM closed""",
    "stream_win_weather": _chain(*WEATHER_FLOW, _weather_windows(), CLOSED) + f"""SELECT
      {SHOW_WEATHER}, CAST(closed.window_start AS DATE) AS window_date FROM closed""",
    "stream_late": _chain(*AIR, USABLE_AIR, DEDUP, f"""clean AS (SELECT * FROM deduped
      WHERE {_ranges()} AND event_time >= {MIDDLE} - INTERVAL 2 SECOND)""", *_air_windows(),
                          CLOSED) + f"""SELECT {SHOW_AIR},
      CAST(closed.window_start AS DATE) AS window_date FROM closed""",
    "stream_update": _chain(*AIR_FLOW, *_air_windows()) + f"""SELECT {SHOW_AIR},
      CAST(met.window_start AS DATE) AS window_date FROM met""",
    "stream_peaks": _chain(*AIR_FLOW, *_air_windows(), *PEAKS) + f"""SELECT *,
      CAST(window_start AS DATE) AS window_date FROM (SELECT {SHOW_PEAKS} FROM peaks)
      WHERE is_peak""",
    "stream_update_weather": _chain(*WEATHER_FLOW, _weather_windows()) + f"""SELECT
      {SHOW_WEATHER}, CAST(met.window_start AS DATE) AS window_date FROM met""",
}
