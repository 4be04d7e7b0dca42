"""Weather payload queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventrank.catalog.registry import register
from eventrank.functions.values import parse_utc
from eventrank.operators import weather as w
from eventrank.operators.nearest import nearest_join as nearest_rows
from eventrank.schemas import EVENT_KEYS, PAYLOAD_SCHEMA
from eventrank.sources import payloads
from eventrank.sources.binding import EVENT_NAMES
from eventrank.sources.lake import read_json, read_partitioned, write_json
from eventrank.sources.session import scratch_folder
from eventrank.sources.tables import table

_NAME = " ".join(f"WHEN {k} THEN '{name}'" for k, (name, _) in EVENT_NAMES.items())
_SLUG = " ".join(f"WHEN {k} THEN '{slug}'" for k, (_, slug) in EVENT_NAMES.items())


def _nearest(session: str, prefix: str) -> str:
    return f"""
{session}_hour AS (
  SELECT d.day, h.temp AS {prefix}_temperature_c, CAST(h.n % 100 AS DOUBLE) AS {prefix}_precipitation_probability,
    h.low AS {prefix}_precipitation_mm, CASE WHEN h.place <= 20 THEN h.rain END AS {prefix}_rain_mm,
    CAST(h.n AS DOUBLE) AS {prefix}_wind_speed_kmh, strftime(h.hour, '%Y-%m-%dT%H:%M:%SZ') AS {prefix}_timestamp_utc,
    CAST(trunc(date_diff('second', d.{session}, h.hour) / 60.0) AS INTEGER) AS {prefix}_offset_minutes
  FROM days d JOIN hours h ON h.day = d.day
  QUALIFY row_number() OVER (PARTITION BY d.day ORDER BY abs(date_diff('second', d.{session}, h.hour)), h.hour) = 1),
"""


STEPS = f"""
WITH hours AS (
  SELECT date_trunc('hour', ts) AS hour, CAST(date_trunc('day', ts) AS DATE) AS day, max(value) AS temp,
    min(value) AS low, max(value) FILTER (WHERE event_type = 'click') AS rain, count(*) AS n,
    row_number() OVER (PARTITION BY CAST(date_trunc('day', ts) AS DATE) ORDER BY date_trunc('hour', ts)) AS place
  FROM events GROUP BY 1, 2),
day0 AS (
  SELECT CAST(ts AS DATE) AS day, date_trunc('second', min(ts) FILTER (WHERE event_type = 'purchase')) AS race,
    date_trunc('second', min(ts) FILTER (WHERE event_type = 'signup')) AS qualifying,
    max(value) AS tmax, min(value) AS tmin, CAST(count(*) AS DOUBLE) AS n, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS k
  FROM events GROUP BY CAST(ts AS DATE)),
days AS (
  SELECT *, CAST(2024 + k // 12 AS INTEGER) AS event_year, CASE k % 12 + 1 {_NAME} END AS event_name,
    CASE k % 12 + 1 {_SLUG} END AS event, strftime(race, '%Y-%m-%dT%H:%M:%SZ') AS race_dt_utc,
    strftime(qualifying, '%Y-%m-%dT%H:%M:%SZ') AS qualifying_dt_utc,
    CASE WHEN k % 2 = 0 THEN CASE WHEN k % 4 <> 0 THEN n % 5 * 0.5E0 ELSE 0E0 END
         ELSE CASE WHEN k % 3 <> 0 THEN n % 7 * 0.5E0 ELSE 0E0 END END AS precipitation_sum_mm,
    CASE WHEN k % 2 = 0 THEN n % 100 ELSE 0E0 END AS precipitation_probability_max,
    CASE WHEN k % 2 = 0 THEN tmax ELSE tmax + 1 END AS temperature_max_c, tmin AS temperature_min_c,
    CASE WHEN k % 2 = 0 THEN n + 1 ELSE n END AS wind_speed_max_kmh
  FROM day0),
{_nearest('race', 'race_hour')}
{_nearest('qualifying', 'qualifying_hour')}
"""

_DAILY = "precipitation_sum_mm, precipitation_probability_max, temperature_max_c, temperature_min_c, wind_speed_max_kmh"
_FETCHED = "strftime(day, '%Y-%m-%dT00:00:00Z') AS fetched_at_utc"


def sql(select: str) -> str:
    return STEPS.rstrip().rstrip(",") + "\n" + select


def _enriched(spark, folder):
    return w.enrich(payloads.raw_payloads(spark, folder))


def _landed(spark, folder):
    """Payloads written to the lake as JSON and read back with the payload schema."""
    path = scratch_folder(spark, "payloads")
    write_json(_enriched(spark, folder), path)
    return read_json(spark, path, PAYLOAD_SCHEMA)


def _silver(spark, folder, build):
    landed = _landed(spark, folder)
    return build(payloads.pointers(landed), landed)


@register(sql("""
SELECT event_year, event_name, qualifying_dt_utc, race_dt_utc, CAST(k AS DOUBLE) AS circuit_lat,
  (SELECT count(*) FROM hours h WHERE h.day = days.day) + 1 AS hours, precipitation_sum_mm
FROM days"""))
def payload_scan(spark, folder):
    landed = _landed(spark, folder)
    return landed.select(
        "metadata.event_year", F.col("metadata.EventName").alias("event_name"), "metadata.qualifying_dt_utc",
        "metadata.race_dt_utc", "metadata.circuit_lat",
        F.size("open_meteo_response.hourly.time").cast("bigint").alias("hours"),
        "daily_features.precipitation_sum_mm",
    )


@register(sql("SELECT event_year, event_name, race_hour.* EXCLUDE (day) FROM days JOIN race_hour USING (day)"))
def nearest_hour(spark, folder):
    at = parse_utc(F.col("metadata.race_dt_utc"))
    return payloads.raw_payloads(spark, folder).select(
        "metadata.event_year", F.col("metadata.EventName").alias("event_name"),
        *w.nearest_hour("open_meteo_response.hourly", at, "race_hour"),
    )


@register(sql(f"SELECT event_year, event_name, {_DAILY} FROM days"))
def daily_pick(spark, folder):
    at = parse_utc(F.col("metadata.race_dt_utc"))
    return payloads.raw_payloads(spark, folder).select(
        "metadata.event_year", F.col("metadata.EventName").alias("event_name"),
        *w.daily_features("open_meteo_response.daily", at),
    )


@register(sql(f"""
SELECT event_year, event, event_name, CASE WHEN k % 2 = 0 THEN 'historical' ELSE 'live' END AS forecast_source,
  race_dt_utc, qualifying_dt_utc, {_FETCHED}, {_DAILY}, race_hour.* EXCLUDE (day)
FROM days JOIN race_hour USING (day)"""))
def silver_weather(spark, folder):
    return _silver(spark, folder, w.silver_forecast)


@register(sql(f"""
SELECT event_year, event, event_name, qualifying_dt_utc, {_FETCHED}, {_DAILY}, qualifying_hour.* EXCLUDE (day)
FROM days JOIN qualifying_hour USING (day)"""))
def silver_weather_qualifying(spark, folder):
    return _silver(spark, folder, w.silver_qualifying)


@register(sql("""
SELECT event_year, event, 'forecast' AS dataset FROM days JOIN race_hour USING (day)
UNION ALL SELECT event_year, event, 'historical_qualifying' FROM days JOIN qualifying_hour USING (day)"""))
def weather_sink(spark, folder):
    """Both weather datasets written below one folder and read back."""
    path, landed = scratch_folder(spark, "weather"), _landed(spark, folder)
    w.write_silver(payloads.pointers(landed), landed, path)
    schema = "qualifying_dt_utc string, event_year int, event string"
    parts = [
        read_partitioned(spark, f"{path}/{name}", schema, EVENT_KEYS).select(*EVENT_KEYS, F.lit(name).alias("dataset"))
        for name in w.DATASETS
    ]
    return parts[0].unionByName(parts[1])


@register(sql("""
SELECT event_year, event, event_name, strftime(race, '%Y-%m-%d') AS race_date, CAST(k AS DOUBLE) AS circuit_lat,
  CAST(-k AS DOUBLE) AS circuit_lng,
  CASE WHEN k % 3 <> 0 THEN n % 7 * 0.5E0 ELSE 0E0 END AS precipitation_sum_mm, n % 11 * 0.25E0 AS rain_sum_mm,
  tmax + 1 AS temperature_max_c, tmin AS temperature_min_c, n AS wind_speed_max_kmh, n + 2 AS wind_gusts_max_kmh,
  k % 3 <> 0 AND n % 7 * 0.5E0 >= 1 AS is_wet_race
FROM days"""))
def weather_daily_row(spark, folder):
    return w.daily_rows(payloads.raw_payloads(spark, folder))


_ALIGNED = """
SELECT event_year, event, race_dt_utc, race_hour_timestamp_utc, race_hour_offset_minutes,
  message LIKE 'aligned%' AS aligned, message
FROM (
  SELECT *, CASE
      WHEN race_hour_timestamp_utc[1:10] <> race_dt_utc[1:10]
        THEN 'the hour is of ' || race_hour_timestamp_utc[1:10] || ', the race of ' || race_dt_utc[1:10]
      WHEN race_hour_timestamp_utc[12:13] <> race_dt_utc[12:13]
        THEN 'the hour begins at ' || CAST(race_hour_timestamp_utc[12:13] AS INTEGER) || ', the race within hour '
          || CAST(race_dt_utc[12:13] AS INTEGER)
      WHEN abs(race_hour_offset_minutes) > 60 THEN 'the hour is ' || race_hour_offset_minutes || ' minutes off'
      ELSE 'aligned, ' || race_hour_offset_minutes || ' minutes off' END AS message
  FROM days JOIN race_hour USING (day))
"""


def _race_alignment(spark, folder):
    enriched = _enriched(spark, folder)
    return w.race_hour_alignment(w.silver_forecast(payloads.pointers(enriched), enriched))


@register(sql(_ALIGNED))
def alignment_race_hour(spark, folder):
    return _race_alignment(spark, folder)


@register(sql("""
SELECT event_year, event, qualifying_dt_utc, qualifying_hour_timestamp_utc,
  qualifying_hour_offset_minutes AS computed_offset_minutes, TRUE AS offset_matches,
  abs(qualifying_hour_offset_minutes) <= 30 AS in_range
FROM days JOIN qualifying_hour USING (day)"""))
def alignment_qualifying_hour(spark, folder):
    return w.qualifying_hour_alignment(_silver(spark, folder, w.silver_qualifying))


@register(sql(f"""
SELECT CAST(count(*) FILTER (WHERE aligned) AS BIGINT) AS aligned, count(*) AS total FROM ({_ALIGNED})"""))
def alignment_summary(spark, folder):
    return w.alignment_summary(_race_alignment(spark, folder))


@register("""
SELECT p.event_id, p.user_id, p.ts, e.event_id AS nearest_event_id, e.ts AS nearest_ts
FROM events p LEFT JOIN events e ON e.user_id = p.user_id AND e.event_type = 'error'
WHERE p.event_type = 'purchase'
QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(e.ts) - epoch_us(p.ts)), e.ts, e.event_id) = 1""")
def nearest_join(spark, folder):
    """Each purchase with the error of the same user that is nearest in time, before or after."""
    events = table(spark, folder, "events")
    kind = lambda name: events.where(F.col("event_type") == name).select("event_id", "user_id", "ts")
    met = nearest_rows(kind("purchase"), kind("error"), ["user_id"], "ts", "ts", ["event_id"])
    return met.select("event_id", "user_id", "ts", F.col("nearest.event_id").alias("nearest_event_id"), F.col("nearest.ts").alias("nearest_ts"))
