"""Tracking table and decision queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventrank.catalog.binding_sql import with_binding
from eventrank.catalog.registry import register
from eventrank.functions.text import SESSION_ABBREVIATIONS, event_slug
from eventrank.operators import decisions as d
from eventrank.operators import tracking as t
from eventrank.plans import silver
from eventrank.schemas import absent_fields
from eventrank.sources import binding, calendar
from eventrank.sources.calendar import LOADED_UNTIL, NOW
from eventrank.sources.coordinates import CIRCUITS, with_coordinates
from eventrank.sources.lake import pointer_columns

UPSERT_FROM = 2000
LOOKUP_KEY = "1999_Monaco_Grand_Prix"

_COORDS = ", ".join(f"('{slug}', {lat}E0, {lng}E0)" for slug, (lat, lng) in CIRCUITS.items())
_ABBREVIATED = " ".join(f"WHEN '{abr}' THEN '{name}'" for name, abr in SESSION_ABBREVIATIONS.items())
_FORMAT = "CASE WHEN event_number = 2 THEN 'testing' WHEN event_number % 3 = 0 THEN 'sprint' ELSE 'conventional' END"


def _pointer(kind: str) -> str:
    return (
        "'s3://lake/bronze/season=' || event_year || '/event=' || event || '/session=' || session ||"
        f" '/{kind}/' || pk || '_{kind}.parquet'"
    )


TRACKING = f"""
coords AS (SELECT * FROM (VALUES {_COORDS}) AS v(event, circuit_lat, circuit_lng)),
t0 AS (
  SELECT b_dim.*, event_year || '_' || replace(event_name, ' ', '_') AS pk, circuit_lat, circuit_lng,
    session_date_utc < '{LOADED_UNTIL}' AND NOT (event_number % 5 = 0 AND session = 'Q') AS is_loaded
  FROM b_dim LEFT JOIN coords USING (event)),
t AS (
  SELECT pk AS event_partition_key, session AS session_name_abr, event_year, event_number, event_name AS "EventName",
    CASE session {_ABBREVIATED} END AS session_name, session_date_utc[1:10] AS session_date, session_date_utc,
    {_FORMAT} AS event_format, session <> 'R' AS is_before_race,
    CASE WHEN is_loaded THEN TRUE WHEN session <> 'P1' THEN FALSE END AS data_loaded,
    CASE WHEN is_loaded THEN {_pointer('Results')} END AS s3_results_location,
    CASE WHEN is_loaded THEN {_pointer('Laps')} END AS s3_laps_location,
    CASE WHEN session = 'R' AND event_number % 2 = 0 AND event_year < 2000 THEN {_pointer('HistoricalForecast')} END
      AS s3_historical_weather_forecast_location,
    CASE WHEN session = 'R' AND event_number % 3 = 0 THEN {_pointer('LiveForecast')} END
      AS s3_live_weather_forecast_location,
    CASE WHEN session = 'Q' AND event_number % 4 = 0 THEN {_pointer('QualifyingWeather')} END
      AS s3_historical_qualifying_weather_location,
    circuit_lat, circuit_lng
  FROM t0),
w AS (
  SELECT q.event_partition_key, q."EventName", q.event_year,
    strptime(q.session_date_utc, '%Y-%m-%dT%H:%M:%SZ') AS qualifying_dt_utc,
    strptime(r.session_date_utc, '%Y-%m-%dT%H:%M:%SZ') AS race_dt_utc, r.circuit_lat, r.circuit_lng
  FROM t q JOIN t r ON q.event_partition_key = r.event_partition_key
  WHERE q.session_name_abr = 'Q' AND r.session_name_abr = 'R' AND r.circuit_lat IS NOT NULL),
runs AS (SELECT DISTINCT event_year || '0301T000000Z' AS run_id, event_year FROM b_results WHERE session = 'R'),
predicted AS (SELECT event_year, event FROM b_events WHERE event_number % 2 = 0),
"""

SCHEDULE = f"""
coords AS (SELECT * FROM (VALUES {_COORDS}) AS v(event, circuit_lat, circuit_lng)),
slots AS (
  SELECT *, event_number % 3 = 0 AS sprint, event_year || '-' || lpad(CAST(event_number AS VARCHAR), 2, '0') || '-' AS ym
  FROM b_events),
s0 AS (
  SELECT *, 'Practice 1' AS name, 'P1' AS abr, ym || '03 12:00:00' AS begins FROM slots
  UNION ALL
  SELECT *, CASE WHEN event_year < 1998 THEN 'Sprint Shootout' ELSE 'Sprint Qualifying' END,
    CASE WHEN event_year < 1998 THEN 'SS' ELSE 'SQ' END, ym || '05 12:00:00' FROM slots WHERE sprint
  UNION ALL
  SELECT *, CASE WHEN sprint THEN 'Sprint' ELSE 'warm up' END, CASE WHEN sprint THEN 'S' ELSE 'W' END,
    ym || '06 12:00:00' FROM slots WHERE sprint OR event_year = 1995
  UNION ALL SELECT *, 'Qualifying', 'Q', ym || '10 14:00:00' FROM slots
  UNION ALL SELECT *, 'Race', 'R', ym || '20 13:00:00' FROM slots WHERE event_number <> 11),
s1 AS (
  SELECT event_year || '_' || replace(event_name, ' ', '_') AS event_partition_key, event_year, event_number,
    event_name AS "EventName", name AS session_name, abr AS session_name_abr, name <> 'Race' AS is_before_race,
    begins AS session_date,
    CASE WHEN NOT (abr = 'P1' AND event_number = 4) THEN replace(begins, ' ', 'T') || 'Z' END AS session_date_utc,
    {_FORMAT} AS event_format, FALSE AS data_loaded, circuit_lat, circuit_lng
  FROM s0 LEFT JOIN coords USING (event)),
"""


def _tracking(spark, folder):
    return calendar.tracking(spark, folder)


def _windows(spark, folder):
    return d.event_windows(_tracking(spark, folder))


@register(with_binding(SCHEDULE, "SELECT * FROM s1"))
def schedule_unpivot(spark, folder):
    return t.schedule_sessions(calendar.schedule(spark, folder))


@register(with_binding(TRACKING, """
SELECT event_partition_key, session_name_abr, session_date_utc, circuit_lat, circuit_lng FROM t
WHERE session_name_abr IN ('Q', 'R') AND session_date_utc IS NOT NULL AND circuit_lat IS NOT NULL"""))
def tracking_filter(spark, folder):
    rows = t.filter_rows(_tracking(spark, folder), ["session_date_utc", "circuit_lat", "circuit_lng"], ["Q", "R"])
    return rows.select(*t.KEYS, "session_date_utc", "circuit_lat", "circuit_lng")


@register(with_binding(TRACKING, f"SELECT * FROM t WHERE event_partition_key = '{LOOKUP_KEY}'"))
def tracking_lookup(spark, folder):
    return t.lookup(_tracking(spark, folder), LOOKUP_KEY)


@register(with_binding(TRACKING, f"""
SELECT event_partition_key, session_name_abr, event_year, session_date_utc FROM t
WHERE NOT COALESCE(data_loaded, FALSE) AND session_date_utc < '{NOW}'
ORDER BY event_year DESC, session_date_utc DESC, event_partition_key, session_name_abr LIMIT 20"""))
def load_backlog(spark, folder):
    rows = t.load_backlog(_tracking(spark, folder), NOW, limit=20)
    return rows.select(*t.KEYS, "event_year", "session_date_utc")


@register(with_binding(TRACKING, """
SELECT event_partition_key, session_name_abr, 'lake' AS bucket, s3_laps_location[11:] AS key,
  regexp_replace(s3_laps_location[11:], '/[^/]*$', '') AS folder
FROM t WHERE s3_laps_location IS NOT NULL"""))
def pointer_folders(spark, folder):
    rows = t.filter_rows(_tracking(spark, folder), ["s3_laps_location"])
    return rows.select(*t.KEYS, *pointer_columns(F.col("s3_laps_location")))


@register(with_binding(SCHEDULE + TRACKING.replace(f"\ncoords AS (SELECT * FROM (VALUES {_COORDS}) AS v(event, circuit_lat, circuit_lng)),", ""), f"""
SELECT COALESCE(t.event_partition_key, s1.event_partition_key) AS event_partition_key,
  COALESCE(t.session_name_abr, s1.session_name_abr) AS session_name_abr,
  CASE WHEN s1.event_year IS NULL THEN t.event_year ELSE s1.event_year END AS event_year,
  CASE WHEN s1.event_year IS NULL THEN t.session_date ELSE s1.session_date END AS session_date,
  CASE WHEN s1.event_year IS NULL THEN t.session_date_utc ELSE s1.session_date_utc END AS session_date_utc,
  CASE WHEN s1.event_year IS NULL THEN t.data_loaded ELSE COALESCE(t.data_loaded, FALSE) END AS data_loaded,
  t.s3_results_location, t.s3_laps_location, t.s3_live_weather_forecast_location
FROM (SELECT * FROM t WHERE event_year <= {UPSERT_FROM}) t
FULL JOIN (SELECT * FROM s1 WHERE event_year >= {UPSERT_FROM}) s1
  ON t.event_partition_key = s1.event_partition_key AND t.session_name_abr = s1.session_name_abr"""))
def tracking_upsert(spark, folder):
    """The stored table ends in a season that the new schedule starts with; each new row comes in two versions."""
    stored = _tracking(spark, folder).where(F.col("event_year") <= UPSERT_FROM)
    new = t.schedule_sessions(calendar.schedule(spark, folder)).where(F.col("event_year") >= UPSERT_FROM)
    versions = new.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "session_date", F.when(F.col("version") == 2, F.col("session_date")).otherwise("draft")
    )
    merged = t.upsert(stored, versions, "version")
    return merged.select(
        *t.KEYS, "event_year", "session_date", "session_date_utc", "data_loaded",
        "s3_results_location", "s3_laps_location", "s3_live_weather_forecast_location",
    )


@register(with_binding(TRACKING, """
SELECT event_partition_key, session_name_abr,
  CASE WHEN EXISTS (SELECT 1 FROM b_results r WHERE r.event_year = t.event_year AND r.event_number = t.event_number
                    AND r.session = t.session_name_abr)
        AND EXISTS (SELECT 1 FROM b_laps l WHERE l.event_year = t.event_year AND l.event_number = t.event_number
                    AND l.session = t.session_name_abr) THEN TRUE ELSE data_loaded END AS data_loaded
FROM t"""))
def tracking_update(spark, folder):
    """Sessions whose results and laps have both landed are marked as loaded."""
    def keys(df):
        key = F.concat_ws("_", "event_year", F.replace("event_name", F.lit(" "), F.lit("_")))
        return df.select(key.alias("event_partition_key"), F.col("session").alias("session_name_abr"))

    landed = t.landed_sessions(keys(binding.results(spark, folder)), keys(binding.laps(spark, folder)))
    return t.update(_tracking(spark, folder), landed).select(*t.KEYS, "data_loaded")


@register(with_binding(TRACKING, """
SELECT event_year, CAST(count(*) FILTER (WHERE data_loaded) AS BIGINT) AS loaded_sessions, count(*) AS total_sessions,
  CAST(count(*) FILTER (WHERE data_loaded) AS DOUBLE) * 100 / count(*) AS loaded_percent,
  count(DISTINCT event_partition_key) AS events
FROM t GROUP BY 1"""))
def ingest_coverage(spark, folder):
    return t.coverage_by_year(_tracking(spark, folder))


@register(with_binding(TRACKING, """
SELECT event_partition_key, max(event_year) AS event_year, max("EventName") AS "EventName",
  count(*) FILTER (WHERE data_loaded) AS loaded_sessions, count(*) AS total_sessions,
  CASE WHEN count(*) FILTER (WHERE data_loaded) < count(*) THEN 'incomplete' ELSE 'complete' END AS state
FROM t GROUP BY 1"""))
def ingest_by_event(spark, folder):
    return t.coverage_by_event(_tracking(spark, folder))


@register(with_binding(TRACKING, """
SELECT event_year, event_number, t."EventName" AS event_name, event, event_partition_key, session_name_abr AS session,
  session_name, session_date_utc, event_format, is_before_race
FROM t JOIN b_months ON event_name = t."EventName" """))
def dim_sessions(spark, folder):
    return silver.dim_sessions(_tracking(spark, folder), event_slug)


@register(with_binding(TRACKING, """
SELECT event_year, event, event_number, circuit_lat, circuit_lng FROM b_events LEFT JOIN coords USING (event)"""))
def coords_join(spark, folder):
    events = binding.events(spark, folder).select("event_year", "event", "event_number")
    return with_coordinates(events)


@register(with_binding(TRACKING, """
SELECT event_partition_key, event_year, "EventName",
  COALESCE(s3_historical_weather_forecast_location, s3_live_weather_forecast_location) AS s3_key,
  CASE WHEN s3_historical_weather_forecast_location IS NULL THEN 'live' ELSE 'historical' END AS forecast_source
FROM t WHERE session_name_abr = 'R'
  AND COALESCE(s3_historical_weather_forecast_location, s3_live_weather_forecast_location) IS NOT NULL"""))
def forecast_pick(spark, folder):
    return t.forecast_pointers(_tracking(spark, folder))


@register(with_binding(TRACKING, """
SELECT event_partition_key, session_name_abr,
  list_filter([CASE WHEN s3_laps_location IS NULL THEN 's3_laps_location' END,
               CASE WHEN circuit_lat IS NULL THEN 'circuit_lat' END,
               CASE WHEN data_loaded IS NULL THEN 'data_loaded' END], lambda x: x IS NOT NULL).list_aggr('string_agg', ',')
    AS missing
FROM t WHERE s3_laps_location IS NULL OR circuit_lat IS NULL OR data_loaded IS NULL"""))
def required_fields(spark, folder):
    """Rows that lack a required field, with the names of what is missing."""
    missing = absent_fields(["s3_laps_location", "circuit_lat", "data_loaded"])
    rows = _tracking(spark, folder).withColumn("missing", F.array_join(missing, ","))
    return rows.where(F.col("missing") != "").select(*t.KEYS, "missing")


@register(with_binding(TRACKING, "SELECT * FROM w"))
def event_windows(spark, folder):
    return _windows(spark, folder)


@register(with_binding(TRACKING, 'SELECT * EXCLUDE (race_dt_utc) FROM w'))
def qualifying_windows(spark, folder):
    return d.qualifying_windows(_tracking(spark, folder))


@register(with_binding(TRACKING, f"""
SELECT *, CASE WHEN CAST(qualifying_dt_utc AS DATE) < DATE '{NOW[:10]}' THEN 'historical' ELSE 'live' END
  AS forecast_endpoint_mode
FROM w WHERE (qualifying_dt_utc <= TIMESTAMP '{NOW[:10]}' AND race_dt_utc >= TIMESTAMP '{NOW[:10]}')
  OR (qualifying_dt_utc > TIMESTAMP '{NOW[:10]}' AND date_diff('day', DATE '{NOW[:10]}', CAST(race_dt_utc AS DATE)) <= 15)
ORDER BY qualifying_dt_utc > TIMESTAMP '{NOW[:10]}', race_dt_utc, event_partition_key LIMIT 1"""))
def target_window(spark, folder):
    return d.target_window(_windows(spark, folder), NOW)


@register(with_binding(TRACKING, "SELECT * FROM w ORDER BY race_dt_utc, event_partition_key LIMIT 10"))
def alignment_sample(spark, folder):
    return d.first_windows(_windows(spark, folder))


_TIMES = """
SELECT q.event_partition_key, q.event_year, q."EventName", q.session_date_utc AS qualifying_time,
  r.session_date_utc AS race_time, COALESCE(q.data_loaded, FALSE) AS qualifying_loaded
FROM t q JOIN t r ON q.event_partition_key = r.event_partition_key AND r.session_name_abr = 'R'
WHERE q.session_name_abr = 'Q'
"""


@register(with_binding(TRACKING, f"{_TIMES} AND q.session_date_utc > '{NOW}' ORDER BY q.session_date_utc LIMIT 1"))
def upcoming_event(spark, folder):
    return d.upcoming_event(_tracking(spark, folder), NOW)


@register(with_binding(TRACKING, f"""{_TIMES} AND q.session_date_utc > '2001-03-08T00:00:00Z'
  AND q.session_date_utc < '{NOW}' AND r.session_date_utc > '{NOW}' ORDER BY q.session_date_utc LIMIT 1"""))
def prediction_window(spark, folder):
    return d.prediction_window(_tracking(spark, folder), NOW)


@register(with_binding(TRACKING, """
SELECT event_year, event FROM b_events e
WHERE NOT EXISTS (SELECT 1 FROM predicted p WHERE p.event_year = e.event_year AND p.event = e.event)"""))
def prediction_pending(spark, folder):
    events = binding.events(spark, folder).select("event_year", "event")
    return d.pending_predictions(events, calendar.predicted_events(spark, folder))


@register(with_binding(TRACKING, f"""
SELECT event_partition_key, event_year, "EventName", session_date_utc, circuit_lat, circuit_lng FROM t
WHERE session_name_abr = 'R' AND event_format <> 'testing' AND session_date_utc[1:10] <= '{NOW[:10]}'
  AND s3_historical_weather_forecast_location IS NULL"""))
def weather_backlog(spark, folder):
    return d.weather_backlog(_tracking(spark, folder), NOW)


@register(with_binding("", f"""
SELECT event_year, event_name AS "EventName", make_date(event_year, event_number, 20) AS race_date FROM b_events
WHERE event_number NOT IN (2, 11) AND event_year BETWEEN 1997 AND 2001
  AND make_date(event_year, event_number, 20) <= DATE '{NOW[:10]}'"""))
def calendar_filter(spark, folder):
    return d.held_races(t.schedule_sessions(calendar.schedule(spark, folder)), NOW, 1997, 2001)


@register(with_binding(TRACKING, f"""
SELECT event_number AS round, "EventName" AS name, session_date_utc AS date,
  CAST(date_diff('day', DATE '{NOW[:10]}', CAST(session_date_utc[1:10] AS DATE)) AS INTEGER) AS days_until
FROM t WHERE session_name_abr = 'R' AND session_date_utc[1:10] >= '{NOW[:10]}'
ORDER BY session_date_utc LIMIT 3"""))
def next_events(spark, folder):
    return d.next_events(_tracking(spark, folder), NOW)


@register(with_binding(TRACKING, "SELECT max(run_id) AS run_id FROM runs WHERE event_year % 2 = 1"))
def ready_run(spark, folder):
    return d.ready_run(calendar.model_runs(spark, folder), calendar.success_markers(spark, folder))


@register(with_binding(TRACKING, f"""
SELECT n > 0 AS should_ingest,
  CASE WHEN n > 0 THEN 'qualifying is over but not loaded' ELSE 'up to date' END AS ingest_reason,
  predict_reason = 'ready' AS should_predict, predict_reason, model_run_id, event_partition_key,
  n AS late_sessions
FROM (
  SELECT n, run_id AS model_run_id, x.event_partition_key,
    CASE WHEN run_id IS NULL THEN 'no finished model run'
         WHEN x.event_partition_key IS NULL THEN 'no event to predict now'
         WHEN p.event IS NOT NULL THEN 'event was predicted before'
         WHEN NOT qualifying_loaded THEN 'qualifying is not loaded'
         ELSE 'ready' END AS predict_reason
  FROM (SELECT count(*) AS n FROM t WHERE session_name_abr = 'Q' AND session_date_utc <= '{NOW}'
          AND NOT COALESCE(data_loaded, FALSE))
  CROSS JOIN (SELECT max(run_id) AS run_id FROM runs WHERE event_year % 2 = 1)
  LEFT JOIN ({_TIMES} AND q.session_date_utc BETWEEN '2001-03-08T00:00:01Z' AND '{NOW}'
             AND r.session_date_utc > '{NOW}') x ON TRUE
  LEFT JOIN b_months m ON m.event_name = x."EventName"
  LEFT JOIN predicted p ON p.event_year = x.event_year AND p.event = m.event)"""))
def pipeline_decision(spark, folder):
    tracking = _tracking(spark, folder)
    events = tracking.select("event_partition_key", "event_year", event_slug(F.col("EventName")).alias("event"))
    predicted = events.join(calendar.predicted_events(spark, folder), ["event_year", "event"], "left_semi")
    ready = d.ready_run(calendar.model_runs(spark, folder), calendar.success_markers(spark, folder))
    return d.pipeline_decision(tracking, ready, predicted, NOW)
