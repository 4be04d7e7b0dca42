"""Cleaning queries: column functions on raw rows, and the two silver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventrank.catalog.binding_sql import with_binding
from eventrank.catalog.registry import register
from eventrank.functions import text
from eventrank.functions import values as v
from eventrank.plans import silver
from eventrank.sources import binding, bronze
from eventrank.sources.tables import table

RESULT_ID = ["event_year", "event", "session", "driver_number"]
LAP_ID = ["event_year", "event", "session", "driver_number", "lap_number"]

_NAME = """CASE WHEN session = 'R' THEN 'Race' WHEN session = 'Q' THEN 'Qualifying'
    WHEN session = 'S' AND event_year < 1997 THEN 'Sprint Shootout'
    WHEN session = 'S' AND event_year = 1997 THEN 'Sprint Qualifying' WHEN session = 'S' THEN 'Sprint'
    WHEN session = 'SS' THEN 'Sprint Shootout' WHEN session = 'SQ' THEN 'Sprint Qualifying'
    WHEN event_year >= 2000 THEN 'Demo' ELSE 'Practice 1' END"""

_TYPE = """CASE session_name WHEN 'Race' THEN 'race' WHEN 'Qualifying' THEN 'qualifying'
    WHEN 'Sprint Shootout' THEN 'sprint_shootout' WHEN 'Sprint Qualifying' THEN 'sprint_qualifying'
    WHEN 'Sprint' THEN 'sprint' WHEN 'Demo' THEN 'unknown' ELSE 'practice' END"""

# The clean values that the raw rows were made from, with the cells that raw rows spoil set to NULL.
CLEAN_RESULTS = f"""
r0 AS (SELECT *, driver_number + event_number AS k, {_NAME} AS session_name FROM b_results),
r1 AS (
  SELECT *, {_TYPE} AS session_type,
    CASE WHEN k % 5 <> 0 THEN finishing_position END AS finish,
    CASE WHEN NOT (is_retired AND k % 4 = 0) AND k % 13 <> 0 THEN finishing_position END AS classified,
    CASE WHEN k % 6 <> 0 THEN grid_starting_position END AS grid,
    finishing_position IS NULL OR (is_retired AND k % 4 = 0) AS retired,
    CASE WHEN k % 8 = 0 THEN NULL WHEN k % 9 = 0 THEN 0 ELSE laps END AS lap_count,
    CASE WHEN k % 10 = 0 THEN NULL WHEN is_retired THEN 'Accident' ELSE 'Finished' END AS status,
    CASE WHEN k % 11 <> 0 THEN points END AS score
  FROM r0),
"""

CLEAN_LAPS = f"""
l0 AS (
  SELECT *, lap_number + driver_number + CAST(speed_st AS INTEGER) AS k, {_NAME} AS session_name,
    CAST(round(sector1_time_seconds * 1000) AS BIGINT) AS s1, CAST(round(sector2_time_seconds * 1000) AS BIGINT) AS s2,
    CAST(round(sector3_time_seconds * 1000) AS BIGINT) AS raw3
  FROM b_laps),
l1 AS (
  SELECT *, {_TYPE} AS kind, raw3 + CASE WHEN k % 9 = 0 THEN 200 ELSE 0 END AS s3,
    k % 10 IN (0, 1) AS pit,
    CASE WHEN k % 10 = 0 THEN 5400.1E0 END AS pit_in, CASE WHEN k % 10 = 1 THEN 5500.2E0 END AS pit_out
  FROM l0),
l2 AS (
  SELECT *, (COALESCE(s1, 0) + s2 + s3) / 1000E0 AS total,
    s1 IS NOT NULL AND lap_ms IS NOT NULL AND abs(s1 + s2 + s3 - lap_ms) > 100 AS mismatch
  FROM l1),
"""

_FLAGS = """session_type = 'practice' AS is_practice, session_type = 'qualifying' AS is_qualifying,
  session_type = 'sprint_qualifying' AS is_sprint_qualifying, session_type = 'sprint_shootout' AS is_sprint_shootout,
  session_type = 'race' AS is_race, session_type IN ('sprint', 'sprint_qualifying', 'sprint_shootout') AS is_sprint"""

_COMPLETE = """q1_seconds IS NOT NULL AND q2_seconds IS NOT NULL AND q3_seconds IS NOT NULL AS has_complete_qualifying_data,
  q1_seconds IS NOT NULL OR q2_seconds IS NOT NULL OR q3_seconds IS NOT NULL AS has_qualifying_data,
  time_seconds IS NOT NULL AND status IS NOT NULL AND lap_count IS NOT NULL AS has_complete_race_data,
  time_seconds IS NOT NULL OR status IS NOT NULL OR COALESCE(lap_count > 0, FALSE) AS has_race_data"""

_ID = ", ".join(RESULT_ID)


def _results(spark, folder):
    return silver.silver_results(bronze.bronze_results(spark, folder))


def _laps(spark, folder):
    return silver.silver_laps(bronze.bronze_laps(spark, folder))


def _raw_results(spark, folder):
    """Raw rows with names and tokens cleared, not yet typed."""
    return silver.bronze_rows(bronze.bronze_results(spark, folder)).withColumn(
        "driver_number", F.col("driver_number").cast("int")
    )


@register(with_binding(CLEAN_LAPS, """
SELECT event_year, event_name, session_name, kind AS session_type, session,
  'D' || lpad(CAST(driver_number AS VARCHAR), 2, '0') AS driver, driver_number, 'Team ' || (driver_number % 10) AS team,
  lap_number, CASE WHEN k % 7 <> 0 THEN lap_number % 3 + 1 END AS stint,
  (lap_ms + 3600000) / 1000E0 AS time_seconds, lap_time_seconds, lap_number * 100E0 AS lap_start_time_seconds,
  sector1_time_seconds, sector2_time_seconds, s3 / 1000E0 AS sector3_time_seconds,
  total AS total_sector_time_seconds, mismatch AS sector_time_mismatch,
  pit_in AS pit_in_time_seconds, pit_out AS pit_out_time_seconds, pit AS is_pit_lap,
  speed_fl + 1 AS speed_i1, speed_fl AS speed_i2, speed_fl, speed_st, compound,
  CASE WHEN k % 5 <> 0 THEN CAST(speed_st AS INTEGER) END AS tyre_life, k % 3 = 0 AS fresh_tyre,
  CASE WHEN k % 11 <> 0 THEN lap_number END AS position,
  CASE WHEN k % 13 = 0 THEN NULL WHEN k % 2 = 0 THEN 12 ELSE 1 END AS track_status,
  CASE WHEN k % 4 <> 0 THEN k % 2 = 0 END AS is_personal_best, is_accurate, deleted, k % 6 = 0 AS fastf1_generated,
  CASE WHEN k % 17 <> 0 THEN make_timestamp(event_year, event_number, 5, 12, 0, 0) END AS lap_start_date,
  lap_number * 10E0 + 1 AS sector1_session_time_seconds, lap_number * 10E0 + 2 AS sector2_session_time_seconds,
  lap_number * 10E0 + 3 AS sector3_session_time_seconds,
  CASE WHEN deleted THEN 'track limits' END AS deleted_reason, event
FROM l2"""))
def silver_laps(spark, folder):
    return _laps(spark, folder)


@register(with_binding(CLEAN_RESULTS, f"""
SELECT event_year, event_name, event, session_name, session, session_type, {_FLAGS},
  driver_number, driver_id, full_name, 'Driver' AS first_name,
  CASE WHEN k % 7 <> 0 THEN CAST(driver_number AS VARCHAR) END AS last_name, 'D ' || driver_number AS broadcast_name,
  abbreviation, CASE WHEN k % 3 <> 0 THEN 'C1' END AS country_code, team_id, team_name, team_color,
  finish AS finishing_position, classified AS classified_position, grid AS grid_starting_position,
  CASE WHEN session_type = 'race' THEN grid - finish END AS position_change, retired AS is_retired,
  classified IS NOT NULL AS is_classified, q1_seconds, q2_seconds, q3_seconds, {_COMPLETE}, time_seconds, status,
  lap_count AS laps, score AS points, CASE WHEN k % 2 <> 0 THEN 'http://x' END AS headshot_url
FROM r1"""))
def silver_results(spark, folder):
    return _results(spark, folder)


@register("""
SELECT p_partkey, regexp_replace(regexp_replace(name, '(.)([A-Z][a-z]+)', '\\1_\\2', 'g'),
    '([a-z0-9])([A-Z])', '\\1_\\2', 'g').lower() AS snake
FROM (SELECT p_partkey, 'My' || upper(substr(p_name, 1, 1)) || replace(substr(p_name, 2), ' ', 'X') || p_size || p_type
        || 'Ab_seconds' AS name FROM part)""")
def snake_case(spark, folder):
    part = table(spark, folder, "part")
    name = F.concat(
        F.lit("My"), F.upper(F.substring("p_name", 1, 1)), F.expr("replace(substr(p_name, 2), ' ', 'X')"),
        F.col("p_size").cast("string"), F.col("p_type"), F.lit("Ab_seconds"),
    )
    return part.select("p_partkey", text.snake_case(name).alias("snake"))


@register(with_binding("", "SELECT event_year, event_number, event FROM b_events"))
def event_slug(spark, folder):
    named = binding.events(spark, folder)
    return named.select("event_year", "event_number", text.event_slug(F.col("event_name")).alias("event"))


@register(with_binding("", """
SELECT event_year, event_number, event_year || '_' || replace(event_name, ' ', '_') AS event_partition_key,
  event_year AS key_year, event_name AS key_name
FROM b_events"""))
def event_key(spark, folder):
    key = text.event_key(F.col("event_year"), F.col("event_name"))
    keyed = binding.events(spark, folder).withColumn("event_partition_key", key)
    back = F.col("event_partition_key")
    return keyed.select(
        "event_year", "event_number", "event_partition_key",
        text.event_key_year(back).alias("key_year"), text.event_key_name(back).alias("key_name"),
    )


@register(with_binding(CLEAN_RESULTS, f"""
SELECT {_ID}, CASE WHEN k % 7 <> 0 THEN CAST(driver_number AS VARCHAR) END AS last_name,
  CASE WHEN k % 3 <> 0 THEN 'C1' END AS country_code, CASE WHEN k % 2 <> 0 THEN 'http://x' END AS headshot_url
FROM r1"""))
def null_tokens(spark, folder):
    return _raw_results(spark, folder).select(*RESULT_ID, "last_name", "country_code", "headshot_url")


@register(with_binding(CLEAN_LAPS, """
SELECT event_year, event, session, driver_number, lap_number, CASE WHEN k % 4 <> 0 THEN k % 2 = 0 END AS is_personal_best,
  k % 3 = 0 AS fresh_tyre, deleted
FROM l2"""))
def bool_parse(spark, folder):
    raw = bronze.bronze_laps(spark, folder)
    return raw.select(
        "event_year", "event", "session",
        v.to_int(F.col("DriverNumber")).alias("driver_number"), v.to_int(F.col("LapNumber")).alias("lap_number"),
        v.parse_bool(F.col("IsPersonalBest")).alias("is_personal_best"),
        v.parse_bool(F.col("FreshTyre")).alias("fresh_tyre"),
        v.parse_bool(F.col("Deleted")).alias("deleted"),
    )


@register(with_binding(CLEAN_RESULTS, f"""
SELECT {_ID}, finish AS position, CAST(grid AS BIGINT) AS grid_position, lap_count AS laps, score AS points FROM r1"""))
def safe_cast(spark, folder):
    return _raw_results(spark, folder).select(
        *RESULT_ID,
        v.to_int(F.col("position")).alias("position"),
        v.to_long(F.col("grid_position")).alias("grid_position"),
        v.to_int(F.col("laps")).alias("laps"),
        v.to_double(F.col("points")).alias("points"),
    )


@register(with_binding(CLEAN_RESULTS, f"SELECT {_ID}, session_type FROM r1"))
def session_type(spark, folder):
    raw = _raw_results(spark, folder)
    return raw.select(*RESULT_ID, text.session_type(F.col("session_name")).alias("session_type"))


@register(with_binding(CLEAN_RESULTS, f"""
SELECT {_ID}, CASE session_name WHEN 'Practice 1' THEN 'P1' WHEN 'Qualifying' THEN 'Q' WHEN 'Sprint Qualifying' THEN 'SQ'
    WHEN 'Sprint Shootout' THEN 'SS' WHEN 'Sprint' THEN 'S' WHEN 'Race' THEN 'R' ELSE 'D' END AS session_name_abr,
  CASE session_type WHEN 'sprint_qualifying' THEN 'SQ' WHEN 'sprint_shootout' THEN 'SS' WHEN 'sprint' THEN 'S'
    ELSE 'Q' END AS prediction_session
FROM r1"""))
def session_abbr(spark, folder):
    raw = _raw_results(spark, folder)
    name = F.col("session_name")
    return raw.select(
        *RESULT_ID,
        text.session_abbreviation(name).alias("session_name_abr"),
        text.prediction_session(text.session_type(name)).alias("prediction_session"),
    )


@register(with_binding(CLEAN_RESULTS, f"SELECT {_ID}, {_FLAGS} FROM r1"))
def session_flags(spark, folder):
    flags = silver.session_flags(text.session_type(F.col("session_name")))
    return _raw_results(spark, folder).select(*RESULT_ID, *[c.alias(n) for n, c in flags.items()])


@register(with_binding(CLEAN_RESULTS, f"""
SELECT {_ID}, retired AS is_retired, finish AS finishing_position, classified AS classified_position,
  classified IS NOT NULL AS is_classified FROM r1"""))
def position_clean(spark, folder):
    columns = silver.position_columns(F.col("position"), F.col("classified_position"))
    return _raw_results(spark, folder).select(*RESULT_ID, *[c.alias(n) for n, c in columns.items()])


@register(with_binding(CLEAN_RESULTS, f"""
SELECT {_ID}, CASE WHEN session_type = 'race' THEN grid - finish END AS position_change FROM r1"""))
def position_change(spark, folder):
    return _results(spark, folder).select(*RESULT_ID, "position_change")


@register(with_binding(CLEAN_RESULTS, f"SELECT {_ID}, {_COMPLETE} FROM r1"))
def completeness_flags(spark, folder):
    return _results(spark, folder).select(*RESULT_ID, *silver.completeness_flags())


@register(with_binding(CLEAN_LAPS, f"""
SELECT {', '.join(LAP_ID)}, total AS total_sector_time_seconds, mismatch AS sector_time_mismatch FROM l2"""))
def sector_check(spark, folder):
    return _laps(spark, folder).select(*LAP_ID, "total_sector_time_seconds", "sector_time_mismatch")


@register(with_binding(CLEAN_LAPS, """
SELECT event_year, event, count(*) AS laps, CAST(sum(CASE WHEN mismatch THEN 1 ELSE 0 END) AS BIGINT) AS mismatches
FROM l2 GROUP BY 1, 2"""))
def sector_mismatch_count(spark, folder):
    return _laps(spark, folder).groupBy("event_year", "event").agg(
        F.count(F.lit(1)).alias("laps"), F.count_if(F.col("sector_time_mismatch")).alias("mismatches")
    )


@register(with_binding(CLEAN_LAPS, f"SELECT {', '.join(LAP_ID)}, pit AS is_pit_lap FROM l2"))
def pit_lap(spark, folder):
    return _laps(spark, folder).select(*LAP_ID, "is_pit_lap")


@register(with_binding(CLEAN_LAPS, f"""
SELECT {', '.join(LAP_ID)}, lap_time_seconds, (lap_ms + 3600000) / 1000E0 AS time_seconds,
  s3 / 1000E0 AS sector3_time_seconds
FROM l2"""))
def round_ms(spark, folder):
    return _laps(spark, folder).select(*LAP_ID, "lap_time_seconds", "time_seconds", "sector3_time_seconds")


@register("""
SELECT l_orderkey, l_partkey, l_linenumber, CAST(round(l_extendedprice * 1000) AS BIGINT) * 1000000 / 1000000000E0 AS seconds
FROM lineitem""")
def duration_seconds(spark, folder):
    """Prices read as durations in nanoseconds."""
    nanos = F.round(F.col("l_extendedprice") * 1000).cast("bigint") * 1000000
    seconds = v.duration_seconds(nanos).alias("seconds")
    return table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", seconds)


@register("""
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS utc,
  strftime(date_trunc('second', ts) - INTERVAL 11 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS from_zone,
  CAST(NULL AS VARCHAR) AS from_noise
FROM events""")
def iso_utc(spark, folder):
    """Texts with Z, with an offset and with no time at all are read back and written as UTC."""
    second = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    forms = {
        "utc": F.concat(second, F.lit("Z")), "from_zone": F.concat(second, F.lit("+11:00")),
        "from_noise": F.concat(F.lit("at "), second),
    }
    return table(spark, folder, "events").select(
        "event_id", *[v.format_utc(v.parse_utc(c)).alias(name) for name, c in forms.items()]
    )


@register("""
SELECT event_id, CAST(trunc(epoch_us(date_trunc('hour', ts)) / 60e6 - epoch_us(ts) / 60e6) AS INTEGER) AS back,
  CAST(trunc((epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 60e6) AS INTEGER) AS ahead,
  CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS days
FROM events""")
def minute_offset(spark, folder):
    ts = F.col("ts")
    hour, day = (F.date_trunc(unit, ts).cast("timestamp_ntz") for unit in ("hour", "day"))
    return table(spark, folder, "events").select(
        "event_id", v.minute_offset(hour, ts).alias("back"), v.minute_offset(ts, day).alias("ahead"),
        F.datediff(ts, F.lit("2024-01-01")).alias("days"),
    )
