"""Feature queries: targets, pace, history, gold and training set."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventrank.catalog.binding_sql import with_binding
from eventrank.catalog.registry import register
from eventrank.functions.values import is_wet, valid_lap
from eventrank.operators import events as ev
from eventrank.operators import history, pace
from eventrank.plans import gold
from eventrank.schemas import DRIVER_EVENT_KEYS, EVENT_KEYS
from eventrank.sources import binding, lake
from eventrank.sources.session import scratch_folder, stored

FILTER_YEAR, FILTER_EVENT = 1998, "monaco"

LAP_VIEW = ["event_year", "event", "session", "driver_number", "lap_number", "lap_time_seconds"]

# One row per weekend with the moments of its sessions, and one per driver who took part in qualifying.
ENTRIES = """
weekend AS (
  SELECT event_year, event, max(event_number) FILTER (WHERE session = 'Q') AS target_event_number,
    max(session_date_utc) FILTER (WHERE session = 'Q') AS qualifying_session_date_utc,
    max(session_date_utc) FILTER (WHERE session IN ('SQ', 'SS')) AS sprint_qualifying_session_date_utc,
    bool_or(session IN ('SQ', 'SS')) AS is_sprint_weekend
  FROM b_dim GROUP BY event_year, event),
entry AS (
  SELECT b_results.* EXCLUDE (event_number, session, finishing_position, grid_starting_position, is_retired, points,
      time_seconds, laps),
    finishing_position AS qualifying_position, target_event_number, qualifying_session_date_utc,
    sprint_qualifying_session_date_utc, coalesce(is_sprint_weekend, FALSE) AS is_sprint_weekend
  FROM b_results LEFT JOIN weekend USING (event_year, event) WHERE session = 'Q'),
"""

_MEAN = "CAST(sum(lap_ms) AS DOUBLE) / (count(*) * 1000E0)"
_STD = (
    "CASE WHEN count(*) > 1 THEN sqrt(CAST(count(*) * sum(CAST(lap_ms AS HUGEINT) * lap_ms)"
    " - sum(lap_ms) * sum(lap_ms) AS DOUBLE) / (CAST(count(*) AS DOUBLE) * (count(*) - 1))) / 1000 END"
)


def _pace_sql(prefix: str, where: str, full: bool) -> str:
    columns = [
        f"min(lap_time_seconds) AS {prefix}_best_lap_time_seconds",
        f"median(lap_ms) / 1000E0 AS {prefix}_median_lap_time_seconds",
    ]
    if full:
        columns += [f"min(sector{i}_time_seconds) AS {prefix}_best_sector{i}_time_seconds" for i in (1, 2, 3)]
        columns += [f"max({c}) AS {prefix}_max_{c}" for c in ("speed_fl", "speed_st")]
    if prefix == "practice":
        columns += [
            "count(*) AS practice_laps_count",
            f"{_MEAN} AS practice_mean_lap_time_seconds",
            f"{_STD} AS practice_std_lap_time_seconds",
        ]
        columns += [
            f"min(lap_time_seconds) FILTER (WHERE compound = '{c}') AS practice_best_{c.lower()}_lap_time_seconds"
            for c in pace.COMPOUNDS
        ]
    keys = ", ".join(DRIVER_EVENT_KEYS)
    return f"SELECT {keys}, {', '.join(columns)} FROM b_valid WHERE {where} GROUP BY {keys}"


PRACTICE = _pace_sql("practice", "session = 'P1'", True)
QUALIFYING = _pace_sql("qualifying", "session = 'Q'", False)
SPRINT = _pace_sql("sprint_qualifying", "session IN ('SQ', 'SS')", True)

# Entries and outcomes of a season on one axis of time; the frame ends before the entry's own moment.
FORM = """
moment AS (
  SELECT event_year, event, driver_number, qualifying_session_date_utc AS moment, NULL::DECIMAL(18,4) AS points,
    NULL::INTEGER AS finish, NULL::INTEGER AS retired, FALSE AS scores, FALSE AS races, TRUE AS asks
  FROM entry
  UNION ALL
  SELECT event_year, event, driver_number, b_dim.session_date_utc, CAST(points AS DECIMAL(18,4)), finishing_position,
    is_retired::INTEGER, TRUE, session = 'R', FALSE
  FROM b_results JOIN b_dim USING (event_year, event, session) WHERE session IN ('R', 'S')),
along AS (
  SELECT *, sum(points) OVER past AS points_so_far, count(*) FILTER (WHERE scores) OVER past AS outcomes,
    (list(points) FILTER (WHERE races) OVER past)[-3:] AS recent_points,
    (list(finish) FILTER (WHERE races) OVER past)[-3:] AS recent_finishes,
    (list(retired) FILTER (WHERE races) OVER past)[-3:] AS recent_retirements
  FROM moment
  WINDOW past AS (PARTITION BY event_year, driver_number ORDER BY moment
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP)),
form AS (
  SELECT event_year, event, driver_number, CASE WHEN outcomes > 0 THEN CAST(points_so_far AS DOUBLE) END AS season_points_to_date,
    CAST(list_sum(recent_points) AS DOUBLE) AS last3_race_points, list_avg(recent_finishes) AS last3_avg_finish,
    CAST(list_sum(recent_retirements) AS BIGINT) AS last3_dnfs,
    CASE WHEN len(recent_points) > 0 THEN CAST(len(recent_points) AS BIGINT) END AS last3_race_count
  FROM along WHERE asks),
"""

# Sums of each year at one place, and a frame over the three years before.
VENUE = """
yearly AS (
  SELECT event, driver_number, event_year, FALSE AS asks, sum(finishing_position) AS places, count(finishing_position) AS placed,
    sum(CAST(points AS DECIMAL(18,4))) AS points, count(*) AS starts, 0::HUGEINT AS ms, 0::HUGEINT AS ms2, 0 AS laps
  FROM b_results SEMI JOIN weekend USING (event_year, event) WHERE session = 'R' GROUP BY event, driver_number, event_year
  UNION ALL
  SELECT event, driver_number, event_year, FALSE, 0, 0, 0, 0, sum(lap_ms), sum(CAST(lap_ms AS HUGEINT) * lap_ms), count(*)
  FROM b_valid SEMI JOIN weekend USING (event_year, event) WHERE session = 'R' GROUP BY event, driver_number, event_year
  UNION ALL
  SELECT event, driver_number, event_year, TRUE, 0, 0, 0, 0, 0, 0, 0 FROM entry),
before AS (
  SELECT event, driver_number, event_year, asks, sum(places) OVER w AS places, sum(placed) OVER w AS placed,
    sum(points) OVER w AS points, sum(starts) OVER w AS starts, sum(ms) OVER w AS ms, sum(ms2) OVER w AS ms2,
    sum(laps) OVER w AS laps
  FROM yearly
  WINDOW w AS (PARTITION BY event, driver_number ORDER BY event_year RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING)),
venue AS (
  SELECT event_year, event, driver_number,
    CASE WHEN placed > 0 THEN CAST(places AS DOUBLE) / placed END AS circuit_last3y_avg_finish,
    CASE WHEN starts > 0 THEN CAST(points AS DOUBLE) / starts END AS circuit_last3y_avg_points,
    CASE WHEN starts > 0 THEN CAST(starts AS BIGINT) END AS circuit_last3y_race_count,
    CASE WHEN laps > 0 THEN CAST(ms AS DOUBLE) / (laps * 1000E0) END AS hist_avg_race_lap_time,
    CASE WHEN laps > 1 THEN round(sqrt(CAST(laps * ms2 - ms * ms AS DOUBLE) / (CAST(laps AS DOUBLE) * (laps - 1))) / 1000, 6)
      END AS hist_race_lap_time_std,
    CASE WHEN laps > 0 THEN CAST(laps AS BIGINT) END AS hist_race_laps_count
  FROM before WHERE asks),
"""

GOLD_STEPS = ENTRIES + FORM + VENUE + f"""
in_practice AS ({PRACTICE}), in_qualifying AS ({QUALIFYING}), in_sprint_qualifying AS ({SPRINT}),
gold AS (
  SELECT * EXCLUDE (precipitation_sum_mm), coalesce(precipitation_sum_mm, 0) >= 1.0 AS is_wet_race
  FROM entry
  LEFT JOIN form USING (event_year, event, driver_number)
  LEFT JOIN venue USING (event_year, event, driver_number)
  LEFT JOIN in_practice USING (event_year, event, driver_number)
  LEFT JOIN in_qualifying USING (event_year, event, driver_number)
  LEFT JOIN in_sprint_qualifying USING (event_year, event, driver_number)
  LEFT JOIN b_weather USING (event_year, event)),
"""

TRAINING_STEPS = GOLD_STEPS + """
outcome AS (
  SELECT event_year, event, driver_number, max(finishing_position) AS race_finishing_position,
    max(time_seconds) AS race_time_seconds
  FROM b_results WHERE session = 'R' GROUP BY event_year, event, driver_number),
training AS (SELECT * FROM gold LEFT JOIN outcome USING (event_year, event, driver_number)),
"""

_ROUND_STD = "* REPLACE (round(practice_std_lap_time_seconds, 6) AS practice_std_lap_time_seconds)"


def rounded(df, *names):
    """Square roots are compared at six decimals; everything else is exact."""
    return df.withColumns({c: F.round(c, 6) for c in names})


def bound_targets(spark, folder):
    return ev.driver_targets(ev.qualifying_targets(binding.results(spark, folder)), binding.sessions(spark, folder))


def silver(spark, folder):
    """Results, which gold reads in several places, are stored and give the events of the calendar, too; weather is read once."""
    results = stored(binding.results(spark, folder), "results")
    events = results.select("event_year", "event_number", "event", "event_name").distinct()
    return {"results": results, "sessions": binding.sessions(spark, folder, events), "weather": binding.weather(spark, folder)}


def bound_gold(spark, folder, tables=None, **limits):
    tables = tables or silver(spark, folder)
    df = gold.gold_features(tables["results"], binding.laps(spark, folder), tables["sessions"], tables["weather"], **limits)
    return rounded(df, "practice_std_lap_time_seconds", "hist_race_lap_time_std")


def bound_training(spark, folder):
    tables = silver(spark, folder)
    return gold.training_dataset(bound_gold(spark, folder, tables), tables["results"])


@register(with_binding(ENTRIES, "SELECT * FROM entry"))
def driver_targets(spark, folder):
    return bound_targets(spark, folder)


@register(with_binding(ENTRIES, """
SELECT DISTINCT event_year, event, event_name, target_event_number, qualifying_session_date_utc,
  sprint_qualifying_session_date_utc, is_sprint_weekend
FROM entry"""))
def target_events(spark, folder):
    targets = ev.qualifying_targets(binding.results(spark, folder))
    return ev.target_events(targets, binding.sessions(spark, folder))


@register(with_binding(ENTRIES, """
SELECT * EXCLUDE (target_event_number, qualifying_session_date_utc, sprint_qualifying_session_date_utc, is_sprint_weekend)
FROM entry"""))
def target_projection(spark, folder):
    return ev.qualifying_targets(binding.results(spark, folder))


@register(with_binding("", "SELECT DISTINCT event_year, event, event_name FROM b_results WHERE session = 'Q'"))
def distinct_events(spark, folder):
    return ev.distinct_events(ev.select_sessions(binding.results(spark, folder), "Q"))


@register(with_binding(GOLD_STEPS, f"""
SELECT {_ROUND_STD} FROM gold WHERE event_year = {FILTER_YEAR} AND event = '{FILTER_EVENT}'"""))
def target_filter(spark, folder):
    """Only the targets are limited: the history columns equal those of the unlimited run."""
    return bound_gold(spark, folder, event_year=FILTER_YEAR, event=FILTER_EVENT)


@register(with_binding("", """
SELECT event_year, event, session, driver_number, finishing_position FROM b_results WHERE session IN ('Q', 'R', 'S')"""))
def session_select(spark, folder):
    chosen = ev.select_sessions(binding.results(spark, folder), "Q", "R", "S")
    return chosen.select("event_year", "event", "session", "driver_number", "finishing_position")


@register(with_binding("", f"SELECT {', '.join(LAP_VIEW)} FROM b_valid"))
def valid_laps(spark, folder):
    return binding.laps(spark, folder).where(valid_lap()).select(*LAP_VIEW)


@register(with_binding("", """
SELECT e.event_year, e.event, COALESCE(precipitation_sum_mm, 0) >= 1.0 AS is_wet_race
FROM b_events e LEFT JOIN b_weather w USING (event_year, event)"""))
def wet_flag(spark, folder):
    joined = binding.events(spark, folder).join(binding.weather(spark, folder), ["event_year", "event"], "left")
    return joined.select("event_year", "event", is_wet(F.col("precipitation_sum_mm")).alias("is_wet_race"))


@register(with_binding("", f"SELECT {_ROUND_STD} FROM ({PRACTICE})"))
def practice_pace(spark, folder):
    return rounded(pace.practice_pace(binding.laps(spark, folder)), "practice_std_lap_time_seconds")


@register(with_binding("", """
SELECT event_year, event, driver_number,
  min(lap_time_seconds) FILTER (WHERE compound = 'SOFT') AS best_soft_lap_time_seconds,
  min(lap_time_seconds) FILTER (WHERE compound = 'MEDIUM') AS best_medium_lap_time_seconds,
  min(lap_time_seconds) FILTER (WHERE compound = 'HARD') AS best_hard_lap_time_seconds
FROM b_valid WHERE session = 'P1' GROUP BY 1, 2, 3"""))
def compound_best(spark, folder):
    return pace.compound_best(binding.laps(spark, folder))


@register(with_binding("", QUALIFYING))
def qualifying_pace(spark, folder):
    return pace.qualifying_pace(binding.laps(spark, folder))


@register(with_binding("", SPRINT))
def sprint_qualifying_pace(spark, folder):
    return pace.sprint_qualifying_pace(binding.laps(spark, folder))


def bound_form(spark, folder):
    return history.season_form(
        bound_targets(spark, folder), binding.results(spark, folder), binding.sessions(spark, folder)
    )


@register(with_binding(ENTRIES + FORM, """
SELECT event_year, event, driver_number, season_points_to_date FROM form WHERE season_points_to_date IS NOT NULL"""))
def season_points_to_date(spark, folder):
    column = "season_points_to_date"
    return bound_form(spark, folder).select(*DRIVER_EVENT_KEYS, column).dropna(subset=[column])


@register(with_binding(ENTRIES + FORM, "SELECT * EXCLUDE (season_points_to_date) FROM form WHERE last3_race_count IS NOT NULL"))
def last3_form(spark, folder):
    columns = ["last3_race_points", "last3_avg_finish", "last3_dnfs", "last3_race_count"]
    return bound_form(spark, folder).select(*DRIVER_EVENT_KEYS, *columns).dropna(subset=["last3_race_count"])


@register(with_binding(ENTRIES + VENUE, """
SELECT event_year, event, driver_number, circuit_last3y_avg_finish, circuit_last3y_avg_points, circuit_last3y_race_count
FROM venue WHERE circuit_last3y_race_count IS NOT NULL"""))
def circuit_last3y(spark, folder):
    return history.venue_results(
        bound_targets(spark, folder), binding.results(spark, folder), binding.sessions(spark, folder)
    )


@register(with_binding(ENTRIES + VENUE, """
SELECT event_year, event, driver_number, hist_avg_race_lap_time, hist_race_lap_time_std, hist_race_laps_count
FROM venue WHERE hist_race_laps_count IS NOT NULL"""))
def race_pace_hist(spark, folder):
    past = history.race_pace_history(
        bound_targets(spark, folder), binding.laps(spark, folder), binding.sessions(spark, folder)
    )
    return rounded(past, "hist_race_lap_time_std")


@register(with_binding(ENTRIES, """
SELECT event_year, event, driver_number, coalesce(precipitation_sum_mm, 0) >= 1.0 AS is_wet_race, temperature_max_c,
  temperature_min_c, wind_speed_max_kmh
FROM entry LEFT JOIN b_weather USING (event_year, event)"""))
def weather_join(spark, folder):
    targets = bound_targets(spark, folder).select(*DRIVER_EVENT_KEYS)
    return ev.with_weather(targets, binding.weather(spark, folder))


@register(with_binding(GOLD_STEPS, f"SELECT {_ROUND_STD} FROM gold"))
def gold_features(spark, folder):
    return bound_gold(spark, folder)


@register(with_binding(TRAINING_STEPS, f"SELECT {_ROUND_STD} FROM training"))
def training_dataset(spark, folder):
    return bound_training(spark, folder)


def by_season(df):
    """``df`` stored in a folder a season, so that a delivery reads the seasons that it looks back on."""
    path = scratch_folder(df.sparkSession, "seasons")
    df.write.partitionBy("event_year").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


# Last seasons of three deliveries.
DELIVERED = (1996, 1998, 9999)


@register(with_binding(GOLD_STEPS, f"SELECT {_ROUND_STD} FROM gold"))
def gold_incremental(spark, folder):
    """The feature table kept up to date through three deliveries of seasons; each rewrites the events that it affects."""
    tables, laps = silver(spark, folder), by_season(binding.laps(spark, folder))
    tables["weather"] = stored(tables["weather"], "weather")
    path, first = scratch_folder(spark, "gold"), 0
    for last in DELIVERED:
        there = F.col("event_year") <= last
        now = {name: df.where(there) for name, df in tables.items()}
        changed = now["sessions"].where(F.col("event_year") > first)
        rows = gold.gold_update(now["results"], laps.where(there), now["sessions"], now["weather"], changed)
        lake.write_partitioned(rows, path, EVENT_KEYS, whole=False)
        first = last
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    found = lake.read_partitioned(spark, path, schema, EVENT_KEYS)
    return rounded(found, "practice_std_lap_time_seconds", "hist_race_lap_time_std")
