"""Events, their sessions, and the targets to describe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrank.functions.values import is_wet, whole
from eventrank.schemas import DRIVER_EVENT_KEYS, EVENT_KEYS, QUALIFYING_COLUMNS, SESSION_KEYS, TARGET_COLUMNS

SPRINT_QUALIFYING = ["SQ", "SS"]


def select_sessions(df: DataFrame, *names: str) -> DataFrame:
    return df.where(F.col("session").isin(*names))


def target_filter(df: DataFrame, event_year: int | None = None, event: str | None = None) -> DataFrame:
    """Limit the rows that get features. History inputs must not go through this."""
    if event_year is not None:
        df = df.where(F.col("event_year") == int(event_year))
    if event is not None:
        df = df.where(F.col("event") == F.lit(event))
    return df


def qualifying_targets(results: DataFrame) -> DataFrame:
    """One row per driver in qualifying; the finishing position there is the qualifying position."""
    return select_sessions(results, "Q").select(
        whole(results, "event_year"),
        "event",
        "event_name",
        whole(results, "driver_number"),
        *TARGET_COLUMNS[4:],
        whole(results, "finishing_position").alias("qualifying_position"),
        *QUALIFYING_COLUMNS[1:],
    )


def distinct_events(df: DataFrame) -> DataFrame:
    return df.select(*EVENT_KEYS, "event_name").distinct()


def session_dates(sessions: DataFrame) -> DataFrame:
    """One row per (year, event, session), so that a repeated calendar row cannot multiply results."""
    return sessions.groupBy(*SESSION_KEYS).agg(
        F.max("event_number").alias("event_number"), F.max("session_date_utc").alias("session_date_utc")
    )


def event_calendar(sessions: DataFrame) -> DataFrame:
    """One row per event with the dates of its qualifying sessions and whether it has a race."""
    session, date = F.col("session"), F.col("session_date_utc")
    sprint_dates = [F.max(F.when(session == s, date)) for s in SPRINT_QUALIFYING]
    return (
        sessions.where(session.isin("Q", "R", *SPRINT_QUALIFYING))
        .groupBy(*EVENT_KEYS)
        .agg(
            F.max(F.when(session == "Q", F.col("event_number"))).alias("target_event_number"),
            F.max(F.when(session == "Q", date)).alias("qualifying_session_date_utc"),
            F.coalesce(*sprint_dates).alias("sprint_qualifying_session_date_utc"),
            F.max(session == "R").alias("has_race"),
        )
    )


def with_calendar(df: DataFrame, sessions: DataFrame) -> DataFrame:
    return df.join(event_calendar(sessions), EVENT_KEYS, "left").withColumn(
        "is_sprint_weekend", F.col("sprint_qualifying_session_date_utc").isNotNull()
    )


def target_events(targets: DataFrame, sessions: DataFrame) -> DataFrame:
    return with_calendar(distinct_events(targets), sessions).drop("has_race")


def driver_targets(targets: DataFrame, sessions: DataFrame) -> DataFrame:
    """Targets with the dates of their event; the calendar is joined as is, without listing the events first."""
    return with_calendar(targets, sessions).drop("has_race")


def with_weather(df: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather of the event; an event without weather counts as dry and has NULL measures."""
    measures = ["temperature_max_c", "temperature_min_c", "wind_speed_max_kmh"]
    joined = df.join(weather.select(*EVENT_KEYS, "precipitation_sum_mm", *measures), EVENT_KEYS, "left")
    wet = is_wet(F.col("precipitation_sum_mm")).alias("is_wet_race")
    return joined.select(*df.columns, wet, *measures)


def duplicate_keys(df: DataFrame, keys: list[str] = DRIVER_EVENT_KEYS) -> DataFrame:
    """Keys that occur more than once; empty for a sound table."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
