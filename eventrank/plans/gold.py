"""Silver tables to one feature row per target, and to the labelled training set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrank.functions.values import whole
from eventrank.operators.events import (
    qualifying_targets,
    select_sessions,
    target_filter,
    with_weather,
)
from eventrank.operators.history import (
    LAP_SUMS,
    RESULT_SUMS,
    YEARS_BACK,
    past_sums,
    race_result_sums,
    season_form,
    venue_columns,
)
from eventrank.operators.pace import pace_summary, race_pace_columns
from eventrank.schemas import DRIVER_EVENT_KEYS, EVENT_KEYS
from eventrank.sources.session import stored

PACE_GROUPS = ["practice", "qualifying", "sprint_qualifying", "race"]


def _in_reach(df: DataFrame, event_year: int | None, event: str | None) -> DataFrame:
    """Rows that can matter to the targets: their own event and its runnings in the seasons before."""
    if event_year is not None:
        df = df.where(F.col("event_year").between(int(event_year) - YEARS_BACK, int(event_year)))
    return df if event is None else df.where(F.col("event") == F.lit(event))


def gold_features(
    results: DataFrame,
    laps: DataFrame,
    sessions: DataFrame,
    weather: DataFrame,
    event_year: int | None = None,
    event: str | None = None,
) -> DataFrame:
    """One row per driver in qualifying with everything known before the race.

    ``event_year`` and ``event`` limit the targets only: history sees all that can matter to them. All parts meet on the
    driver and event; the two kinds of history are one window each, over the event's earlier years and over the
    driver's season.
    """
    targets = target_filter(qualifying_targets(results), event_year, event)
    raced, lapped = (_in_reach(df, event_year, event) for df in (results, laps))
    # Form is counted within a season.
    season = results if event_year is None else results.where(F.col("event_year") == int(event_year))
    return _assembled(targets, raced, lapped, season, sessions, weather)


def _assembled(
    targets: DataFrame, raced: DataFrame, lapped: DataFrame, season: DataFrame, sessions: DataFrame, weather: DataFrame
) -> DataFrame:
    """Features of ``targets`` from the results and laps of their events in all years, and the results of their seasons."""
    sums = [*LAP_SUMS, *RESULT_SUMS]
    past = past_sums(targets, [pace_summary(lapped, PACE_GROUPS), race_result_sums(raced)], sums, sessions)
    kept = [c for c in past.columns if not c.startswith("past_")]
    history = [*venue_columns(), *race_pace_columns(*[F.col(f"past_{c}") for c in LAP_SUMS])]
    return with_weather(season_form(past.select(*kept, *history), season, sessions), weather)


def affected_events(changed: DataFrame, events: DataFrame) -> DataFrame:
    """Events (``event_year``, ``event``) whose features can change with results, laps, sessions or weather of ``changed`` ones.

    The history windows in reverse: an event reaches its own later runnings for as many years as those look back, and all
    events of its season, as form counts what came before. ``events`` are those that have targets.
    """
    changed = changed.select(F.col("event_year").cast("int").alias("event_year"), "event").distinct()
    known = events.select(F.col("event_year").cast("int").alias("event_year"), "event").distinct()
    later = changed.select(F.explode(F.sequence("event_year", F.col("event_year") + YEARS_BACK)).alias("event_year"), "event")
    of_season = known.join(changed.select("event_year").distinct(), "event_year", "left_semi")
    return known.join(later, EVENT_KEYS, "left_semi").union(of_season.select(*EVENT_KEYS)).distinct()


def gold_update(
    results: DataFrame, laps: DataFrame, sessions: DataFrame, weather: DataFrame, changed: DataFrame
) -> DataFrame:
    """Features of the events that ``changed`` events (``event_year``, ``event``) can affect, and of no others.

    Written with ``write_partitioned(..., EVENT_KEYS, whole=False)`` they bring a stored feature table up to date. Only
    what these events look back on is read: their own runnings of the years before, and their seasons.
    """
    targets = qualifying_targets(results)
    wanted = stored(affected_events(changed, targets), "affected")
    reach = wanted.select(F.explode(F.sequence(F.col("event_year") - YEARS_BACK, F.col("event_year"))).alias("event_year"), "event").distinct()
    # Two numbers come back. A filter on seasons reaches the files; a join alone would read all seasons first.
    first, last = reach.agg(F.min("event_year"), F.max("event_year")).first()
    seasons = F.lit(False) if first is None else F.col("event_year").between(first, last)
    raced, lapped = (df.where(seasons).join(reach, EVENT_KEYS, "left_semi") for df in (results, laps))
    season = results.join(wanted.select("event_year").distinct(), "event_year", "left_semi")
    return _assembled(targets.join(wanted, EVENT_KEYS, "left_semi"), raced, lapped, season, sessions, weather)


def race_labels(results: DataFrame) -> DataFrame:
    return select_sessions(results, "R").select(
        whole(results, "event_year"),
        "event",
        whole(results, "driver_number"),
        whole(results, "finishing_position").alias("race_finishing_position"),
        F.col("time_seconds").alias("race_time_seconds"),
    )


def training_dataset(features: DataFrame, results: DataFrame) -> DataFrame:
    """Features with the race outcome as label; targets without a race result keep NULL labels."""
    return features.join(race_labels(results), DRIVER_EVENT_KEYS, "left")
