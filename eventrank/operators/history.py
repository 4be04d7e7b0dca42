"""What a driver had done before a target: this season so far, and the same event in earlier years.

The history side is first summed per driver and session (or year), so the rows a running window sees are
bounded by the calendar, whatever the number of result or lap rows behind them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventrank.functions.values import exact, whole
from eventrank.operators.events import select_sessions, session_dates, with_calendar
from eventrank.operators.pace import race_lap_sums, race_pace_columns
from eventrank.schemas import DRIVER_EVENT_KEYS, SESSION_KEYS

YEARS_BACK = 3
RACES_BACK = 3
TARGET, FACT = 0, 1
RESULT_SUMS = ["finish_sum", "finishes", "points_sum", "races"]
LAP_SUMS = ["race_laps", "race_ms", "race_ms_squares"]


def _points() -> Column:
    return F.coalesce(exact(F.col("points").try_cast("double")), F.lit(0).cast("decimal(18,4)"))


def dated_results(results: DataFrame, sessions: DataFrame, *names: str) -> DataFrame:
    """Results of the named sessions with the number and date the calendar gives them."""
    calendar = select_sessions(session_dates(sessions), *names)
    return select_sessions(results.drop("event_number"), *names).join(calendar, SESSION_KEYS).select(
        whole(results, "event_year"),
        "event",
        "session",
        whole(results, "driver_number"),
        "event_number",
        F.col("session_date_utc").alias("at"),
        whole(results, "finishing_position").alias("finish"),
        F.coalesce(F.col("is_retired").try_cast("boolean"), F.lit(False)).alias("retired"),
        _points().alias("points"),
    )


def season_form(targets: DataFrame, results: DataFrame, sessions: DataFrame, depth: int = RACES_BACK) -> DataFrame:
    """Targets with their driver's season so far: points of all races and sprints, and form over the last races.

    Targets and dated results of a driver's season are put on one time axis, equal times with the target first,
    so that a running window sees what began strictly before. The last races are eligible by date and ordered by
    event number. What the window sees is bounded by the calendar, however many result rows a driver has: points are
    summed by moment, and of a moment's races only the last ``depth`` are carried, as no other can be among the last
    ``depth`` of a target. Both are combined before they are shuffled.
    """
    row = ["event_year", "driver_number", "at", "session", "event_number", "finish", "retired", "points"]
    moment = ["event_year", "driver_number", "at"]
    race = F.struct("event_number", "finish", "retired", "points")
    distinct = dated_results(results, sessions, "R", "S").where(F.col("at").isNotNull()).groupBy(*row).agg(F.count(F.lit(1)).alias("copies"))
    scored = distinct.groupBy(*moment).agg(F.sum(F.col("points") * F.col("copies")).cast("decimal(38,4)").alias("scored"))
    place = F.row_number().over(Window.partitionBy(*moment).orderBy(*[F.col(c).desc() for c in row[4:]]))
    latest = distinct.where(F.col("session") == "R").withColumn("place", place).where(F.col("place") <= depth)
    copies = F.least(F.col("copies"), F.lit(depth)).cast("int")
    races = latest.select(*moment, F.array_repeat(race, copies).alias("races"))
    facts = scored.unionByName(races, allowMissingColumns=True).withColumn("kind", F.lit(FACT))
    asked = targets.withColumns({"at": F.col("qualifying_session_date_utc"), "kind": F.lit(TARGET)})
    season = Window.partitionBy("event_year", "driver_number").orderBy("at", "kind")
    before = season.rowsBetween(Window.unboundedPreceding, -1)
    seen = {
        "season_points_to_date": F.sum("scored").over(before).cast("double"),
        "seen": F.collect_list("races").over(before),
    }
    on_axis = asked.unionByName(facts, allowMissingColumns=True).withColumns(seen).where(F.col("kind") == TARGET)
    latest = F.slice(F.sort_array(F.flatten("seen"), asc=False), 1, depth)
    counted = on_axis.withColumn("last", F.when(F.size("seen") > 0, latest))
    zero = F.lit(0).cast("decimal(38,4)")
    points = F.aggregate("last.points", zero, lambda a, x: (a + x).cast("decimal(38,4)"))
    finishes = F.filter("last.finish", lambda x: x.isNotNull())
    places = F.aggregate(finishes, F.lit(0), lambda a, x: a + x)
    known = F.col("last").isNotNull()
    return counted.select(
        *targets.columns,
        "season_points_to_date",
        points.cast("double").alias("last3_race_points"),
        F.when(known, F.try_divide(places.cast("double"), F.size(finishes))).alias("last3_avg_finish"),
        F.when(known, F.size(F.filter("last.retired", lambda x: x))).cast("bigint").alias("last3_dnfs"),
        F.when(known, F.size("last")).cast("bigint").alias("last3_race_count"),
    )


def race_result_sums(results: DataFrame) -> DataFrame:
    """Exact sums over the race results of each driver and event."""
    finish = whole(results, "finishing_position")
    return (
        select_sessions(results, "R")
        .select(
            whole(results, "event_year"), "event", whole(results, "driver_number"), finish.alias("finish"),
            _points().alias("points"),
        )
        .groupBy(*DRIVER_EVENT_KEYS)
        .agg(
            F.sum("finish").alias("finish_sum"), F.count("finish").alias("finishes"),
            F.sum("points").alias("points_sum"), F.count(F.lit(1)).alias("races"),
        )
    )


def past_sums(
    targets: DataFrame, parts: list[DataFrame], sums: list[str], sessions: DataFrame, years: int = YEARS_BACK
) -> DataFrame:
    """Targets with the dates of their event, the columns of ``parts`` and, as ``past_...``, the ``sums`` over the
    seasons before at the same event.

    Each of ``parts`` has one row per driver, event and season. Instead of being joined, targets and parts are put
    under each other and meet in one window per event and driver: rows of the same season give a target its own
    values, rows of earlier seasons its past ones. That takes one shuffle, and a window is as long as the calendar
    has years. The sums count where the calendar knows a race.
    """
    rows = targets.withColumn("is_target", F.lit(True))
    for part in parts:
        rows = rows.unionByName(part, allowMissingColumns=True)
    seasons = Window.partitionBy("event", "driver_number").orderBy("event_year")
    same, earlier = seasons.rangeBetween(0, 0), seasons.rangeBetween(-years, -1)
    own = [c for part in parts for c in part.columns if c not in sums and c not in DRIVER_EVENT_KEYS]
    values = {c: F.max(c).over(same) for c in own}
    past = {f"past_{c}": F.sum(F.when(F.col("has_race"), F.col(c))).over(earlier) for c in sums}
    dated = with_calendar(rows, sessions).withColumns({**values, **past})
    return dated.where(F.col("is_target")).drop("is_target", "has_race", *sums)


def venue_columns() -> list[Column]:
    races = F.col("past_races")
    return [
        F.try_divide(F.col("past_finish_sum").cast("double"), F.col("past_finishes")).alias("circuit_last3y_avg_finish"),
        (F.col("past_points_sum").cast("double") / races).alias("circuit_last3y_avg_points"),
        races.alias("circuit_last3y_race_count"),
    ]


def venue_results(targets: DataFrame, results: DataFrame, sessions: DataFrame) -> DataFrame:
    """Race results at the same event in the three seasons before the target, for targets that have any."""
    past = past_sums(targets.select(*DRIVER_EVENT_KEYS), [race_result_sums(results)], RESULT_SUMS, sessions)
    return past.where(F.col("past_races").isNotNull()).select(*DRIVER_EVENT_KEYS, *venue_columns())


def race_pace_history(targets: DataFrame, laps: DataFrame, sessions: DataFrame) -> DataFrame:
    """Race lap pace at the same event in the three seasons before the target, for targets that have any."""
    past = past_sums(targets.select(*DRIVER_EVENT_KEYS), [race_lap_sums(laps)], LAP_SUMS, sessions)
    pace = race_pace_columns(*[F.col(f"past_{c}") for c in LAP_SUMS])
    return past.where(F.col("past_race_laps").isNotNull()).select(*DRIVER_EVENT_KEYS, *pace)
