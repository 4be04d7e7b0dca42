"""Checks of the finished features: leakage, plausibility, gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventrank.functions.values import exact
from eventrank.operators.events import duplicate_keys
from eventrank.operators.history import FACT, RACES_BACK, TARGET, dated_results
from eventrank.schemas import DRIVER_EVENT_KEYS, EVENT_KEYS

ROLLING = ["target_event_number", "season_points_to_date", "last3_race_count"]


def missing_weather(targets: DataFrame, weather: DataFrame) -> DataFrame:
    """Events with targets but without a weather row. The wet flag is never NULL and cannot tell."""
    return targets.select(*EVENT_KEYS).distinct().join(weather.select(*EVENT_KEYS), EVENT_KEYS, "left_anti")


def leakage_audit(features: DataFrame, results: DataFrame, sessions: DataFrame) -> DataFrame:
    """Per season, targets whose season points take in anything from their own qualifying on.

    The check comes from the other side: what a driver scores at or after the qualifying of a target is summed
    backwards in time, and together with the feature it has to give the season's total.
    """
    season = Window.partitionBy("event_year", "driver_number")
    facts = (
        dated_results(results, sessions, "R", "S")
        .groupBy("event_year", "driver_number", "at")
        .agg(F.sum("points").alias("points"), F.lit(FACT).alias("kind"))
    )
    asked = features.select(
        "event_year", "driver_number", F.col("qualifying_session_date_utc").alias("at"), F.lit(TARGET).alias("kind"),
        exact(F.col("season_points_to_date")).alias("before"),
    )
    backwards = season.orderBy(F.desc("at"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = asked.unionByName(facts, allowMissingColumns=True).withColumns(
        {"after": F.sum("points").over(backwards), "total": F.sum("points").over(season)}
    )
    none = F.lit(0).cast("decimal(28,4)")
    before, after, total = (F.coalesce(F.col(c), none) for c in ("before", "after", "total"))
    return seen.where(F.col("kind") == TARGET).groupBy("event_year").agg(
        F.count(F.lit(1)).alias("targets"),
        F.count("before").alias("with_history"),
        F.sum(before).cast("double").alias("points_before"),
        F.sum(after).cast("double").alias("points_after"),
        F.count_if(before + after != total).alias("violations"),
    )


def rolling_plausibility(features: DataFrame, event_year: int, early: str, late: str) -> DataFrame:
    """Range of the rolling columns at two events of a season, and whether they look right."""
    two = features.where((F.col("event_year") == event_year) & F.col("event").isin(early, late))
    values = F.explode(
        F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in ROLLING])
    )
    rows = two.select("event", values.alias("v")).select("event", "v.*")
    columns = []
    for label, event in (("early", early), ("late", late)):
        value = F.when(F.col("event") == event, F.col("value"))
        columns += [
            F.min(value).alias(f"{label}_min"), F.max(value).alias(f"{label}_max"),
            # Rolling values have few decimals; the decimal mean does not depend on the order of the rows.
            F.avg(value.cast("decimal(18,4)")).cast("double").alias(f"{label}_mean"),
        ]
    ranges = rows.groupBy("name").agg(*columns)
    name = F.col("name")
    in_range = F.col("early_mean").between(0, RACES_BACK) & F.col("late_mean").between(0, RACES_BACK)
    good = (
        F.when(name == "season_points_to_date", F.col("late_max") >= F.col("early_max"))
        .when(name == "last3_race_count", in_range)
        .otherwise(F.col("late_min") >= F.col("early_max"))
    )
    return ranges.withColumn("verdict", F.when(good, "OK").otherwise("CHECK"))


def rolling_compare(features: DataFrame, event_year: int, early: str, late: str, key: str = "abbreviation") -> DataFrame:
    """Rolling columns of the same driver at two events of a season."""
    season = features.where(F.col("event_year") == event_year)

    def at(event: str, label: str) -> DataFrame:
        return season.where(F.col("event") == event).select(
            key, *[F.col(c).alias(f"{label}_{c}") for c in ROLLING[1:]]
        )

    points = F.col("late_season_points_to_date") >= F.col("early_season_points_to_date")
    verdict = F.when(points, "OK").when(~points, "CHECK")
    return at(early, "early").join(at(late, "late"), key).withColumn("verdict", verdict)


def target_key_check(targets: DataFrame) -> DataFrame:
    """Targets in total and those whose key occurs more than once."""
    repeated = duplicate_keys(targets, DRIVER_EVENT_KEYS)
    total = targets.agg(F.count(F.lit(1)).alias("targets"))
    bad = repeated.agg(F.count(F.lit(1)).alias("repeated_keys"))
    return total.unionByName(bad, allowMissingColumns=True).agg(
        F.max("targets").alias("targets"), F.max("repeated_keys").alias("repeated_keys")
    )
