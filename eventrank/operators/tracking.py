"""The session tracking table: build, filter, look up, upsert, update, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrank.functions.text import event_slug, session_abbreviation
from eventrank.functions.values import format_utc, parse_utc, percentage
from eventrank.sources.coordinates import with_coordinates

KEYS = ["event_partition_key", "session_name_abr"]
POINTERS = [
    "s3_results_location", "s3_laps_location", "s3_historical_weather_forecast_location",
    "s3_live_weather_forecast_location", "s3_historical_qualifying_weather_location",
]
SLOTS = 5


def _filled(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def schedule_sessions(schedule: DataFrame) -> DataFrame:
    """Wide season schedule to one row per session; empty slots are left out."""
    slot = F.array(
        *[
            F.struct(
                F.trim(F.col(f"Session{i}")).alias("name"),
                F.col(f"Session{i}Date").cast("string").alias("date"),
                F.col(f"Session{i}DateUtc").cast("string").alias("utc"),
            )
            for i in range(1, SLOTS + 1)
        ]
    )
    used = F.filter(slot, lambda s: s["name"].isNotNull() & ~F.lower(s["name"]).isin("none", ""))
    rows = schedule.select("*", F.explode(used).alias("s")).withColumn("event", event_slug(F.col("EventName")))
    name, utc = F.col("s.name"), F.col("s.utc")
    return with_coordinates(rows).select(
        F.col("event_year_key").alias("event_partition_key"),
        F.col("year").alias("event_year"),
        F.col("RoundNumber").alias("event_number"),
        "EventName",
        name.alias("session_name"),
        session_abbreviation(name).alias("session_name_abr"),
        (name != "Race").alias("is_before_race"),
        F.col("s.date").alias("session_date"),
        # A date that cannot be read is passed on as it is.
        F.coalesce(format_utc(parse_utc(utc)), utc).alias("session_date_utc"),
        F.col("EventFormat").alias("event_format"),
        F.lit(False).alias("data_loaded"),
        "circuit_lat", "circuit_lng",
    )


def filter_rows(tracking: DataFrame, present: list[str], sessions: list[str] | None = None) -> DataFrame:
    """Rows that have all attributes of ``present``, optionally of some sessions only."""
    for name in present:
        tracking = tracking.where(F.col(name).isNotNull())
    return tracking.where(F.col("session_name_abr").isin(sessions)) if sessions else tracking


def lookup(tracking: DataFrame, key: str, session: str | None = None) -> DataFrame:
    found = tracking.where(F.col("event_partition_key") == F.lit(key))
    return found if session is None else found.where(F.col("session_name_abr") == F.lit(session))


def not_loaded() -> Column:
    return ~F.coalesce(F.col("data_loaded"), F.lit(False))


def load_backlog(tracking: DataFrame, now: str | None, limit: int | None = None) -> DataFrame:
    """Sessions still to load, newest season and date first; ``now`` None includes future ones."""
    open_rows = tracking.where(not_loaded())
    if now is not None:
        open_rows = open_rows.where(parse_utc(F.col("session_date_utc")) < parse_utc(F.lit(now)))
    ordered = open_rows.orderBy(
        F.desc_nulls_last("event_year"), parse_utc(F.col("session_date_utc")).desc_nulls_last(), *[F.asc(k) for k in KEYS]
    )
    return ordered if limit is None else ordered.limit(limit)


def latest_rows(rows: DataFrame, order: str) -> DataFrame:
    """Last row of each key by ``order``; combined on the map side, so many copies of one key do no harm."""
    usable = rows.where(_filled(F.col(KEYS[0])) & _filled(F.col(KEYS[1])))
    newest = usable.groupBy(*KEYS).agg(F.max_by(F.struct(*usable.columns), order).alias("row"))
    return newest.select("row.*")


def upsert(tracking: DataFrame, incoming: DataFrame, order: str) -> DataFrame:
    """Replace or add rows by key; what was loaded stays loaded and keeps its pointers."""
    latest = latest_rows(incoming, order).drop(order)
    kept = [c for c in POINTERS if c in tracking.columns]
    old, new = tracking.alias("old"), latest.withColumn("arrived", F.lit(True)).alias("new")
    matched = old.join(new, KEYS, "full")
    arrived = F.coalesce(F.col("arrived"), F.lit(False))

    def merged(name: str) -> Column:
        before = F.col(f"old.{name}") if name in tracking.columns else F.lit(None)
        after = F.col(f"new.{name}") if name in latest.columns else F.lit(None)
        if name == "data_loaded":
            return F.when(arrived, F.coalesce(before, F.lit(False))).otherwise(before)
        if name in kept:
            return F.coalesce(before, after)
        return F.when(arrived, after).otherwise(before)

    names = [*tracking.columns, *[c for c in latest.columns if c not in tracking.columns]]
    return matched.select(*[F.col(n) if n in KEYS else merged(n).alias(n) for n in names])


def update(tracking: DataFrame, changes: DataFrame) -> DataFrame:
    """Set the attributes that ``changes`` has a value for; unknown keys are ignored."""
    names = [c for c in changes.columns if c not in KEYS]
    matched = tracking.alias("old").join(changes.alias("new"), KEYS, "left")
    return matched.select(
        *[F.coalesce(f"new.{c}", f"old.{c}").alias(c) if c in names else F.col(c) for c in tracking.columns]
    )


def landed_sessions(results: DataFrame, laps: DataFrame) -> DataFrame:
    """Per key, whether both outputs have landed; only then a session counts as loaded."""
    parts = [df.select(*KEYS, F.lit(name).alias("part")) for df, name in ((results, "results"), (laps, "laps"))]
    flags = [F.max(F.col("part") == name) for name in ("results", "laps")]
    return parts[0].unionByName(parts[1]).groupBy(*KEYS).agg(F.when(flags[0] & flags[1], True).alias("data_loaded"))


def coverage_by_year(tracking: DataFrame) -> DataFrame:
    loaded, total = F.count_if(F.col("data_loaded")), F.count(F.lit(1))
    return tracking.groupBy("event_year").agg(
        loaded.alias("loaded_sessions"), total.alias("total_sessions"),
        percentage(loaded, total).alias("loaded_percent"),
        F.count_distinct(F.when(_filled(F.col(KEYS[0])), F.col(KEYS[0]))).alias("events"),
    )


def coverage_by_event(tracking: DataFrame) -> DataFrame:
    loaded, total = F.count_if(F.col("data_loaded")), F.count(F.lit(1))
    return tracking.groupBy("event_partition_key").agg(
        F.max("event_year").alias("event_year"), F.max("EventName").alias("EventName"),
        loaded.alias("loaded_sessions"), total.alias("total_sessions"),
        F.when(loaded < total, "incomplete").otherwise("complete").alias("state"),
    )


def forecast_pointers(tracking: DataFrame) -> DataFrame:
    """One forecast file per event: the historical one if there is one, else the live one."""
    historical, live = (F.col(f"s3_{kind}_weather_forecast_location") for kind in ("historical", "live"))
    races = tracking.where((F.col("session_name_abr") == "R") & _filled(F.col("event_partition_key")))
    chosen = races.select(
        "event_partition_key", "event_year", "EventName",
        F.when(_filled(historical), historical).when(_filled(live), live).alias("s3_key"),
        F.when(_filled(historical), "historical").otherwise("live").alias("forecast_source"),
    ).where(F.col("s3_key").isNotNull())
    one = chosen.groupBy("event_partition_key").agg(F.max_by(F.struct(*chosen.columns[1:]), "s3_key").alias("row"))
    return one.select("event_partition_key", "row.*")
