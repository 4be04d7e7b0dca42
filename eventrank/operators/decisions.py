"""Which event comes next, which window is open, what is still to do. The time of asking is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrank.functions.values import parse_utc
from eventrank.operators.tracking import not_loaded

FORECAST_DAYS = 15
PREDICTION_DAYS = 7


def _at(session: str, name: str) -> Column:
    return F.max(F.when(F.col("session_name_abr") == session, F.col(name)))


def _known(text: Column) -> Column:
    return F.when(text.isNotNull() & (text != ""), text)


def event_windows(tracking: DataFrame) -> DataFrame:
    """Qualifying and race time per event that has both, the race not before qualifying, with coordinates."""
    both = (
        tracking.where(F.col("session_name_abr").isin("Q", "R"))
        .groupBy("event_partition_key")
        .agg(
            F.coalesce(_known(_at("R", "EventName")), _at("Q", "EventName")).alias("EventName"),
            F.coalesce(_at("R", "event_year"), _at("Q", "event_year")).alias("event_year"),
            parse_utc(_at("Q", "session_date_utc")).alias("qualifying_dt_utc"),
            parse_utc(_at("R", "session_date_utc")).alias("race_dt_utc"),
            *[_at(s, c).alias(f"{s}_{c}") for s in "QR" for c in ("circuit_lat", "circuit_lng")],
        )
    )
    race_place = F.col("R_circuit_lat").isNotNull() & F.col("R_circuit_lng").isNotNull()
    place = [F.when(race_place, F.col(f"R_{c}")).otherwise(F.col(f"Q_{c}")).alias(c) for c in ("circuit_lat", "circuit_lng")]
    return (
        both.where(F.col("race_dt_utc") >= F.col("qualifying_dt_utc"))
        .select("event_partition_key", "EventName", "event_year", "qualifying_dt_utc", "race_dt_utc", *place)
        .where(F.col("circuit_lat").isNotNull() & F.col("circuit_lng").isNotNull())
    )


def qualifying_windows(tracking: DataFrame) -> DataFrame:
    """Qualifying time per event; the race row is only asked for what the qualifying row lacks."""
    rows = (
        tracking.where(F.col("session_name_abr").isin("Q", "R"))
        .groupBy("event_partition_key")
        .agg(
            F.coalesce(_known(_at("Q", "EventName")), _at("R", "EventName")).alias("EventName"),
            F.coalesce(_at("Q", "event_year"), _at("R", "event_year")).alias("event_year"),
            parse_utc(_at("Q", "session_date_utc")).alias("qualifying_dt_utc"),
            *[F.coalesce(_at("R", c), _at("Q", c)).alias(c) for c in ("circuit_lat", "circuit_lng")],
        )
    )
    return rows.dropna(subset=["qualifying_dt_utc", "circuit_lat", "circuit_lng"])


def target_window(windows: DataFrame, now: str) -> DataFrame:
    """The running event, else the next one whose race is close enough to forecast, and where to ask for it."""
    at = parse_utc(F.lit(now))
    q, r = F.col("qualifying_dt_utc"), F.col("race_dt_utc")
    active = (q <= at) & (r >= at)
    upcoming = (q > at) & (F.datediff(r, at) <= FORECAST_DAYS)
    level = F.when(active, 0).when(upcoming, 1)
    mode = F.when(F.to_date(q) < F.to_date(at), "historical").otherwise("live")
    ranked = windows.withColumn("level", level).where(F.col("level").isNotNull())
    first = ranked.orderBy("level", F.when(F.col("level") == 0, r).otherwise(q), "event_partition_key").limit(1)
    return first.withColumn("forecast_endpoint_mode", mode).drop("level")


def first_windows(windows: DataFrame, count: int = 10) -> DataFrame:
    """The first events by race time. Past races come first in that order, so they are preferred by themselves."""
    return windows.orderBy("race_dt_utc", "event_partition_key").limit(count)


def _session_times(tracking: DataFrame) -> DataFrame:
    return tracking.groupBy("event_partition_key").agg(
        F.max("event_year").alias("event_year"), F.max("EventName").alias("EventName"),
        _at("Q", "session_date_utc").alias("qualifying_time"), _at("R", "session_date_utc").alias("race_time"),
        F.coalesce(_at("Q", "data_loaded"), F.lit(False)).alias("qualifying_loaded"),
    )


def upcoming_event(tracking: DataFrame, now: str) -> DataFrame:
    """The event with the next qualifying after ``now``."""
    later = _session_times(tracking).where(parse_utc(F.col("qualifying_time")) > parse_utc(F.lit(now)))
    return later.orderBy(parse_utc(F.col("qualifying_time")), "event_partition_key").limit(1)


def prediction_window(tracking: DataFrame, now: str) -> DataFrame:
    """The event whose qualifying lies in the last days and whose race is still to come."""
    at = parse_utc(F.lit(now))
    q, r = parse_utc(F.col("qualifying_time")), parse_utc(F.col("race_time"))
    recent = (q > at - F.make_dt_interval(days=F.lit(PREDICTION_DAYS))) & (q < at)
    return _session_times(tracking).where(recent & (r > at)).orderBy("qualifying_time", "event_partition_key").limit(1)


def pending_predictions(events: DataFrame, predicted: DataFrame) -> DataFrame:
    """Events without predictions, judged event by event."""
    return events.join(predicted, ["event_year", "event"], "left_anti")


def weather_backlog(tracking: DataFrame, now: str) -> DataFrame:
    """Races up to today whose archived weather is not stored yet."""
    races = tracking.where((F.col("session_name_abr") == "R") & (F.col("event_format") != "testing"))
    held = F.to_date(parse_utc(F.col("session_date_utc"))) <= F.to_date(parse_utc(F.lit(now)))
    cached = tracking.where(F.col("s3_historical_weather_forecast_location").isNotNull()).select("event_partition_key")
    todo = races.where(held).join(cached, "event_partition_key", "left_anti")
    return todo.select("event_partition_key", "event_year", "EventName", "session_date_utc", "circuit_lat", "circuit_lng")


def held_races(sessions: DataFrame, now: str, first_year: int, last_year: int) -> DataFrame:
    """Races of the seasons asked for that are no tests and not in the future."""
    day = F.to_date(parse_utc(F.col("session_date_utc")))
    return sessions.where(
        (F.col("session_name") == "Race")
        & (F.col("event_format") != "testing")
        & F.col("event_year").between(first_year, last_year)
        & (day <= F.to_date(parse_utc(F.lit(now))))
    ).select("event_year", "EventName", day.alias("race_date"))


def next_events(tracking: DataFrame, now: str, count: int = 3) -> DataFrame:
    at = F.to_date(parse_utc(F.lit(now)))
    race = F.to_date(parse_utc(F.col("session_date_utc")))
    races = tracking.where((F.col("session_name_abr") == "R") & (race >= at))
    return (
        races.orderBy("session_date_utc", "event_partition_key")
        .limit(count)
        .select(
            F.col("event_number").alias("round"), F.col("EventName").alias("name"),
            F.col("session_date_utc").alias("date"), F.datediff(race, at).alias("days_until"),
        )
    )


def ready_run(runs: DataFrame, markers: DataFrame) -> DataFrame:
    """The newest run that finished. Run ids start with a time stamp, so the greatest is the newest."""
    return runs.join(markers, "run_id", "left_semi").agg(F.max("run_id").alias("run_id"))


def pipeline_decision(tracking: DataFrame, ready: DataFrame, predicted: DataFrame, now: str) -> DataFrame:
    """One row: is there data to ingest, is there a prediction to run, and why."""
    late = (F.col("session_name_abr") == "Q") & (parse_utc(F.col("session_date_utc")) <= parse_utc(F.lit(now))) & not_loaded()
    backlog = tracking.agg(F.count_if(late).alias("late_sessions"))
    window = prediction_window(tracking, now)
    done = predicted.select("event_partition_key", F.lit(True).alias("predicted")).distinct()
    context = window.join(done, "event_partition_key", "left").select(
        F.col("event_partition_key"), "qualifying_loaded", F.coalesce("predicted", F.lit(False)).alias("predicted")
    )
    model = ready.select(F.col("run_id").alias("model_run_id"))
    facts = backlog.unionByName(context, allowMissingColumns=True).unionByName(model, allowMissingColumns=True)
    known = facts.agg(*[F.max(c).alias(c) for c in facts.columns])
    ingest = F.col("late_sessions") > 0
    reason = (
        F.when(F.col("model_run_id").isNull(), "no finished model run")
        .when(F.col("event_partition_key").isNull(), "no event to predict now")
        .when(F.col("predicted"), "event was predicted before")
        .when(~F.col("qualifying_loaded"), "qualifying is not loaded")
        .otherwise("ready")
    )
    return known.select(
        ingest.alias("should_ingest"),
        F.when(ingest, "qualifying is over but not loaded").otherwise("up to date").alias("ingest_reason"),
        (reason == "ready").alias("should_predict"),
        reason.alias("predict_reason"),
        "model_run_id", "event_partition_key", "late_sessions",
    )
