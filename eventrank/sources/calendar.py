"""The calendar binding as a session tracking table, a wide season schedule, model runs and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrank.functions.text import SESSION_ABBREVIATIONS, event_key
from eventrank.sources import binding
from eventrank.sources.coordinates import with_coordinates

NOW = "2001-03-15T00:00:00Z"
LOADED_UNTIL = "2000-11-01T00:00:00Z"


def _pointer(kind: str) -> Column:
    return F.concat(
        F.lit("s3://lake/bronze/season="), F.col("event_year").cast("string"), F.lit("/event="), F.col("event"),
        F.lit("/session="), F.col("session"), F.lit(f"/{kind}/"), F.col("event_partition_key"), F.lit(f"_{kind}.parquet"),
    )


def event_format() -> Column:
    number = F.col("event_number")
    return F.when(number == 2, "testing").when(number % 3 == 0, "sprint").otherwise("conventional")


def tracking(spark: SparkSession, folder: str) -> DataFrame:
    names = F.create_map(*[F.lit(x) for name, abr in SESSION_ABBREVIATIONS.items() for x in (abr, name)])
    number, session, date = F.col("event_number"), F.col("session"), F.col("session_date_utc")
    loaded = (date < LOADED_UNTIL) & ~((number % 5 == 0) & (session == "Q"))
    df = with_coordinates(binding.sessions(spark, folder)).withColumn(
        "event_partition_key", event_key(F.col("event_year"), F.col("event_name"))
    )
    is_race = session == "R"
    return df.select(
        "event_partition_key",
        session.alias("session_name_abr"),
        "event_year", "event_number",
        F.col("event_name").alias("EventName"),
        names[session].alias("session_name"),
        F.substring("session_date_utc", 1, 10).alias("session_date"),
        "session_date_utc",
        event_format().alias("event_format"),
        (~is_race).alias("is_before_race"),
        F.when(loaded, True).when(session != "P1", False).alias("data_loaded"),
        F.when(loaded, _pointer("Results")).alias("s3_results_location"),
        F.when(loaded, _pointer("Laps")).alias("s3_laps_location"),
        F.when(is_race & (number % 2 == 0) & (F.col("event_year") < 2000), _pointer("HistoricalForecast"))
        .alias("s3_historical_weather_forecast_location"),
        F.when(is_race & (number % 3 == 0), _pointer("LiveForecast")).alias("s3_live_weather_forecast_location"),
        F.when((session == "Q") & (number % 4 == 0), _pointer("QualifyingWeather"))
        .alias("s3_historical_qualifying_weather_location"),
        "circuit_lat", "circuit_lng",
    )


def schedule(spark: SparkSession, folder: str) -> DataFrame:
    """One row per event with five session slots, some of them empty, blank, padded or unknown."""
    year, number = F.col("event_year"), F.col("event_number")
    sprint = number % 3 == 0
    names = [
        F.when(sprint, "Practice 1").otherwise(" Practice 1 "),
        F.when(sprint & (year < 1998), "Sprint Shootout").when(sprint, "Sprint Qualifying").otherwise("None"),
        F.when(sprint, "Sprint").when(year == 1995, "warm up").otherwise("  "),
        F.lit("Qualifying"),
        F.when(number != 11, "Race"),
    ]
    days = [("03", "12"), ("05", "12"), ("06", "12"), ("10", "14"), ("20", "13")]
    month = F.concat(year.cast("string"), F.lit("-"), F.lpad(number.cast("string"), 2, "0"), F.lit("-"))
    slots = []
    for i, (name, (day, hour)) in enumerate(zip(names, days), 1):
        at = F.concat(month, F.lit(f"{day} {hour}:00:00"))
        slots += [
            name.alias(f"Session{i}"),
            at.alias(f"Session{i}Date"),
            (F.when(number != 4, at) if i == 1 else at).alias(f"Session{i}DateUtc"),
        ]
    return binding.events(spark, folder).select(
        event_key(year, F.col("event_name")).alias("event_year_key"),
        year.alias("year"),
        number.alias("RoundNumber"),
        F.col("event_name").alias("EventName"),
        event_format().alias("EventFormat"),
        *slots,
    )


def predicted_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events that already have predictions."""
    return binding.events(spark, folder).where(F.col("event_number") % 2 == 0).select("event_year", "event")


def run_id(year: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("0301T000000Z"))


def model_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One run per season, trained on the races of that season."""
    races = binding.results(spark, folder).where(F.col("session") == "R")
    return races.groupBy("event_year").agg(
        F.count(F.lit(1)).alias("train_rows"), F.count_if(F.col("finishing_position") <= 3).alias("podiums"),
    ).select(run_id(F.col("event_year")).alias("run_id"), "event_year", "train_rows", "podiums")


def success_markers(spark: SparkSession, folder: str) -> DataFrame:
    """Runs that finished: those of odd seasons."""
    years = binding.events(spark, folder).select("event_year").distinct()
    return years.where(F.col("event_year") % 2 == 1).select(run_id(F.col("event_year")).alias("run_id"))
