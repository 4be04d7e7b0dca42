"""The event stream read as weather payloads: a day is a race day, its hours are the hourly series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrank.functions.text import event_key
from eventrank.functions.values import format_utc
from eventrank.sources.binding import EVENT_NAMES
from eventrank.sources.tables import table

MONTHS = len(EVENT_NAMES)


def raw_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """One payload per day. A day has at most 24 hours, so the collected series are short."""
    kind, value = F.col("event_type"), F.col("value")
    hours = (
        table(spark, folder, "events")
        .groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
        .agg(
            F.max("value").alias("temp"), F.min("value").alias("low"),
            F.max(F.when(kind == "click", value)).alias("rain"), F.count(F.lit(1)).alias("n"),
            F.min(F.when(kind == "purchase", F.col("ts"))).alias("race"),
            F.min(F.when(kind == "signup", F.col("ts"))).alias("qualifying"),
        )
    )
    days = hours.groupBy(F.to_date("hour").alias("day")).agg(
        F.sort_array(F.collect_list(F.struct("hour", "temp", "low", "rain", "n"))).alias("h"),
        F.min("race").alias("race"), F.min("qualifying").alias("qualifying"),
        F.max("temp").alias("tmax"), F.min("low").alias("tmin"), F.sum("n").alias("n"),
    )
    number = F.datediff("day", F.lit("2024-01-01"))
    names = F.create_map(*[F.lit(v) for k, (name, _) in EVENT_NAMES.items() for v in (k, name)])
    named = days.select(
        "*", number.alias("k"), (F.lit(2024) + F.floor(number / MONTHS)).cast("int").alias("event_year"),
        names[(number % MONTHS + 1).cast("int")].alias("EventName"),
    )
    k, n = F.col("k"), F.col("n").cast("double")
    metadata = F.struct(
        event_key(F.col("event_year"), F.col("EventName")).alias("event_partition_key"),
        "EventName", "event_year",
        format_utc(F.col("qualifying")).alias("qualifying_dt_utc"),
        format_utc(F.col("race")).alias("race_dt_utc"),
        k.cast("double").alias("circuit_lat"),
        (-k).cast("double").alias("circuit_lng"),
        F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("fetched_at_utc"),
        F.when(k % 2 == 0, "historical").otherwise("live").alias("forecast_endpoint_mode"),
    )
    # Odd days lack their own date in the daily series; every third has no precipitation.
    before = F.date_format(F.date_sub("day", 1), "yyyy-MM-dd")
    both = k % 2 == 0

    def pair(first, own):
        return F.when(both, F.array(first, own)).otherwise(F.array(first))

    nothing = F.lit(None).cast("double")
    daily = F.struct(
        pair(before, F.date_format("day", "yyyy-MM-dd")).alias("time"),
        pair(F.when(k % 3 != 0, n % 7 * 0.5), F.when(k % 4 != 0, n % 5 * 0.5)).alias("precipitation_sum"),
        pair(nothing, n % 100).alias("precipitation_probability_max"),
        pair(n % 11 * 0.25, nothing).alias("rain_sum"),
        pair(F.col("tmax") + 1, F.col("tmax")).alias("temperature_2m_max"),
        pair(F.col("tmin"), F.col("tmin")).alias("temperature_2m_min"),
        pair(n, n + 1).alias("wind_speed_10m_max"),
        pair(n + 2, n + 3).alias("wind_gusts_10m_max"),
    )
    # An hour that cannot be read ends the series; the rain series stops after twenty hours.
    hourly = F.struct(
        F.concat(F.transform("h", lambda x: F.date_format(x["hour"], "yyyy-MM-dd'T'HH:mm")), F.array(F.lit("soon")))
        .alias("time"),
        F.transform("h", lambda x: x["temp"]).alias("temperature_2m"),
        F.transform("h", lambda x: (x["n"] % 100).cast("double")).alias("precipitation_probability"),
        F.transform("h", lambda x: x["low"]).alias("precipitation"),
        F.slice(F.transform("h", lambda x: x["rain"]), 1, 20).alias("rain"),
        F.transform("h", lambda x: x["n"].cast("double")).alias("wind_speed_10m"),
    )
    return named.select(
        metadata.alias("metadata"),
        F.struct(daily.alias("daily"), hourly.alias("hourly")).alias("open_meteo_response"),
    )


def pointers(payloads: DataFrame) -> DataFrame:
    """Which file belongs to which event, and whether it came from the archive."""
    return payloads.select(
        "metadata.event_partition_key", "metadata.event_year", "metadata.EventName",
        F.col("metadata.forecast_endpoint_mode").alias("forecast_source"),
    )
