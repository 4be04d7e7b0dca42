"""Weather payloads: pick the day, pick the nearest hour, flatten to silver rows, check the alignment.

A payload keeps its series as arrays of a struct, so every pick is done within the row: nothing is exploded
and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrank.functions.text import event_slug
from eventrank.functions.values import format_utc, is_wet, minute_offset, parse_utc, seconds_between
from eventrank.schemas import EVENT_KEYS
from eventrank.sources.lake import WriteReport, write_partitioned

# Feature name -> series it is read from.
DAILY_SERIES = {
    "precipitation_sum_mm": "precipitation_sum",
    "precipitation_probability_max": "precipitation_probability_max",
    "temperature_max_c": "temperature_2m_max",
    "temperature_min_c": "temperature_2m_min",
    "wind_speed_max_kmh": "wind_speed_10m_max",
}
HOURLY_SERIES = {
    "temperature_c": "temperature_2m",
    "precipitation_probability": "precipitation_probability",
    "precipitation_mm": "precipitation",
    "rain_mm": "rain",
    "wind_speed_kmh": "wind_speed_10m",
}
ZERO_IF_MISSING = ["precipitation_sum_mm", "precipitation_probability_max"]
RACE_TOLERANCE_MINUTES = 60
QUALIFYING_TOLERANCE_MINUTES = 30


def daily_index(daily: str, day: Column) -> Column:
    """Position of ``day`` in the series, else the last one."""
    time = F.col(f"{daily}.time")
    found = F.array_position(time, F.date_format(day, "yyyy-MM-dd"))
    return F.when(found > 0, found - 1).otherwise(F.size(time) - 1).cast("int")


def daily_features(daily: str, day: Column) -> list[Column]:
    index = daily_index(daily, day)
    columns = []
    for name, series in DAILY_SERIES.items():
        # An index of -1 (empty series) lies outside of every array.
        value = F.get(F.col(f"{daily}.{series}"), index)
        columns.append((F.coalesce(value, F.lit(0.0)) if name in ZERO_IF_MISSING else value).alias(name))
    return columns


def nearest_hour(hourly: str, at: Column, prefix: str) -> list[Column]:
    """Values of the hour closest to ``at``; the earlier position wins a tie, unreadable hours are skipped."""
    candidates = F.transform(
        F.col(f"{hourly}.time"),
        lambda text, position: F.struct(
            F.abs(seconds_between(parse_utc(text), at)).alias("distance"),
            position.alias("position"),
            parse_utc(text).alias("hour"),
        ),
    )
    best = F.array_min(F.filter(candidates, lambda c: c["distance"].isNotNull()))
    columns = [
        F.get(F.col(f"{hourly}.{series}"), best["position"]).alias(f"{prefix}_{name}")
        for name, series in HOURLY_SERIES.items()
    ]
    return [
        *columns,
        format_utc(best["hour"]).alias(f"{prefix}_timestamp_utc"),
        minute_offset(best["hour"], at).alias(f"{prefix}_offset_minutes"),
    ]


def enrich(payloads: DataFrame) -> DataFrame:
    """Add the daily, race-hour and qualifying-hour features to a raw payload."""
    race, qualifying = (parse_utc(F.col(f"metadata.{kind}_dt_utc")) for kind in ("race", "qualifying"))
    return payloads.select(
        "metadata",
        F.struct(*daily_features("open_meteo_response.daily", race)).alias("daily_features"),
        F.struct(*nearest_hour("open_meteo_response.hourly", race, "race_hour")).alias("race_hour_features"),
        F.struct(*nearest_hour("open_meteo_response.hourly", qualifying, "qualifying_hour")).alias(
            "qualifying_hour_features"
        ),
        "open_meteo_response",
    )


def _silver(pointers: DataFrame, payloads: DataFrame, head: list[str], times: list[str], hour: str) -> DataFrame:
    matched = payloads.withColumn("event_partition_key", F.col("metadata.event_partition_key")).join(
        pointers, "event_partition_key"
    )
    return matched.select(
        "event_year",
        event_slug(F.col("EventName")).alias("event"),
        F.col("EventName").alias("event_name"),
        *head,
        *[F.col(f"metadata.{c}").alias(c) for c in times],
        "daily_features.*",
        f"{hour}_features.*",
    )


def silver_forecast(pointers: DataFrame, payloads: DataFrame) -> DataFrame:
    times = ["race_dt_utc", "qualifying_dt_utc", "fetched_at_utc"]
    return _silver(pointers, payloads, ["forecast_source"], times, "race_hour")


def silver_qualifying(pointers: DataFrame, payloads: DataFrame) -> DataFrame:
    return _silver(pointers, payloads, [], ["qualifying_dt_utc", "fetched_at_utc"], "qualifying_hour")


def write_silver(pointers: DataFrame, payloads: DataFrame, path: str, dataset: str = "all") -> dict[str, WriteReport]:
    """The chosen datasets (``DATASETS``, or all of them) below ``path``, partitioned by event; a report of each write."""
    if dataset != "all" and dataset not in DATASETS:
        raise ValueError(f"no such dataset: {dataset}")
    chosen = DATASETS if dataset == "all" else {dataset: DATASETS[dataset]}
    return {name: write_partitioned(rows(pointers, payloads), f"{path}/{name}", EVENT_KEYS) for name, rows in chosen.items()}


# Names of the weather datasets.
DATASETS = {"forecast": silver_forecast, "historical_qualifying": silver_qualifying}


def daily_rows(payloads: DataFrame) -> DataFrame:
    """First day of the series as one flat row with the wet flag."""
    daily = "open_meteo_response.daily"
    first = lambda series: F.get(F.col(f"{daily}.{series}"), F.lit(0))
    precipitation = F.coalesce(first("precipitation_sum"), F.lit(0.0))
    return payloads.select(
        F.col("metadata.event_year").alias("event_year"),
        event_slug(F.col("metadata.EventName")).alias("event"),
        F.col("metadata.EventName").alias("event_name"),
        F.substring(F.col("metadata.race_dt_utc"), 1, 10).alias("race_date"),
        F.col("metadata.circuit_lat").alias("circuit_lat"),
        F.col("metadata.circuit_lng").alias("circuit_lng"),
        precipitation.alias("precipitation_sum_mm"),
        F.coalesce(first("rain_sum"), F.lit(0.0)).alias("rain_sum_mm"),
        first("temperature_2m_max").alias("temperature_max_c"),
        first("temperature_2m_min").alias("temperature_min_c"),
        first("wind_speed_10m_max").alias("wind_speed_max_kmh"),
        first("wind_gusts_10m_max").alias("wind_gusts_max_kmh"),
        is_wet(precipitation).alias("is_wet_race"),
    )


def race_hour_alignment(rows: DataFrame) -> DataFrame:
    """Does the chosen hour hold the start of the race: same day, same hour, small offset."""
    race, text = parse_utc(F.col("race_dt_utc")), F.col("race_hour_timestamp_utc")
    hour = parse_utc(text)
    offset = F.coalesce("race_hour_offset_minutes", F.lit(0))

    as_text = lambda value: F.coalesce(value.cast("string"), F.lit("?"))
    message = (
        F.when(F.coalesce(text, F.lit("")) == "", "no race hour is stored")
        .when(hour.isNull(), F.format_string("the race hour '%s' is no time", text))
        .when(
            F.to_date(hour) != F.to_date(race),
            F.format_string("the hour is of %s, the race of %s", as_text(F.to_date(hour)), as_text(F.to_date(race))),
        )
        .when(
            F.hour(hour) != F.hour(race),
            F.format_string("the hour begins at %s, the race within hour %s", as_text(F.hour(hour)), as_text(F.hour(race))),
        )
        .when(F.abs(offset) > RACE_TOLERANCE_MINUTES, F.format_string("the hour is %d minutes off", offset))
        .otherwise(F.format_string("aligned, %d minutes off", offset))
    )
    return rows.select(
        "event_year", "event", "race_dt_utc", "race_hour_timestamp_utc", "race_hour_offset_minutes",
        message.startswith("aligned").alias("aligned"), message.alias("message"),
    )


def qualifying_hour_alignment(rows: DataFrame) -> DataFrame:
    """Is the stored offset the real one, and is the hour close enough to the session."""
    computed = minute_offset(parse_utc(F.col("qualifying_hour_timestamp_utc")), parse_utc(F.col("qualifying_dt_utc")))
    stored = F.col("qualifying_hour_offset_minutes")
    return rows.select(
        "event_year", "event", "qualifying_dt_utc", "qualifying_hour_timestamp_utc",
        computed.alias("computed_offset_minutes"),
        F.coalesce(computed == stored, computed.isNotNull()).alias("offset_matches"),
        F.coalesce(F.abs(computed) <= QUALIFYING_TOLERANCE_MINUTES, F.lit(False)).alias("in_range"),
    )


def alignment_summary(checked: DataFrame) -> DataFrame:
    return checked.agg(F.count_if("aligned").alias("aligned"), F.count(F.lit(1)).alias("total"))
