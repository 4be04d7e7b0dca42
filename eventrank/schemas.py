"""Column contracts of the tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVENT_KEYS = ["event_year", "event"]
DRIVER_EVENT_KEYS = ["event_year", "event", "driver_number"]
SESSION_KEYS = ["event_year", "event", "session"]

# Column order of the silver tables.
SILVER_LAP_COLUMNS = [
    "event_year", "event_name", "session_name", "session_type", "session", "driver", "driver_number", "team",
    "lap_number", "stint", "time_seconds", "lap_time_seconds", "lap_start_time_seconds", "sector1_time_seconds",
    "sector2_time_seconds", "sector3_time_seconds", "total_sector_time_seconds", "sector_time_mismatch",
    "pit_in_time_seconds", "pit_out_time_seconds", "is_pit_lap", "speed_i1", "speed_i2", "speed_fl", "speed_st",
    "compound", "tyre_life", "fresh_tyre", "position", "track_status", "is_personal_best", "is_accurate", "deleted",
    "fastf1_generated", "lap_start_date", "sector1_session_time_seconds", "sector2_session_time_seconds",
    "sector3_session_time_seconds", "deleted_reason",
]

SILVER_RESULT_COLUMNS = [
    "event_year", "event_name", "event", "session_name", "session", "session_type", "is_practice", "is_qualifying",
    "is_race", "is_sprint", "driver_number", "driver_id", "full_name", "first_name", "last_name", "broadcast_name",
    "abbreviation", "country_code", "team_id", "team_name", "team_color", "finishing_position", "classified_position",
    "grid_starting_position", "position_change", "is_retired", "is_classified", "q1_seconds", "q2_seconds",
    "q3_seconds", "has_qualifying_data", "has_complete_qualifying_data", "time_seconds", "status", "laps", "points",
    "has_race_data", "has_complete_race_data", "headshot_url",
]

# Columns of a target.
TARGET_COLUMNS = [
    "event_year", "event", "event_name", "driver_number", "driver_id", "full_name", "abbreviation",
    "team_id", "team_name", "team_color",
]

QUALIFYING_COLUMNS = ["qualifying_position", "q1_seconds", "q2_seconds", "q3_seconds"]

PAYLOAD_SCHEMA = (
    "metadata struct<event_partition_key string, EventName string, event_year int, qualifying_dt_utc string,"
    " race_dt_utc string, circuit_lat double, circuit_lng double, fetched_at_utc string,"
    " forecast_endpoint_mode string>,"
    " daily_features struct<precipitation_sum_mm double, precipitation_probability_max double,"
    " temperature_max_c double, temperature_min_c double, wind_speed_max_kmh double>,"
    " race_hour_features struct<race_hour_temperature_c double, race_hour_precipitation_probability double,"
    " race_hour_precipitation_mm double, race_hour_rain_mm double, race_hour_wind_speed_kmh double,"
    " race_hour_timestamp_utc string, race_hour_offset_minutes int>,"
    " qualifying_hour_features struct<qualifying_hour_temperature_c double,"
    " qualifying_hour_precipitation_probability double, qualifying_hour_precipitation_mm double,"
    " qualifying_hour_rain_mm double, qualifying_hour_wind_speed_kmh double,"
    " qualifying_hour_timestamp_utc string, qualifying_hour_offset_minutes int>,"
    " open_meteo_response struct<daily struct<time array<string>, precipitation_sum array<double>,"
    " precipitation_probability_max array<double>, rain_sum array<double>, temperature_2m_max array<double>,"
    " temperature_2m_min array<double>, wind_speed_10m_max array<double>, wind_gusts_10m_max array<double>>,"
    " hourly struct<time array<string>, temperature_2m array<double>, precipitation_probability array<double>,"
    " precipitation array<double>, rain array<double>, wind_speed_10m array<double>>>"
)

RUN_METADATA_SCHEMA = (
    "run_id string, run_type string, model_config string, config_version string, dataset_ref string,"
    " feature_set_name string, feature_columns array<string>,"
    " metrics struct<precision_at_3 double, recall_at_3 double, spearman double>,"
    " fold_metrics array<struct<held_out_season int, rows bigint, precision_at_3 double, recall_at_3 double,"
    " spearman double>>, train_rows bigint, season_range array<int>, git_commit string, trained_at_utc string"
)


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def conform(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast to the named types; columns a file does not have become typed NULLs."""
    have = set(df.columns)
    return df.select(
        *[(F.col(c).try_cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in types.items()]
    )


def prioritise(df: DataFrame, first: Iterable[str]) -> DataFrame:
    """Columns named in ``first`` in that order, then the others as they come."""
    head = [c for c in first if c in df.columns]
    return df.select(*head, *[c for c in df.columns if c not in head])


def absent_fields(fields: Iterable[str]) -> Column:
    """Names of the fields that are NULL in a row, as an array."""
    return F.filter(
        F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]), lambda name: name.isNotNull()
    )
