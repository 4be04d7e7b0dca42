"""Bronze session files to typed silver tables: one projection each, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrank.functions import values as v
from eventrank.functions.text import clear_tokens, null_if_token, session_type, snake_columns
from eventrank.schemas import SILVER_LAP_COLUMNS, SILVER_RESULT_COLUMNS, prioritise

# Columns of the two tables by type.
LAP_TEXT = [
    "event_name", "session_name", "session", "event", "driver", "team", "deleted_reason",
]
LAP_INTS = [
    "event_year", "driver_number", "lap_number", "stint", "tyre_life", "position", "track_status",
]
LAP_BOOLS = [
    "is_personal_best", "fresh_tyre", "deleted", "is_accurate",
]
LAP_TIMES = [
    "time_seconds", "lap_time_seconds", "lap_start_time_seconds", "sector1_time_seconds", "sector2_time_seconds",
    "sector3_time_seconds", "pit_in_time_seconds", "pit_out_time_seconds", "sector1_session_time_seconds",
    "sector2_session_time_seconds", "sector3_session_time_seconds",
]
LAP_DOUBLES = [
    "speed_i1", "speed_i2", "speed_fl", "speed_st",
]
RESULT_TEXT = [
    "event_name", "event", "session_name", "session", "driver_id", "full_name", "first_name", "last_name",
    "broadcast_name", "abbreviation", "country_code", "team_id", "team_name", "team_color", "headshot_url",
]
RESULT_TIMES = [
    "q1_seconds", "q2_seconds", "q3_seconds", "time_seconds",
]


class _Rows:
    """Columns of raw rows by name and kind.

    A column the files do not have reads as NULL, and one that already has its type is left as it is. Only text
    needs the null tokens cleared: they are no numbers and no flags, so those casts turn them into NULL anyway.
    """

    def __init__(self, df: DataFrame):
        self.df = snake_columns(df)
        self.types = dict(self.df.dtypes)

    def raw(self, name: str) -> Column:
        return F.col(name) if name in self.types else F.lit(None).cast("string")

    def text(self, name: str) -> Column:
        return null_if_token(self.raw(name)) if self.types.get(name) == "string" else self.raw(name).cast("string")

    def double(self, name: str) -> Column:
        return self.raw(name) if self.types.get(name) == "double" else v.to_double(self.raw(name))

    def whole(self, name: str) -> Column:
        kind = self.types.get(name)
        if kind in ("int", "bigint", "smallint"):
            return self.raw(name).cast("int")
        return F.rint(self.double(name)).try_cast("int")

    def flag(self, name: str) -> Column:
        return self.raw(name) if self.types.get(name) == "boolean" else v.parse_bool(self.raw(name))


def bronze_rows(df: DataFrame) -> DataFrame:
    return clear_tokens(snake_columns(df))


def silver_laps(bronze: DataFrame) -> DataFrame:
    rows = _Rows(bronze)
    columns: dict[str, Column] = {c: rows.text(c) for c in LAP_TEXT}
    columns |= {c: rows.whole(c) for c in LAP_INTS}
    columns |= {c: rows.flag(c) for c in LAP_BOOLS}
    columns |= {c: v.round_ms(rows.double(c)) for c in LAP_TIMES}
    columns |= {c: rows.double(c) for c in LAP_DOUBLES}
    # Two spellings of one column are in use; the first is the canonical one.
    columns["fastf1_generated"] = F.coalesce(rows.flag("fastf1_generated"), rows.flag("fast_f1_generated"))
    columns["compound"] = F.upper(rows.text("compound"))
    columns["lap_start_date"] = rows.raw("lap_start_date").try_cast("timestamp_ntz")
    typed = rows.df.select(*[c.alias(name) for name, c in columns.items()])
    sectors = [F.col(f"sector{i}_time_seconds") for i in (1, 2, 3)]
    derived = typed.withColumns({
        "is_pit_lap": F.col("pit_in_time_seconds").isNotNull() | F.col("pit_out_time_seconds").isNotNull(),
        "total_sector_time_seconds": v.total_sectors(*sectors),
        "sector_time_mismatch": v.sector_mismatch(*sectors, F.col("lap_time_seconds")),
        "session_type": session_type(F.col("session_name")),
    })
    return prioritise(derived, SILVER_LAP_COLUMNS)


def position_columns(position: Column, classified: Column) -> dict[str, Column]:
    """Retirement is read from both position columns before their letters are turned into NULLs."""
    return {
        "is_retired": v.is_retired_code(position) | v.is_retired_code(classified),
        "finishing_position": v.to_int(position),
        "classified_position": v.to_int(classified),
        "is_classified": v.to_double(classified).isNotNull(),
    }


def session_flags(kind: Column) -> dict[str, Column]:
    known = {f"is_{name}": kind == name for name in ("practice", "qualifying", "sprint_qualifying", "sprint_shootout", "race")}
    known["is_sprint"] = kind.isin("sprint", "sprint_qualifying", "sprint_shootout")
    return {name: F.coalesce(flag, F.lit(False)) for name, flag in known.items()}


def completeness_flags() -> dict[str, Column]:
    q = [F.col(f"q{i}_seconds").isNotNull() for i in (1, 2, 3)]
    time, status, laps = (F.col(c).isNotNull() for c in ("time_seconds", "status", "laps"))
    driven = F.coalesce(F.col("laps") > 0, F.lit(False))
    return {
        "has_complete_qualifying_data": q[0] & q[1] & q[2],
        "has_qualifying_data": q[0] | q[1] | q[2],
        "has_complete_race_data": time & status & laps,
        "has_race_data": time | status | driven,
    }


def position_change() -> Column:
    return F.when(F.col("is_race"), F.col("grid_starting_position") - F.col("finishing_position"))


def silver_results(bronze: DataFrame) -> DataFrame:
    rows = _Rows(bronze)
    columns: dict[str, Column] = {c: rows.text(c) for c in RESULT_TEXT}
    columns |= position_columns(rows.text("position"), rows.text("classified_position"))
    columns |= {c: rows.whole(c) for c in ("event_year", "driver_number", "laps")}
    columns["grid_starting_position"] = rows.whole("grid_position")
    columns |= {c: v.round_ms(rows.double(c)) for c in RESULT_TIMES}
    columns["points"] = rows.double("points")
    columns["status"] = F.trim(rows.text("status"))
    columns["session_type"] = session_type(rows.text("session_name"))
    typed = rows.df.select(*[c.alias(name) for name, c in columns.items()])
    flagged = typed.withColumns({**session_flags(F.col("session_type")), **completeness_flags()})
    return prioritise(flagged.withColumn("position_change", position_change()), SILVER_RESULT_COLUMNS)


def dim_sessions(tracking: DataFrame, slug) -> DataFrame:
    """Calendar of sessions from the tracking table; rows without year, name or session are no sessions."""
    named = (F.col("EventName") != "") & (F.col("session_name_abr") != "")
    return tracking.where(F.col("event_year").isNotNull() & named).select(
        v.to_int(F.col("event_year")).alias("event_year"),
        v.to_int(F.col("event_number")).alias("event_number"),
        F.col("EventName").alias("event_name"),
        slug(F.col("EventName")).alias("event"),
        "event_partition_key",
        F.col("session_name_abr").alias("session"),
        "session_name",
        "session_date_utc",
        "event_format",
        F.col("is_before_race").cast("boolean").alias("is_before_race"),
    )
