"""Casts, flags, times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WET_MM = 1.0
SECTOR_TOLERANCE_SECONDS = 0.1


def to_double(value: Column) -> Column:
    """Number in a text; bad text and the text "nan" become NULL."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def to_long(value: Column) -> Column:
    """Whole number, bad text becomes NULL; goes through double so that '3.0' is read."""
    return F.rint(to_double(value)).try_cast("bigint")


def to_int(value: Column) -> Column:
    return F.rint(to_double(value)).try_cast("int")


def whole(df: DataFrame, name: str) -> Column:
    """Column as a whole number; a column that is one already is taken as it is, so filters on it reach the scan."""
    kind = df.schema[name].dataType.simpleString()
    if kind == "int":
        return F.col(name)
    return (F.col(name).cast("int") if kind in ("bigint", "smallint", "tinyint") else to_int(F.col(name))).alias(name)


def parse_bool(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isin("True", "true", "1"), True).when(text.isin("False", "false", "0"), False)


def round_ms(seconds: Column) -> Column:
    """Half-to-even at the millisecond."""
    return F.rint(seconds * 1000) / 1000


def milliseconds(seconds: Column) -> Column:
    return F.rint(seconds * 1000).cast("bigint")


def duration_seconds(nanoseconds: Column) -> Column:
    return nanoseconds.cast("double") / 1e9


def parse_utc(text: Column) -> Column:
    """UTC wall-clock time of an ISO-8601 text, NULL if it is none; a text without zone is taken as UTC."""
    full = F.regexp_replace(text, r"([T ]\d\d:\d\d)(Z|[+-]\d\d:?\d\d)?$", "$1:00$2")
    zoned = F.when(full.rlike(r"(Z|[+-]\d\d:?\d\d)$") | ~full.contains(":"), full).otherwise(F.concat(full, F.lit("Z")))
    seconds = (F.unix_micros(zoned.try_cast("timestamp")).cast("decimal(24,0)") / 1000000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def format_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Signed distance of two wall-clock times in seconds."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / 1000000


def minute_offset(later: Column, earlier: Column) -> Column:
    """Minutes from ``earlier`` to ``later``, cut toward zero."""
    return (seconds_between(later, earlier) / 60).cast("int")


def valid_lap() -> Column:
    """A timed lap that was not deleted, not a pit lap and not marked inaccurate (unknown counts as fine)."""
    return (
        F.col("lap_time_seconds").isNotNull()
        & ~F.coalesce(F.col("deleted"), F.lit(False))
        & ~F.coalesce(F.col("is_pit_lap"), F.lit(False))
        & F.coalesce(F.col("is_accurate"), F.lit(True))
    )


def is_wet(precipitation_mm: Column, threshold: float = WET_MM) -> Column:
    return F.coalesce(precipitation_mm, F.lit(0.0)) >= threshold


def is_retired_code(position: Column) -> Column:
    return F.coalesce(F.upper(position) == "R", F.lit(False))


def total_sectors(s1: Column, s2: Column, s3: Column) -> Column:
    """Sum of the known sectors, NULL if none is known."""
    total = sum((F.coalesce(s, F.lit(0.0)) for s in (s2, s3)), F.coalesce(s1, F.lit(0.0)))
    return F.when(F.coalesce(s1, s2, s3).isNotNull(), round_ms(total))


def sector_mismatch(s1: Column, s2: Column, s3: Column, lap: Column) -> Column:
    known = s1.isNotNull() & s2.isNotNull() & s3.isNotNull() & lap.isNotNull()
    gap = F.abs(total_sectors(s1, s2, s3) - lap)
    return F.coalesce(known & (gap > SECTOR_TOLERANCE_SECONDS), F.lit(False))


def percentage(part: Column, whole: Column) -> Column:
    """Share in percent, 0 when there is nothing to count."""
    return F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))


def exact(value: Column, scale: int = 4) -> Column:
    """Decimal form, so that sums do not depend on the order in which tasks finish."""
    return value.cast(f"decimal(18,{scale})")
