"""The row of another table that is nearest in time, before or after.

Times are dealt to buckets. Within a bucket the nearest earlier and later row come from one window; across buckets from
the first and last row of the buckets before and behind, which a window over buckets carries over empty ones. Equal times
of a key are one moment, so a bucket holds as many rows as it has moments, and a key as many buckets as its span of time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_SECONDS = 3600 * 24


def _micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


def nearest_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, right_at: str, tie: Sequence[str], bucket: int = BUCKET_SECONDS
) -> DataFrame:
    """``left`` with ``nearest``, the row of ``right`` (as a struct) of the same keys whose time is least far from its own.

    Of two equally far moments the earlier one is taken, of several rows of a moment the first by ``tie``. Without such a
    row, or without a time, ``nearest`` is NULL; null keys match nothing. Rows of ``left`` are kept as often as they occur.
    """
    width = F.lit(bucket * 1_000_000)
    none = lambda df: reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.lit(False))
    asked = left.select(*keys, _micros(F.col(at)).alias("_t")).where(F.col("_t").isNotNull() & ~none(left)).distinct()
    row = F.struct(*right.columns)
    there = right.withColumn("_t", _micros(F.col(right_at))).where(F.col("_t").isNotNull() & ~none(right))
    there = there.groupBy(*keys, "_t").agg(F.min_by(row, F.struct(*tie)).alias("_row"))
    held = there.select(*keys, "_t", F.struct("_t", "_row").alias("_held"), F.lit(False).alias("_asks"))
    axis = held.unionByName(asked.withColumn("_asks", F.lit(True)), allowMissingColumns=True).withColumn("_bucket", F.floor(F.col("_t") / width))

    # What a bucket has first and last, and what the buckets around it have.
    held_first, held_last = F.min_by("_held", "_held._t"), F.max_by("_held", "_held._t")
    ends = axis.groupBy(*keys, "_bucket").agg(held_first.alias("_first"), held_last.alias("_last"))
    along = Window.partitionBy(*keys).orderBy("_bucket")
    before, behind = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(1, Window.unboundedFollowing)
    around = ends.select(
        *keys, "_bucket", F.last("_last", ignorenulls=True).over(before).alias("_earlier"), F.first("_first", ignorenulls=True).over(behind).alias("_later")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_t")
    upto, onward = inside.rangeBetween(Window.unboundedPreceding, 0), inside.rangeBetween(0, Window.unboundedFollowing)
    seen = axis.withColumns({"_low": F.last("_held", ignorenulls=True).over(upto), "_high": F.first("_held", ignorenulls=True).over(onward)})
    met = seen.where("_asks").join(around, [*keys, "_bucket"]).select(
        *keys, "_t", F.coalesce("_low", "_earlier").alias("_low"), F.coalesce("_high", "_later").alias("_high")
    )
    earlier, later = F.col("_t") - F.col("_low._t"), F.col("_high._t") - F.col("_t")
    chosen = F.when(F.col("_high").isNull() | (earlier <= later), F.col("_low._row")).otherwise(F.col("_high._row"))
    found = met.select(*keys, "_t", chosen.alias("nearest"))
    return left.withColumn("_t", _micros(F.col(at))).join(found, [*keys, "_t"], "left").select(*left.columns, "nearest")
