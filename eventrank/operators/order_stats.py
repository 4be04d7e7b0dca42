"""Ranks and medians of groups of any size.

Rows are range-partitioned by group and value, so that a large group spreads over as many partitions as its rows fill and
a constant value over as many as its ties fill. The partitions are stored once with their numbers; the rows before a
partition's part of a group are known from the totals of the earlier parts, so ordering happens within a partition only
and no task has to hold a whole group. Missing values and NaN are not ranked.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventrank.sources.session import stored

# Rows of a group that a task may put in order.
CROWD = 100_000


def _known(df: DataFrame, value: str) -> Column:
    known = F.col(value).isNotNull()
    return known & ~F.isnan(value) if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)) else known


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.where(_known(df, value)).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def sliced(df: DataFrame, order: Sequence[str], slices: int | None = None) -> DataFrame:
    """``df`` with the number of its ``slice``: rows later in the order never have a smaller one, equal rows the same.

    Stored, as the bounds of ranges are found by sampling and would not be the same a second time.
    """
    count = [] if slices is None else [slices]
    return stored(df.repartitionByRange(*count, *order).withColumn("slice", F.spark_partition_id()), "slices")


def offsets(rows: DataFrame, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """For each group and slice the ``sums`` over the group's earlier slices, 0 for the first; a window over slices."""
    totals = rows.groupBy(*keys, "slice").agg(*[c.alias(name) for name, c in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, "slice", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in sums])


def running_counts(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per distinct value, the number of rows of its group with a smaller value as ``below``."""
    rows = sliced(counts, [*keys, value])
    first = offsets(rows, keys, {"offset": F.sum("n")})
    inside = Window.partitionBy(*keys, "slice").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    return rows.join(first, [*keys, "slice"]).withColumn("below", below).select(*counts.columns, "below")


def twice_average_rank() -> Column:
    """Twice the mean rank of equal values, which is a whole number."""
    return 2 * F.col("below") + F.col("n") + 1


def with_average_rank(df: DataFrame, keys: Sequence[str], value: str, weight: str, name: str) -> DataFrame:
    """Rows that stand for ``weight`` rows each, with twice the mean rank of their value in the group as ``name``.

    Rows without a value are left out. Equal values lie in one slice, so no join has to bring ranks back to rows.
    """
    rows = sliced(df.where(_known(df, value)), [*keys, value])
    first = offsets(rows, keys, {"offset": F.sum(weight)})
    inside = Window.partitionBy(*keys, "slice").orderBy(value)
    upto = F.sum(weight).over(inside.rangeBetween(Window.unboundedPreceding, 0))
    equal = F.sum(weight).over(inside.rangeBetween(0, 0))
    joined = rows.join(first, [*keys, "slice"])
    return joined.withColumn(name, 2 * (F.col("offset") + upto) - equal + 1).select(*df.columns, name)


def rank_within(df: DataFrame, keys: Sequence[str], value: str, tie: str, rank: str, crowd: int = CROWD) -> DataFrame:
    """Rank of each row in its group by ``value``, equal values in the order of the number ``tie``.

    Rows without a value or a key are left out. A group of at most ``crowd`` rows is ordered as a whole. Of larger ones only rows
    that are equal in both share a task, and get the ranks there in any order.
    """
    keyed = df.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    crowds = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > crowd)
    crowds = stored(crowds.select(*keys), "crowds")
    known = keyed.where(_known(df, value))
    number = lambda *part: F.row_number().over(Window.partitionBy(*part).orderBy(value, tie))
    if crowds.isEmpty():
        return known.withColumn(rank, number(*keys)).select(*df.columns, rank)
    whole = known.join(F.broadcast(crowds), list(keys), "left_anti").withColumn(rank, number(*keys))
    rows = sliced(known.join(F.broadcast(crowds), list(keys), "left_semi"), [*keys, value, tie])
    first = offsets(rows, keys, {"offset": F.count(F.lit(1))})
    joined = rows.withColumn("place", number(*keys, "slice")).join(first, [*keys, "slice"])
    return whole.select(*df.columns, rank).union(joined.withColumn(rank, (F.col("offset") + F.col("place")).cast("int")).select(*df.columns, rank))


def medians(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Exact median of each group of counted values, the mean of the middle two for an even number."""
    sizes = counts.groupBy(*keys).agg(F.sum("n").alias("size"))
    ranked = running_counts(counts, keys, value).join(sizes, list(keys))
    below, upto, size = F.col("below"), F.col("below") + F.col("n"), F.col("size")
    low, high = F.floor((size + 1) / 2), F.floor(size / 2) + 1

    def at(rank: Column) -> Column:
        return F.max(F.when((below < rank) & (upto >= rank), F.col(value)))

    return ranked.groupBy(*keys).agg(((at(low) + at(high)) / 2).alias("median"))
