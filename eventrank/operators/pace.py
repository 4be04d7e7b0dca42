"""Lap pace per driver and event.

Lap times are whole milliseconds after the silver step, so all sums are taken over integers: results do not
depend on the order in which tasks finish. The laps of a group are first reduced to one row per distinct
millisecond (combined on the map side), and only those rows are put in order for the median. A group that
holds a third of all laps therefore shrinks to at most its longest lap in milliseconds before any task sees
it as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventrank.functions.values import milliseconds, valid_lap, whole
from eventrank.schemas import DRIVER_EVENT_KEYS

COMPOUNDS = ["SOFT", "MEDIUM", "HARD"]
SECTORS = [f"sector{i}_time_seconds" for i in (1, 2, 3)]
SPEEDS = ["speed_fl", "speed_st"]
SQUARE = "decimal(20,0)"


def pace_group() -> Column:
    """The session group whose statistics a lap belongs to."""
    session = F.col("session")
    return (
        F.when(session == "Q", "qualifying")
        .when(session.isin("SQ", "SS"), "sprint_qualifying")
        .when(session == "R", "race")
        .when(F.col("session_type") == "practice", "practice")
    )


def lap_cells(laps: DataFrame, groups: list[str]) -> DataFrame:
    """Valid laps reduced to one row per driver, event, group and distinct lap time."""
    grouped = laps.where(valid_lap()).withColumn("pace_group", pace_group())
    selected = grouped.where(F.col("pace_group").isin(groups)).select(
        whole(laps, "event_year"),
        "event",
        whole(laps, "driver_number"),
        "pace_group",
        milliseconds(F.col("lap_time_seconds")).alias("lap_ms"),
        *SECTORS,
        *SPEEDS,
        "compound",
    )
    return selected.groupBy(*DRIVER_EVENT_KEYS, "pace_group", "lap_ms").agg(
        F.count(F.lit(1)).alias("laps"),
        *[F.min(c).alias(c) for c in SECTORS],
        *[F.max(c).alias(c) for c in SPEEDS],
        *[F.max(F.col("compound") == c).alias(c) for c in COMPOUNDS],
    )


def _ranked(cells: DataFrame) -> DataFrame:
    """Cells with the ranks they cover; partitioned by driver and event so that no later step shuffles again."""
    group = Window.partitionBy(*DRIVER_EVENT_KEYS, "pace_group")
    upto = group.orderBy("lap_ms").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {"upto": F.sum("laps").over(upto), "total": F.sum("laps").over(group)}
    return cells.repartition(*DRIVER_EVENT_KEYS).withColumns(sums)


def _covers(rank: Column) -> Column:
    return (F.col("upto") >= rank) & (F.col("upto") - F.col("laps") < rank)


def _seconds(total_ms: Column, count: Column) -> Column:
    return total_ms / (count * 1000)


def spread(count: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation in seconds from exact sums over milliseconds; NULL for a single lap."""
    n = count.cast(SQUARE)
    scatter = n * squares - total.cast(SQUARE) * total.cast(SQUARE)
    variance = scatter.cast("double") / (count.cast("double") * (count - 1))
    return F.when(count > 1, F.sqrt(variance) / 1000)


def _sums(of: Column | None = None) -> tuple[Column, Column, Column]:
    """Number of laps, sum of milliseconds, sum of their squares; ``of`` limits them to some cells."""
    pick = (lambda c: c) if of is None else (lambda c: F.when(of, c))
    ms, n = F.col("lap_ms"), F.col("laps")
    square = ms.cast(SQUARE) * ms.cast(SQUARE) * n.cast(SQUARE)
    return F.sum(pick(n)), F.sum(pick(n * ms)), F.sum(pick(square.cast("decimal(28,0)")))


def _median(of: Column) -> Column:
    low, high = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    middle = [F.max(F.when(of & _covers(rank), F.col("lap_ms"))) for rank in (low, high)]
    return (middle[0] + middle[1]) / 2000


def _group_columns(group: str) -> list[Column]:
    of = F.col("pace_group") == group
    n, total, squares = _sums(of)
    best = F.min(F.when(of, F.col("lap_ms"))) / 1000
    sectors = [
        F.min(F.when(of, F.col(c))).alias(f"{group}_best_sector{i}_time_seconds") for i, c in enumerate(SECTORS, 1)
    ]
    speeds = [F.max(F.when(of, F.col(c))).alias(f"{group}_max_{c}") for c in SPEEDS]
    head = [best.alias(f"{group}_best_lap_time_seconds"), _median(of).alias(f"{group}_median_lap_time_seconds")]
    if group == "qualifying":
        return head
    if group == "sprint_qualifying":
        return head + sectors + speeds
    if group == "race":
        return [n.alias("race_laps"), total.alias("race_ms"), squares.alias("race_ms_squares")]
    return [
        n.alias("practice_laps_count"),
        *head,
        _seconds(total, n).alias("practice_mean_lap_time_seconds"),
        spread(n, total, squares).alias("practice_std_lap_time_seconds"),
        *sectors,
        *speeds,
        *[
            (F.min(F.when(of & F.col(c), F.col("lap_ms"))) / 1000).alias(f"practice_best_{c.lower()}_lap_time_seconds")
            for c in COMPOUNDS
        ],
    ]


def pace_summary(laps: DataFrame, groups: list[str]) -> DataFrame:
    """Statistics of all ``groups`` in one pass over the laps, one row per driver and event."""
    columns = [c for group in groups for c in _group_columns(group)]
    return _ranked(lap_cells(laps, groups)).groupBy(*DRIVER_EVENT_KEYS).agg(*columns)


def practice_pace(laps: DataFrame) -> DataFrame:
    return pace_summary(laps, ["practice"])


def qualifying_pace(laps: DataFrame) -> DataFrame:
    return pace_summary(laps, ["qualifying"])


def sprint_qualifying_pace(laps: DataFrame) -> DataFrame:
    return pace_summary(laps, ["sprint_qualifying"])


def compound_best(laps: DataFrame) -> DataFrame:
    """Best practice lap on each compound."""
    practice = laps.where(valid_lap() & (F.col("session_type") == "practice"))
    return practice.groupBy(*DRIVER_EVENT_KEYS).agg(
        *[
            F.min(F.when(F.col("compound") == c, F.col("lap_time_seconds"))).alias(f"best_{c.lower()}_lap_time_seconds")
            for c in COMPOUNDS
        ]
    )


def race_lap_sums(laps: DataFrame) -> DataFrame:
    """Exact sums over the valid race laps of each driver and event."""
    race = laps.where(valid_lap() & (F.col("session") == "R")).select(
        whole(laps, "event_year"),
        "event",
        whole(laps, "driver_number"),
        milliseconds(F.col("lap_time_seconds")).alias("lap_ms"),
        F.lit(1).cast("bigint").alias("laps"),
    )
    n, total, squares = _sums()
    return race.groupBy(*DRIVER_EVENT_KEYS).agg(
        n.alias("race_laps"), total.alias("race_ms"), squares.alias("race_ms_squares")
    )


def race_pace_columns(count: Column, total: Column, squares: Column) -> list[Column]:
    return [
        _seconds(total, count).alias("hist_avg_race_lap_time"),
        spread(count, total, squares).alias("hist_race_lap_time_std"),
        count.alias("hist_race_laps_count"),
    ]
