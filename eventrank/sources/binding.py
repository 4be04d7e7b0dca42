"""The given order tables read as a race calendar.

Nations are drivers, months are events, years are seasons, the order status is the session of a result and
the return flag the session of a lap. The tables keep the shape and the key rules of real silver data: one
result per driver and session, lap times that are whole milliseconds, one weather row per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrank.sources.tables import table

# Month -> event name and its slug. The last one has no known coordinates.
EVENT_NAMES = {
    1: ("Bahrain Grand Prix", "bahrain"),
    2: ("Saudi Arabian Grand Prix", "saudi_arabian"),
    3: ("Australian Grand Prix", "australian"),
    4: ("Chinese Grand Prix", "chinese"),
    5: ("Emilia Romagna Grand Prix", "emilia_romagna"),
    6: ("Monaco Grand Prix", "monaco"),
    7: ("British Grand Prix", "british"),
    8: ("Belgian Grand Prix", "belgian"),
    9: ("United States Grand Prix", "united_states"),
    10: ("Mexico City Grand Prix", "mexico_city"),
    11: ("São Paulo Grand Prix", "sao_paulo"),
    12: ("Winter-Cup  Finale", "winter_cup_finale"),
}

# Slot, day of the month and hour of a session; X is the sprint qualifying, which changed its name.
SLOTS = [("P1", "03", "12"), ("X", "05", "12"), ("S", "06", "12"), ("Q", "10", "14"), ("R", "20", "13")]


_NAME = " ".join(f"WHEN {month} THEN '{name}'" for month, (name, _) in EVENT_NAMES.items())
_SLUG = " ".join(f"WHEN {month} THEN '{slug}'" for month, (_, slug) in EVENT_NAMES.items())


def event_columns(when: str) -> list[str]:
    """Year, number, slug and name of the event that a time stamp falls into."""
    return [
        f"year({when}) AS event_year",
        f"month({when}) AS event_number",
        f"CASE month({when}) {_SLUG} END AS event",
        f"CASE month({when}) {_NAME} END AS event_name",
    ]


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(*event_columns("o_orderdate")).distinct()


def results(spark: SparkSession, folder: str) -> DataFrame:
    """One row per nation and session; a session's order is therefore a window over at most 25 rows."""
    keys = ["event_year", "event_number", "event", "event_name", "session", "driver_number"]
    raced = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), on=_same("o_custkey", "c_custkey"))
        .selectExpr(
            *event_columns("o_orderdate"),
            """CASE WHEN o_orderstatus = 'F' THEN 'R' WHEN o_orderstatus = 'O' THEN 'Q'
                    WHEN month(o_orderdate) % 3 = 0 THEN 'S' ELSE 'P1' END AS session""",
            "c_nationkey AS driver_number",
            "cast(o_totalprice AS decimal(18,2)) AS price",
            "o_orderpriority = '1-URGENT' AS urgent",
        )
        .groupBy(*keys)
        .agg({"price": "sum", "urgent": "max", "*": "count"})
        .selectExpr(
            *keys, "`sum(price)` AS total", "`max(urgent)` AS is_retired", "cast(`count(1)` AS int) AS laps",
            """row_number() OVER (PARTITION BY event_year, event, session
                                  ORDER BY `sum(price)` DESC, driver_number) AS pos""",
        )
    )
    return raced.selectExpr(
        *keys,
        "concat('d', driver_number) AS driver_id",
        "concat('Driver ', driver_number) AS full_name",
        "concat('D', lpad(driver_number, 2, '0')) AS abbreviation",
        "concat('t', driver_number % 10) AS team_id",
        "concat('Team ', driver_number % 10) AS team_name",
        "concat('#00000', driver_number % 10) AS team_color",
        "CASE WHEN NOT (is_retired AND pos > 12) THEN pos END AS finishing_position",
        "26 - pos AS grid_starting_position",
        "is_retired",
        "cast(total AS double) AS points",
        "60 + pos * 0.125D AS q1_seconds",
        "CASE WHEN pos <= 15 THEN 59 + pos * 0.125D END AS q2_seconds",
        "CASE WHEN pos <= 10 THEN 58 + pos * 0.125D END AS q3_seconds",
        "CASE WHEN NOT is_retired THEN 5400 + pos * 1.5D END AS time_seconds",
        "laps",
    )


def laps(spark: SparkSession, folder: str) -> DataFrame:
    timed = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "supplier"), on=_same("l_suppkey", "s_suppkey"))
        .join(table(spark, folder, "part"), on=_same("l_partkey", "p_partkey"))
        .selectExpr(
            *event_columns("l_shipdate"),
            """CASE WHEN l_returnflag = 'A' THEN 'R' WHEN l_returnflag = 'N' THEN 'Q'
                    WHEN month(l_shipdate) % 3 = 0 AND l_linestatus = 'F'
                      THEN CASE WHEN year(l_shipdate) < 1998 THEN 'SS' ELSE 'SQ' END
                    ELSE 'P1' END AS session""",
            "s_nationkey", "l_linenumber", "l_quantity", "l_tax", "l_discount", "p_retailprice", "p_type",
            """(cast(round(l_extendedprice * 100) AS bigint) * 20 + cast(l_quantity AS bigint))
               div (2 * cast(l_quantity AS bigint)) AS ms""",
        )
    )
    return timed.selectExpr(
        "event_year", "event_number", "event", "event_name", "session",
        """CASE session WHEN 'R' THEN 'race' WHEN 'Q' THEN 'qualifying' WHEN 'SS' THEN 'sprint_shootout'
             WHEN 'SQ' THEN 'sprint_qualifying' ELSE 'practice' END AS session_type""",
        "s_nationkey AS driver_number",
        "l_linenumber AS lap_number",
        "CASE WHEN l_quantity <> 1 THEN ms / 1000 END AS lap_time_seconds",
        "CASE WHEN l_tax <> 0 THEN (ms div 4) / 1000 END AS sector1_time_seconds",
        "(ms div 4) / 1000 AS sector2_time_seconds",
        "(ms - 2 * (ms div 4)) / 1000 AS sector3_time_seconds",
        "p_retailprice AS speed_fl",
        "l_quantity AS speed_st",
        """CASE p_type WHEN 'SMALL' THEN 'SOFT' WHEN 'MEDIUM' THEN 'MEDIUM' WHEN 'LARGE' THEN 'HARD' END
           AS compound""",
        "CASE WHEN l_discount <> 0 THEN l_discount >= 0.1D END AS deleted",
        "l_quantity >= 49 AS is_pit_lap",
        "CASE WHEN l_tax <> 0 THEN l_tax < 0.08D END AS is_accurate",
    )


def sessions(spark: SparkSession, folder: str, of: DataFrame | None = None) -> DataFrame:
    """Sessions of all events, or of those given."""
    slots = ", ".join(f"('{slot}', '{day}', '{hour}')" for slot, day, hour in SLOTS)
    return (
        (events(spark, folder) if of is None else of)
        .selectExpr("*", f"inline(array({slots})) AS (slot, day, hour)")
        .where("slot IN ('P1', 'Q', 'R') OR event_number % 3 = 0")
        .selectExpr(
            "event_year", "event_number", "event", "event_name",
            "CASE WHEN slot <> 'X' THEN slot WHEN event_year < 1998 THEN 'SS' ELSE 'SQ' END AS session",
            "concat(event_year, '-', lpad(event_number, 2, '0'), '-', day, 'T', hour, ':00:00Z') AS session_date_utc",
        )
    )


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """One row per event but for the last month of a season, which has none."""
    return (
        table(spark, folder, "orders")
        .where("month(o_orderdate) <> 12")
        .selectExpr(*event_columns("o_orderdate"), "o_totalprice AS high", "o_totalprice AS low")
        .groupBy("event_year", "event")
        .agg({"high": "max", "low": "min", "*": "count"})
        .selectExpr(
            "event_year", "event",
            "(`count(1)` % 5) * 0.5D AS precipitation_sum_mm",
            "`max(high)` / 1000 AS temperature_max_c",
            "`min(low)` / 1000 AS temperature_min_c",
            "cast(`count(1)` % 40 AS double) AS wind_speed_max_kmh",
        )
    )


def _same(left: str, right: str):
    return F.expr(f"{left} = {right}")
