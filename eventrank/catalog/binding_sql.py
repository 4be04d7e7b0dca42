"""The same calendar as ``eventrank.sources.binding``, stated in SQL for the expected results."""

from eventrank.sources.binding import EVENT_NAMES

_NAME = " ".join(f"WHEN {k} THEN '{name}'" for k, (name, _) in EVENT_NAMES.items())
_SLUG = " ".join(f"WHEN {k} THEN '{slug}'" for k, (_, slug) in EVENT_NAMES.items())

BINDING = f"""
WITH b_months AS (
  SELECT m, CASE m {_NAME} END AS event_name, CASE m {_SLUG} END AS event
  FROM (SELECT unnest(range(1, 13)) AS m)),
b_res0 AS (
  SELECT year(o_orderdate) AS event_year, month(o_orderdate) AS event_number,
    CASE WHEN o_orderstatus = 'F' THEN 'R' WHEN o_orderstatus = 'O' THEN 'Q'
         WHEN month(o_orderdate) % 3 = 0 THEN 'S' ELSE 'P1' END AS session,
    c_nationkey AS driver_number,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total,
    max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) = 1 AS is_retired,
    CAST(count(*) AS INTEGER) AS laps
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2, 3, 4),
b_res1 AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY event_year, event_number, session
                                    ORDER BY total DESC, driver_number) AS INTEGER) AS pos FROM b_res0),
b_results AS (
  SELECT CAST(event_year AS INTEGER) AS event_year, CAST(event_number AS INTEGER) AS event_number, event, event_name,
    session, driver_number,
    'd' || driver_number AS driver_id, 'Driver ' || driver_number AS full_name,
    'D' || lpad(CAST(driver_number AS VARCHAR), 2, '0') AS abbreviation,
    't' || (driver_number % 10) AS team_id, 'Team ' || (driver_number % 10) AS team_name,
    '#00000' || (driver_number % 10) AS team_color,
    CASE WHEN is_retired AND pos > 12 THEN NULL ELSE pos END AS finishing_position,
    26 - pos AS grid_starting_position, is_retired, CAST(total AS DOUBLE) AS points,
    60 + pos * 0.125E0 AS q1_seconds,
    CASE WHEN pos <= 15 THEN 59 + pos * 0.125E0 END AS q2_seconds,
    CASE WHEN pos <= 10 THEN 58 + pos * 0.125E0 END AS q3_seconds,
    CASE WHEN NOT is_retired THEN 5400 + pos * 1.5E0 END AS time_seconds, laps
  FROM b_res1 JOIN b_months ON m = event_number),
b_lap0 AS (
  SELECT lineitem.*, s_nationkey, p_retailprice, p_type,
    (CAST(round(l_extendedprice * 100) AS BIGINT) * 20 + CAST(l_quantity AS BIGINT))
      // (2 * CAST(l_quantity AS BIGINT)) AS ms
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey),
b_laps AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS event_year, CAST(month(l_shipdate) AS INTEGER) AS event_number,
    event, event_name,
    CASE WHEN l_returnflag = 'A' THEN 'R' WHEN l_returnflag = 'N' THEN 'Q'
         WHEN month(l_shipdate) % 3 = 0 AND l_linestatus = 'F'
           THEN CASE WHEN year(l_shipdate) < 1998 THEN 'SS' ELSE 'SQ' END
         ELSE 'P1' END AS session,
    s_nationkey AS driver_number, l_linenumber AS lap_number,
    CASE WHEN l_quantity = 1 THEN NULL ELSE ms END AS lap_ms,
    CASE WHEN l_quantity = 1 THEN NULL ELSE ms / 1000E0 END AS lap_time_seconds,
    CASE WHEN l_tax = 0 THEN NULL ELSE (ms // 4) / 1000E0 END AS sector1_time_seconds,
    (ms // 4) / 1000E0 AS sector2_time_seconds,
    (ms - 2 * (ms // 4)) / 1000E0 AS sector3_time_seconds,
    p_retailprice AS speed_fl, l_quantity AS speed_st,
    CASE p_type WHEN 'SMALL' THEN 'SOFT' WHEN 'MEDIUM' THEN 'MEDIUM' WHEN 'LARGE' THEN 'HARD' END AS compound,
    CASE WHEN l_discount = 0 THEN NULL ELSE l_discount >= 0.1E0 END AS deleted,
    l_quantity >= 49 AS is_pit_lap,
    CASE WHEN l_tax = 0 THEN NULL ELSE l_tax < 0.08E0 END AS is_accurate
  FROM b_lap0 JOIN b_months ON m = month(l_shipdate)),
b_valid AS (
  SELECT * FROM b_laps WHERE lap_time_seconds IS NOT NULL AND COALESCE(deleted, FALSE) = FALSE
    AND COALESCE(is_pit_lap, FALSE) = FALSE AND COALESCE(is_accurate, TRUE) = TRUE),
b_slots AS (
  SELECT * FROM (VALUES ('P1', '03', '12'), ('X', '05', '12'), ('S', '06', '12'), ('Q', '10', '14'), ('R', '20', '13'))
    AS v(s, dd, hh)),
b_events AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS event_year, CAST(month(o_orderdate) AS INTEGER) AS event_number,
    event, event_name
  FROM orders JOIN b_months ON m = month(o_orderdate)),
b_dim AS (
  SELECT event_year, event_number, event, event_name,
    CASE WHEN s <> 'X' THEN s WHEN event_year < 1998 THEN 'SS' ELSE 'SQ' END AS session,
    event_year || '-' || lpad(CAST(event_number AS VARCHAR), 2, '0') || '-' || dd || 'T' || hh || ':00:00Z'
      AS session_date_utc
  FROM b_events CROSS JOIN b_slots
  WHERE s IN ('P1', 'Q', 'R') OR event_number % 3 = 0),
b_weather AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS event_year, event,
    CAST(count(*) % 5 AS DOUBLE) * 0.5E0 AS precipitation_sum_mm,
    max(o_totalprice) / 1000 AS temperature_max_c, min(o_totalprice) / 1000 AS temperature_min_c,
    CAST(count(*) % 40 AS DOUBLE) AS wind_speed_max_kmh
  FROM orders JOIN b_months ON m = month(o_orderdate) WHERE month(o_orderdate) <> 12 GROUP BY 1, 2),
"""


def with_binding(ctes: str, select: str) -> str:
    """Expected-result query: the calendar, further named steps (may be empty), the final SELECT."""
    steps = ctes.strip().rstrip(",")
    if steps:
        return f"{BINDING}{steps}\n{select.strip()}"
    return f"{BINDING.rstrip().rstrip(',')}\n{select.strip()}"
