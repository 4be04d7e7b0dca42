"""Scan and sink queries: data derived from the tables is written to the lake and read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventrank.catalog.binding_sql import with_binding
from eventrank.catalog.features import ENTRIES, FORM, bound_form, bound_targets
from eventrank.catalog.registry import register
from eventrank.catalog.tracking import TRACKING
from eventrank.plans.gold import training_dataset
from eventrank.schemas import DRIVER_EVENT_KEYS, SESSION_KEYS
from eventrank.sources import binding, calendar, drift, lake, snapshots
from eventrank.sources.session import scratch_folder, stored
from eventrank.sources.tables import SCHEMAS, table

COLUMNS = ["event_year", "event", "session", "driver_number", "finishing_position", "q3_seconds", "points"]
SCHEMA = (
    "driver_number bigint, finishing_position int, q3_seconds double, points double,"
    " event_year int, event string, session string"
)
DRIFT_YEAR = 1998
CORRUPT_YEAR = 1900
EMPTY_YEAR = 1901
ROLLING = ["event_year", "event", "driver_number", "season_points_to_date", "last3_race_points", "last3_race_count"]


def _results(spark, folder):
    return binding.results(spark, folder).select(*COLUMNS)


def _stored(spark, folder):
    """Results in the lake whose older seasons have one column less and a narrower type than the newer ones."""
    path = scratch_folder(spark, "results")
    rows = _results(spark, folder)
    old = rows.where(F.col("event_year") < DRIFT_YEAR).drop("q3_seconds")
    new = rows.where(F.col("event_year") >= DRIFT_YEAR).withColumn("driver_number", F.col("driver_number").cast("bigint"))
    for part in (old, new):
        lake.write_partitioned(part, path, SESSION_KEYS, whole=False)
    return path


_STORED_SQL = f"""
SELECT event_year, event, session, CAST(driver_number AS BIGINT) AS driver_number, finishing_position,
  CASE WHEN event_year >= {DRIFT_YEAR} THEN q3_seconds END AS q3_seconds, points
FROM b_results
"""


@register(with_binding("", _STORED_SQL))
def scan_partitioned(spark, folder):
    return lake.read_partitioned(spark, _stored(spark, folder), SCHEMA, SESSION_KEYS)


@register(with_binding("", _STORED_SQL + "WHERE event_year = 1999 AND event = 'monaco' AND session = 'Q'"))
def scan_pruned(spark, folder):
    return lake.read_session(spark, _stored(spark, folder), SCHEMA, 1999, "monaco", "Q")


@register(with_binding("", f"""
SELECT event_year, count(*) AS rows, CAST(0 AS BIGINT) AS failed_files FROM b_results GROUP BY 1
UNION ALL SELECT {CORRUPT_YEAR}, 0, 1"""))
def scan_bulk(spark, folder):
    """Season folders; one holds a file that is no Parquet file, and one more holds a file without rows, which is fine."""
    path = scratch_folder(spark, "bulk")
    rows = _results(spark, folder)
    rows.withColumn("season", F.col("event_year")).hint("rebalance", "season").write.partitionBy("season").parquet(path)
    rows.agg(F.max(F.lit("not a table")).alias("value")).write.text(f"{path}/season={CORRUPT_YEAR}")
    rows.where("event_year IS NULL").coalesce(1).write.parquet(f"{path}/season={EMPTY_YEAR}")
    schema = "event_year int, driver_number int"
    status = stored(lake.bulk_status(spark, [path], schema), "status")
    season = F.regexp_extract("file_path", "season=([0-9]+)/", 1).cast("int").alias("event_year")
    good = lake.read_bulk(spark, [path], schema, status).select(season, F.lit(1).alias("row"))
    bad = lake.failed_files(status).select(season, F.lit(1).alias("failed"))
    return good.unionByName(bad, allowMissingColumns=True).groupBy("event_year").agg(
        F.count("row").alias("rows"), F.count("failed").alias("failed_files")
    )


@register(with_binding("", """
SELECT CASE WHEN event_number <> 12 THEN event_year END AS event_year, event, session, driver_number, finishing_position,
  q3_seconds, points
FROM b_results"""))
def sink_null_partition(spark, folder):
    """NULL in a numeric partition column."""
    path = scratch_folder(spark, "sink")
    known = F.when(F.col("event_number") != 12, F.col("event_year")).alias("event_year")
    rows = binding.results(spark, folder).withColumn("event_year", known).select(*COLUMNS)
    lake.write_partitioned(rows, path, SESSION_KEYS)
    return lake.read_partitioned(spark, path, SCHEMA.replace("driver_number bigint", "driver_number int"), SESSION_KEYS)


@register(with_binding("", """
SELECT count(*) AS rows, TRUE AS replaced, CAST(0 AS BIGINT) AS errors FROM b_results"""))
def sink_report(spark, folder):
    """The report of a write over older data."""
    path = scratch_folder(spark, "sink")
    rows = _results(spark, folder)
    lake.write_partitioned(rows.where(F.col("event_year") < DRIFT_YEAR), path, SESSION_KEYS)
    report = lake.write_partitioned(rows, path, SESSION_KEYS)
    counted = lake.read_partitioned(spark, path, SCHEMA, SESSION_KEYS).agg(F.count(F.lit(1)).alias("rows"))
    facts = {"replaced": F.lit(report.deleted > 0), "errors": F.lit(len(report.errors)).cast("bigint")}
    return counted.withColumns(facts)


@register(with_binding(ENTRIES, """
SELECT event_year, event, driver_number, qualifying_position, '20260228T042635Z' AS run_id FROM entry"""))
def publish_run(spark, folder):
    """Two published runs; the pointer names the second."""
    path = scratch_folder(spark, "published")
    targets = bound_targets(spark, folder).select("event_year", "event", "driver_number", "qualifying_position")
    about = targets.agg(F.count(F.lit(1)).alias("rows"))
    lake.publish_run(targets.where(F.col("event_year") < 2000), path, "20260101T000000Z", about)
    lake.publish_run(targets, path, "20260228T042635Z", about)
    return lake.read_published(spark, path)


@register(with_binding(ENTRIES, "SELECT event_year, event, driver_number, 'Q' AS session FROM entry WHERE event_year = 1999 AND event = 'monaco'"))
def land_session(spark, folder):
    """Raw rows of one session in the landing layout, stamped with their session."""
    rows = _results(spark, folder).where("event_year = 1999 AND event = 'monaco' AND session = 'Q'")
    path = lake.land(rows.select("driver_number"), scratch_folder(spark, "landing"), 1999, "monaco", "Q")
    return spark.read.parquet(path)


@register(with_binding("", """
SELECT event_year, CASE WHEN event_number <> 12 THEN event || '_' || event_number END AS event, session, driver_number,
  finishing_position, q3_seconds, points
FROM b_results"""))
def sink_partitioned(spark, folder):
    """Partition values with a slash are made path-safe and NULL comes back as NULL."""
    path = scratch_folder(spark, "sink")
    slashed = F.when(
        F.col("event_number") != 12, F.concat("event", F.lit("/"), F.col("event_number").cast("string"))
    )
    rows = binding.results(spark, folder).withColumn("event", slashed).select(*COLUMNS)
    lake.write_partitioned(rows, path, SESSION_KEYS)
    return lake.read_partitioned(spark, path, SCHEMA.replace("driver_number bigint", "driver_number int"), SESSION_KEYS)


@register(with_binding("", """
SELECT count(*) AS rows, count(DISTINCT (event_year, event, session)) AS partitions FROM b_results"""))
def sink_counters(spark, folder):
    path = scratch_folder(spark, "counted")
    lake.write_partitioned(_results(spark, folder), path, SESSION_KEYS)
    return lake.write_summary(spark, path, SESSION_KEYS).select("rows", "partitions")


def _runs(spark, folder):
    """Two runs over the target table; the second is the newer."""
    path = scratch_folder(spark, "runs")
    targets = bound_targets(spark, folder).select("event_year", "event", "driver_number", "qualifying_position")
    lake.write_run(targets.where(F.col("event_year") < 2000), path, "20260101T000000Z")
    lake.write_run(targets, path, "20260228T042635Z")
    return path


@register(with_binding(ENTRIES, """
SELECT event_year, event, driver_number, qualifying_position, '20260228T042635Z' AS run_id FROM entry"""))
def sink_run(spark, folder):
    return lake.read_latest(spark, _runs(spark, folder))


@register(with_binding(TRACKING, "SELECT max(run_id) AS run_id FROM runs"))
def latest_run(spark, folder):
    """One run folder per season."""
    path = scratch_folder(spark, "seasons")
    calendar.model_runs(spark, folder).write.partitionBy("run_id").parquet(path)
    return lake.latest_run(lake.list_files(spark, [path]))


@register(with_binding(ENTRIES + FORM, """
SELECT event_year, event, driver_number, season_points_to_date, last3_race_points, last3_race_count FROM form"""))
def csv_roundtrip(spark, folder):
    path = scratch_folder(spark, "csv")
    lake.write_csv(bound_form(spark, folder).select(*ROLLING), path)
    return lake.read_csv(
        spark, path,
        "event_year int, event string, driver_number int, season_points_to_date double, last3_race_points double,"
        " last3_race_count bigint",
    )


@register(with_binding(TRACKING, "SELECT * FROM t"))
def tracking_dump(spark, folder):
    path = scratch_folder(spark, "dump")
    rows = calendar.tracking(spark, folder)
    lake.write_json(rows, path)
    return lake.read_json(spark, path, ", ".join(f"{n} {kind}" for n, kind in rows.dtypes))


@register(with_binding("", """
SELECT event_year, event, session, driver_number, q1_seconds, CAST(NULL AS DOUBLE) AS time_seconds
FROM b_results WHERE session = 'Q'
UNION ALL BY NAME
SELECT event_year, event, session, driver_number, time_seconds FROM b_results WHERE session <> 'Q'"""))
def union_by_name(spark, folder):
    rows = binding.results(spark, folder)
    head = ["event_year", "event", "session", "driver_number"]
    qualifying = rows.where(F.col("session") == "Q").select(*head, "q1_seconds")
    others = rows.where(F.col("session") != "Q").select("time_seconds", *head)
    return qualifying.unionByName(others, allowMissingColumns=True)


@register(with_binding("", f"""
SELECT 1 AS version, event_year, session, count(*) AS rows, sum(driver_number)::BIGINT AS drivers FROM b_results
WHERE event_year < {DRIFT_YEAR} GROUP BY ALL
UNION ALL
SELECT 2, event_year, session, count(*), sum(driver_number)::BIGINT FROM b_results GROUP BY ALL"""))
def snapshot_overwrite(spark, folder):
    """Results replaced as a whole: the version before can still be read, rows of a commit that was broken off cannot."""
    path = scratch_folder(spark, "snapshots")
    rows = _results(spark, folder)
    snapshots.write_snapshot(rows.where(F.col("event_year") < DRIFT_YEAR), path, ["event_year"])
    rows.withColumn("lot", F.lit("broken-0-base")).write.mode("append").partitionBy("lot", "event_year").parquet(f"{path}/data")
    snapshots.write_snapshot(rows, path, ["event_year"])
    schema = "driver_number int, session string, event_year int"
    found = [
        snapshots.read_snapshot(spark, path, schema, version).withColumn("version", F.lit(version))
        for version in snapshots.versions(spark, path)
    ]
    both = found[0].unionByName(found[1]).groupBy("version", "event_year", "session")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.sum("driver_number").alias("drivers"))


EVENT_KEYS_LAST = (["user_id", "event_type"], ["ts", "event_id"])


def _events_by_key(spark, folder):
    """The last event of each user and type, from three deliveries of which the last repeats the first."""
    path = scratch_folder(spark, "keyed")
    events = table(spark, folder, "events")
    late = F.col("event_type") == "purchase"
    for part in (events.where(~late), events.where(late), events.where(~late)):
        snapshots.merge(part, path, *EVENT_KEYS_LAST, by=["user_id"])
    return path


@register("""
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def delta_merge(spark, folder):
    return snapshots.read_merged(spark, _events_by_key(spark, folder), SCHEMAS["events"], *EVENT_KEYS_LAST)


@register("""
SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def keyed_lookup(spark, folder):
    """All last events of some users; only the groups that these fall into are read."""
    users = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    path = _events_by_key(spark, folder)
    return snapshots.lookup(spark, path, SCHEMAS["events"], *EVENT_KEYS_LAST, users)


# Seasons from which on a column had another type: a number, a longer one, one with a fraction, and text at last.
LONG_YEAR, DOUBLE_YEAR, TEXT_YEAR = 1996, 1998, 2000


def _drifted(spark, folder):
    """Results whose driver number was delivered in four types and whose points were text for some time."""
    path = scratch_folder(spark, "drifted")
    rows = _results(spark, folder).select("event_year", "event", "session", "driver_number", "points")
    forms = [("int", 0, LONG_YEAR), ("bigint", LONG_YEAR, DOUBLE_YEAR), ("double", DOUBLE_YEAR, TEXT_YEAR), ("string", TEXT_YEAR, 9999)]
    for kind, first, end in forms:
        part = rows.where((F.col("event_year") >= first) & (F.col("event_year") < end))
        points = F.col("points").cast("decimal(18,2)").cast("string") if kind == "bigint" else F.col("points")
        columns = {"driver_number": F.col("driver_number").cast(kind), "points": points}
        part.withColumns(columns).write.mode("append").parquet(f"{path}/from={first}")
    return path


@register(with_binding("", f"""
SELECT event_year, event, session, CAST(driver_number AS BIGINT) AS driver_number, points,
  CAST(driver_number AS VARCHAR) || CASE WHEN event_year >= {DOUBLE_YEAR} AND event_year < {TEXT_YEAR} THEN '.0' ELSE '' END AS widened
FROM b_results"""))
def scan_type_drift(spark, folder):
    """One column as int, bigint, double and text, read in the wanted type and in the one that holds them all."""
    path = _drifted(spark, folder)
    schema = "event_year int, event string, session string, driver_number bigint, points double"
    status = stored(lake.bulk_status(spark, [path], schema), "status")
    rows = drift.read_drifting(spark, [path], schema, status=status)
    wide = drift.read_drifting(spark, [path], schema, widen=True, status=status)
    keys = ["event_year", "event", "session", "driver_number"]
    as_number = F.col("driver_number").cast("double").cast("bigint")
    return rows.join(wide.select(*keys[:3], as_number.alias("driver_number"), F.col("driver_number").alias("widened")), keys)


@register(with_binding("", f"""
SELECT event_year, count(*) AS rows, event_year < {DRIFT_YEAR} AS known, TRUE AS good FROM b_results GROUP BY event_year"""))
def scan_incremental(spark, folder):
    """Season folders checked after each of two deliveries; the second call reads the new files only."""
    path, state = scratch_folder(spark, "landing"), scratch_folder(spark, "checked")
    rows = _results(spark, folder).withColumn("season", F.col("event_year"))
    schema = "event_year int, driver_number int"
    for part in (F.col("event_year") < DRIFT_YEAR, F.col("event_year") >= DRIFT_YEAR):
        rows.where(part).hint("rebalance", "season").write.mode("append").partitionBy("season").parquet(path)
        status = drift.checked_files(spark, [path], schema, state)
    season = F.regexp_extract("file_path", "season=([0-9]+)/", 1).cast("int").alias("event_year")
    return status.groupBy(season).agg(F.sum("read").alias("rows"), F.every("known").alias("known"), F.every("good").alias("good"))


@register(with_binding(ENTRIES, """
SELECT row_number() OVER (ORDER BY e.event_year, e.event, e.driver_number) AS position, e.event_year, e.event, e.driver_number,
  r.finishing_position AS race_finishing_position
FROM entry e LEFT JOIN b_results r ON r.session = 'R' AND r.event_year = e.event_year AND r.event = e.event
  AND r.driver_number = e.driver_number"""))
def training_order(spark, folder):
    """The training set in its total order, and the place of each row as it lies in the files, one after the other."""
    path = scratch_folder(spark, "ordered")
    rows = training_dataset(bound_targets(spark, folder), binding.results(spark, folder))
    columns = [*DRIVER_EVENT_KEYS, "race_finishing_position"]
    lake.write_partitioned(rows.select(*columns), path, [], order=DRIVER_EVENT_KEYS)
    found = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    sizes = found.groupBy("file").agg(F.count(F.lit(1)).alias("size"))
    # The window sees one row per file.
    first = sizes.select("file", (F.sum("size").over(Window.partitionBy().orderBy("file")) - F.col("size")).alias("first"))
    return found.join(first, "file").select((F.col("first") + F.col("row") + 1).alias("position"), *columns)
