"""Model, run report and streaming queries."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventrank.catalog.binding_sql import with_binding
from eventrank.catalog.evaluation import LABELLED, candidate_frame, known, labelled
from eventrank.catalog.registry import register
from eventrank.operators import evaluation as e
from eventrank.operators import model as m
from eventrank.operators import ranking, reports
from eventrank.schemas import DRIVER_EVENT_KEYS, EVENT_KEYS, RUN_METADATA_SCHEMA
from eventrank.sources import calendar, lake, snapshots
from eventrank.sources.session import scratch_folder, stored
from eventrank.sources.tables import table
from eventrank.streaming import ingest

HELD_OUT = 2000
IMPUTED = ["qualifying_position", "q2_seconds", "q3_seconds"]
EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@register(with_binding(LABELLED + f"""
med AS (
  SELECT median(qualifying_position) AS mq, median(q2_seconds) AS m2, median(q3_seconds) AS m3
  FROM lab WHERE event_year <> {HELD_OUT}),""", f"""
SELECT {', '.join(DRIVER_EVENT_KEYS)}, COALESCE(CAST(qualifying_position AS DOUBLE), mq) AS qualifying_position,
  COALESCE(q2_seconds, m2) AS q2_seconds, COALESCE(q3_seconds, m3) AS q3_seconds
FROM lab CROSS JOIN med"""))
def impute_median(spark, folder):
    rows = labelled(spark, folder)
    values = m.feature_medians(rows.where(F.col("event_year") != HELD_OUT), IMPUTED)
    return m.impute(rows, values).select(*DRIVER_EVENT_KEYS, *IMPUTED)


@register(with_binding(LABELLED + """
cell AS (
  SELECT event_year, unnest(['qualifying_position', 'q2_seconds', 'q3_seconds']) AS feature,
    unnest([CAST(qualifying_position AS DOUBLE), q2_seconds, q3_seconds]) AS value
  FROM lab),""", """
SELECT s.event_year, feature, median(value) AS median
FROM (SELECT DISTINCT event_year FROM lab) s JOIN cell ON cell.event_year <> s.event_year
WHERE value IS NOT NULL GROUP BY s.event_year, feature"""))
def loso_medians(spark, folder):
    """The medians of all seasons but one, for each season, from one counted table."""
    return m.fold_medians(labelled(spark, folder), IMPUTED)


@register("""
WITH c AS (
  SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL
    WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN '2-HIGH' ELSE o_orderpriority END AS category
  FROM orders),
known AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS code
          FROM (SELECT DISTINCT category FROM c WHERE o_orderstatus = 'F' AND category IS NOT NULL)),
usual AS (SELECT category AS fill FROM c WHERE o_orderstatus = 'F' AND category IS NOT NULL GROUP BY 1
          ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT o_orderkey, COALESCE(c.category, fill) AS category, CAST(COALESCE(code, -1) AS INTEGER) AS code
FROM c CROSS JOIN usual LEFT JOIN known ON known.category = COALESCE(c.category, fill)""")
def ordinal_encode(spark, folder):
    """Order priorities; the training part lacks one category and some rows lack the value."""
    priority, trained = F.col("o_orderpriority"), F.col("o_orderstatus") == "F"
    category = (
        F.when(priority == "3-MEDIUM", None).when(trained & (priority == "1-URGENT"), "2-HIGH").otherwise(priority)
    )
    rows = table(spark, folder, "orders").withColumn("category", category)
    return m.ordinal_codes(rows.where(trained), rows, "category", "code").select("o_orderkey", "category", "code")


@register(with_binding(LABELLED, """
SELECT event_year AS held_out_season, count(*) AS test_rows,
  CAST((SELECT count(*) FROM known) AS BIGINT) - count(*) AS train_rows
FROM known GROUP BY 1"""))
def loso_folds(spark, folder):
    return m.season_folds(known(spark, folder))


def _beats_mean(rows):
    """Whether the predictions of labelled rows are nearer to the outcome, by mean square, than the outcome's mean."""
    label, error = F.col(e.LABEL), F.col("prediction") - F.col(e.LABEL)
    return rows.where(label.isNotNull()).agg((F.avg(error * error) < F.var_pop(label)).alias("beats_mean"))


@register(with_binding(LABELLED, f"""
SELECT {', '.join(DRIVER_EVENT_KEYS)}, TRUE AS is_place, TRUE AS beats_mean FROM lab WHERE race_finishing_position IS NOT NULL"""))
def gbt_scores(spark, folder):
    """Boosted trees at their full setting over the candidate features, fitted on all seasons but one.

    Fitted numbers cannot be stated in SQL. What can: every driver and event has one prediction, it lies among the places
    that occur, and over the seasons of the fit the predictions are better than the mean place.
    """
    rows = stored(candidate_frame(spark, folder), "candidates")
    trained = F.col("event_year") != HELD_OUT
    predicted = stored(m.fit_predict(rows.where(trained), rows, e.CANDIDATE_FEATURES), "predictions")
    places = rows.where(trained).agg(F.min(e.LABEL).alias("first"), F.max(e.LABEL).alias("last"))
    (low, high), (better,) = places.first(), _beats_mean(predicted.where(trained)).first()
    is_place = F.col("prediction").between(low - 0.5, high + 0.5)
    return predicted.select(*DRIVER_EVENT_KEYS, is_place.alias("is_place"), F.lit(better).alias("beats_mean"))


@register(with_binding(LABELLED, """
SELECT event_year, event, count(*) AS drivers, TRUE AS ranks_are_one_to_n FROM lab
WHERE qualifying_position IS NOT NULL GROUP BY event_year, event"""))
def score_run(spark, folder):
    """All entries scored by a model that was fitted, saved and loaded again; positions come as text, some are unreadable."""
    rows = stored(known(spark, folder).select(*DRIVER_EVENT_KEYS, "qualifying_position", e.LABEL), "fold")
    model, values = m.fit(rows.where(F.col("event_year") != HELD_OUT), ["qualifying_position"])
    path = scratch_folder(spark, "model")
    model.write().overwrite().save(path)
    entries = labelled(spark, folder).select(*DRIVER_EVENT_KEYS, "qualifying_position")
    raw = F.coalesce(F.col("qualifying_position").cast("string"), F.lit("none"))
    entries = entries.withColumn("qualifying_position", raw)
    return _ranked(m.score_rows(entries, PipelineModel.load(path), values, ["qualifying_position"]))


def _ranked(scored):
    n = F.count(F.lit(1))
    numbered = (F.count_distinct("predicted_rank") == n) & (F.min("predicted_rank") == 1) & (F.max("predicted_rank") == n)
    return scored.groupBy(*EVENT_KEYS).agg(n.alias("drivers"), numbered.alias("ranks_are_one_to_n"))


@register(with_binding(LABELLED, """
SELECT event_year, count(*) AS rows, TRUE AS metrics_in_range FROM known GROUP BY event_year"""))
def loso_cv(spark, folder):
    """Metrics of each season by full boosted trees over the baseline feature that were fitted on the other seasons."""
    rows = stored(known(spark, folder).select(*DRIVER_EVENT_KEYS, "qualifying_position", e.LABEL), "folds")
    found = e.fold_metrics(m.cross_validate(rows, ["qualifying_position"]))
    shares = [F.col(c).between(0, 1) for c in ("precision_at_3", "recall_at_3", "precision_at_10", "recall_at_10")]
    in_range = reduce(lambda a, b: a & b, [*shares, F.col("spearman").between(-1, 1)])
    return found.select("event_year", "rows", in_range.alias("metrics_in_range"))


@register(with_binding(LABELLED, """
SELECT * FROM (
  SELECT event_year, event,
    CAST(row_number() OVER (PARTITION BY event_year, event ORDER BY race_finishing_position, driver_number) AS INTEGER)
      AS place,
    driver_number AS winner,
    lead(driver_number) OVER (PARTITION BY event_year, event ORDER BY race_finishing_position, driver_number) AS loser,
    qualifying_position - lead(qualifying_position)
      OVER (PARTITION BY event_year, event ORDER BY race_finishing_position, driver_number) AS qualifying_position
  FROM lab WHERE race_finishing_position IS NOT NULL)
WHERE loser IS NOT NULL"""))
def pair_expand(spark, folder):
    """Neighbours in the finishing order with the difference of their qualifying positions."""
    return m.neighbour_pairs(labelled(spark, folder), ["qualifying_position"])


@register(with_binding(LABELLED, """
SELECT event_year, event, count(*) AS drivers, TRUE AS ranks_are_one_to_n FROM known GROUP BY event_year, event"""))
def pairwise_rank(spark, folder):
    """Linear ranking over all candidate features, learned from neighbours in the finishing order of all seasons but one.

    Its ranks are fitted numbers; that they number the drivers of each event from one is what SQL can state.
    """
    rows = candidate_frame(spark, folder).where(F.col(e.LABEL).isNotNull() & F.col("qualifying_position").isNotNull())
    rows = stored(rows, "pairs")
    scored = m.pairwise_scores(rows.where(F.col("event_year") != HELD_OUT), rows, e.CANDIDATE_FEATURES)
    return _ranked(e.score_events(scored))


@register(with_binding(LABELLED, """
SELECT a.event_year, a.event, a.race_finishing_position, a.qualifying_position,
  round(sum(sign(b.race_finishing_position - a.race_finishing_position)
    / (1 + exp(sign(b.race_finishing_position - a.race_finishing_position) * (b.prediction - a.prediction)))), 6) AS gradient,
  round(sum(CASE WHEN a.race_finishing_position = b.race_finishing_position THEN 0
    ELSE 1 / ((1 + exp(b.prediction - a.prediction)) * (1 + exp(a.prediction - b.prediction))) END), 6) AS curvature
FROM (SELECT DISTINCT event_year, event, race_finishing_position, qualifying_position, prediction FROM known) a
JOIN known b ON b.event_year = a.event_year AND b.event = a.event
GROUP BY ALL"""))
def pairwise_gradients(spark, folder):
    """The pull of all others of an event on each finisher, scored by the qualifying position."""
    rows = known(spark, folder).select(*EVENT_KEYS, e.LABEL, "qualifying_position")
    found = ranking.pairwise_gradients(rows, score="qualifying_position")
    place = lambda c: F.col(c).cast("int").alias(c)
    return found.select(
        *EVENT_KEYS, place(e.LABEL), place("qualifying_position"),
        *[F.round(c, 6).alias(c) for c in ("gradient", "curvature")],
    )


LINE_FEATURES = ["quantity", "discount", "tax", "unit_price"]
BOOST_YEAR, BOOST_TREES, BOOST_STEP = 1997, 10, 0.5


def _order_lines(spark, folder):
    """Orders as events: their lines finish by how near their quantity is to 25. No weight of the quantity says that."""
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "orders"), F.expr("l_orderkey = o_orderkey"))
    place = F.row_number().over(Window.partitionBy("event").orderBy(F.abs(F.col("quantity") - 25), "driver_number"))
    return lines.select(
        F.year("o_orderdate").alias("event_year"), F.col("l_orderkey").alias("event"), F.col("l_linenumber").alias("driver_number"),
        F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    ).withColumn(e.LABEL, place)


@register(f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS event_year, l_orderkey AS event, count(*) AS drivers, TRUE AS ranks_are_one_to_n,
  TRUE AS beats_linear, TRUE AS mostly_right
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) = {BOOST_YEAR} GROUP BY ALL""")
def pairwise_boost(spark, folder):
    """Boosted pairwise ranking of the lines of all orders, judged by a season that it has not seen.

    There it puts most drivers on their places, and more of them than the linear ranker.
    """
    rows = stored(_order_lines(spark, folder), "lines")
    held_out = F.col("event_year") == BOOST_YEAR
    train, test = rows.where(~held_out), rows.where(held_out)
    model = ranking.boost(train, LINE_FEATURES, trees=BOOST_TREES, step=BOOST_STEP)
    boosted = stored(e.score_events(model.scored(test)), "boosted")
    linear = e.score_events(m.pairwise_scores(train, test, LINE_FEATURES))
    right = F.avg((F.col("predicted_rank") == F.col(e.LABEL)).cast("int"))
    share, other = (x.agg(right).first()[0] or 0.0 for x in (boosted, linear))
    return _ranked(boosted).withColumns({"beats_linear": F.lit(share > other), "mostly_right": F.lit(share > 0.5)})


@register(f"""
SELECT {BOOST_YEAR} AS event_year, count(*) AS rows, TRUE AS trees_beat_mean, TRUE AS sampled_columns_beat_mean
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) = {BOOST_YEAR}""")
def held_out_regression(spark, folder):
    """Two kinds of boosted trees for the place itself, judged by a season that they have not seen.

    One kind is MLlib's, the other takes a sample of the columns for each tree. Both are nearer than that season's mean.
    """
    rows = stored(_order_lines(spark, folder), "lines")
    train, test = rows.where(F.col("event_year") != BOOST_YEAR), rows.where(F.col("event_year") == BOOST_YEAR)
    values = m.feature_medians(train, LINE_FEATURES)
    bins = m.binned(train, LINE_FEATURES, values)
    trees = _beats_mean(m.fit_predict(train, test, LINE_FEATURES, BOOST_TREES, values, bins))
    model = ranking.boost(train, LINE_FEATURES, ranking.squared_gradients, trees=BOOST_TREES, step=BOOST_STEP, values=values, bins=bins)
    sampled = _beats_mean(model.scored(test, "prediction"))
    facts = {"trees_beat_mean": trees, "sampled_columns_beat_mean": sampled}
    counted = test.agg(F.lit(BOOST_YEAR).alias("event_year"), F.count(F.lit(1)).alias("rows"))
    return counted.withColumns({name: F.lit(found.first()[0]) for name, found in facts.items()})


@register(with_binding(LABELLED, """
SELECT '20260228T033812Z' AS run_id, 'grid_only' AS model_config, round(avg(precision_at_3), 9) AS precision_at_3,
  round(avg(recall_at_3), 9) AS recall_at_3, round(avg(spearman), 9) AS spearman, count(*) AS folds,
  CAST(sum(rows) AS BIGINT) AS train_rows, min(event_year) AS first_season, max(event_year) AS last_season,
  max_by(rows, event_year) AS rows_of_last_fold
FROM pr JOIN sp USING (event_year)"""))
def run_metadata(spark, folder):
    """Metadata of a run written as JSON and read back with its schema."""
    rows = known(spark, folder)
    facts = {
        "run_id": "20260228T033812Z", "run_type": "baseline", "model_config": "grid_only",
        "trained_at_utc": "2026-02-28T03:38:12Z",
    }
    path = scratch_folder(spark, "metadata")
    lake.write_json(reports.run_metadata(e.fold_metrics(rows), rows, **facts), path)
    run = lake.read_json_lenient(spark, path, RUN_METADATA_SCHEMA)
    return run.select(
        "run_id", "model_config", *[F.round(f"metrics.{c}", 9).alias(c) for c in ("precision_at_3", "recall_at_3", "spearman")],
        F.size("fold_metrics").cast("bigint").alias("folds"), "train_rows",
        F.get("season_range", F.lit(0)).alias("first_season"), F.get("season_range", F.lit(1)).alias("last_season"),
        F.element_at("fold_metrics", -1)["rows"].alias("rows_of_last_fold"),
    )


@register(with_binding("", """
SELECT event_year || '0301T000000Z' AS run_id, event_year || '-03-01' AS trained_at_utc, 'baseline' AS run_type,
  '' AS model_config, '' AS feature_set_name, '' AS dataset_ref,
  CAST(count(*) FILTER (WHERE finishing_position <= 3) AS DOUBLE) / count(*) AS precision_at_3,
  CAST(NULL AS DOUBLE) AS recall_at_3, CAST(NULL AS DOUBLE) AS spearman, count(*) AS train_rows,
  event_year AS first_season, event_year AS last_season,
  CASE WHEN event_year % 2 = 0 THEN '' ELSE ('abcdef' || event_year || 'ffff')[1:8] END AS git_commit
FROM b_results WHERE session = 'R' GROUP BY event_year"""))
def run_summary(spark, folder):
    """Metadata files of all runs; next to them lie some that were cut off while they were written."""
    runs = calendar.model_runs(spark, folder)
    year = F.col("event_year").cast("string")
    document = F.to_json(
        F.struct(
            "run_id", F.concat(year, F.lit("-03-01")).alias("trained_at_utc"), F.lit("baseline").alias("run_type"),
            F.struct((F.col("podiums") / F.col("train_rows")).alias("precision_at_3")).alias("metrics"), "train_rows",
            F.array("event_year", "event_year").alias("season_range"),
            F.when(F.col("event_year") % 2 != 0, F.concat(F.lit("abcdef"), year, F.lit("ffff"))).alias("git_commit"),
        )
    )
    path = scratch_folder(spark, "run_files")
    lines = F.explode(F.array(document, F.substring(document, 1, 40)))
    runs.select(lines.alias("value")).write.text(path)
    return reports.run_summary(lake.read_json_lenient(spark, path, RUN_METADATA_SCHEMA))


def _land(spark, folder, path, part):
    rows = table(spark, folder, "events").where((F.col("event_type") == "purchase") == F.lit(part))
    rows.write.mode("append").parquet(path)


def _clean_events(df):
    return df.select(
        "event_id", F.to_date("ts").alias("event_date"), "user_id", F.upper("event_type").alias("event_type"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"), "value",
    )


def _ingest_twice(spark, folder, transform, parts):
    """Two deliveries to the landing folder with a call after each, and a third call with nothing new."""
    landing, target, state = (scratch_folder(spark, name) for name in ("landing", "target", "state"))
    for delivery in (False, True):
        _land(spark, folder, landing, delivery)
        ingest.ingest_new_files(spark, landing, EVENT_SCHEMA, transform, target, state, parts)
    ingest.ingest_new_files(spark, landing, EVENT_SCHEMA, transform, target, state, parts)
    return target


@register("""
SELECT event_id, CAST(ts AS DATE) AS event_date, user_id, upper(event_type) AS event_type,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value
FROM events""")
def stream_silver(spark, folder):
    target = _ingest_twice(spark, folder, _clean_events, ["event_date"])
    return spark.read.parquet(target).drop("batch").withColumn("event_date", F.col("event_date").cast("date"))


@register("""
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def stream_dedupe(spark, folder):
    """Two deliveries merged into one target by key, and a third call with nothing new."""
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    landing, target, state = (scratch_folder(spark, name) for name in ("landing", "target", "state"))
    for delivery in (False, True):
        _land(spark, folder, landing, delivery)
        ingest.merge_new_files(spark, landing, EVENT_SCHEMA, target, state, keys, order)
    ingest.merge_new_files(spark, landing, EVENT_SCHEMA, target, state, keys, order)
    return snapshots.read_merged(spark, target, EVENT_SCHEMA, keys, order)


@register("""
WITH mark AS (SELECT max(ts) - INTERVAL 10 DAY AS mark FROM events WHERE event_type <> 'purchase'),
judged AS (SELECT events.*, event_type = 'purchase' AND ts < mark AS late FROM events, mark)
SELECT event_id, user_id, event_type, late FROM judged WHERE late
UNION ALL
SELECT event_id, user_id, event_type, late FROM (
  SELECT * FROM judged WHERE NOT late
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)""")
def stream_late(spark, folder):
    """The last event of each user from two deliveries; rows of the second that are ten days behind are kept apart."""
    landing, target, late, state = (scratch_folder(spark, name) for name in ("landing", "target", "late", "state"))
    keys, order = ["user_id"], ["ts", "event_id"]
    for delivery in (False, True):
        _land(spark, folder, landing, delivery)
        ingest.merge_on_time(spark, landing, EVENT_SCHEMA, target, late, state, keys, order, "ts", "10 DAYS")
    rows = snapshots.read_merged(spark, target, EVENT_SCHEMA, keys, order).withColumn("late", F.lit(False))
    rows = rows.unionByName(ingest.read_late(spark, late, EVENT_SCHEMA).withColumn("late", F.lit(True)))
    return rows.select("event_id", "user_id", "event_type", "late")
