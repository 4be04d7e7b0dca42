"""Evaluation, score, report and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventrank.catalog.binding_sql import with_binding
from eventrank.catalog.features import ENTRIES, FORM, TRAINING_STEPS, bound_form, bound_targets, bound_training
from eventrank.catalog.registry import register
from eventrank.operators import evaluation as e
from eventrank.operators import quality
from eventrank.operators.history import season_form
from eventrank.plans.gold import training_dataset
from eventrank.schemas import DRIVER_EVENT_KEYS
from eventrank.sources import binding, lake
from eventrank.sources.session import scratch_folder

YEAR, EARLY, LATE = 1998, "bahrain", "british"
MODEL_RUN = "20260228T033812Z"

# Label rows: targets with the outcome of the race, and the qualifying position as the baseline's prediction.
LABELLED = ENTRIES + """
lab AS (
  SELECT d.*, r.finishing_position AS race_finishing_position, CAST(d.qualifying_position AS DOUBLE) AS prediction
  FROM entry d LEFT JOIN b_results r ON r.session = 'R' AND r.event_year = d.event_year AND r.event = d.event
    AND r.driver_number = d.driver_number),
known AS (SELECT * FROM lab WHERE race_finishing_position IS NOT NULL AND qualifying_position IS NOT NULL),
scored AS (
  SELECT *, prediction AS predicted_score, CAST(round_even(prediction, 0) AS INTEGER) AS predicted_position,
    round_even(prediction, 0) <= 3 AS is_podium_prediction,
    CAST(row_number() OVER (PARTITION BY event_year, event ORDER BY prediction, driver_number) AS INTEGER)
      AS predicted_rank
  FROM lab WHERE qualifying_position IS NOT NULL),
hits AS (
  SELECT event_year, count(*) AS rows,
    count(*) FILTER (WHERE prediction <= 3 AND race_finishing_position <= 3) AS t3,
    count(*) FILTER (WHERE prediction <= 3) AS p3, count(*) FILTER (WHERE race_finishing_position <= 3) AS r3,
    count(*) FILTER (WHERE prediction <= 10 AND race_finishing_position <= 10) AS t10,
    count(*) FILTER (WHERE prediction <= 10) AS p10, count(*) FILTER (WHERE race_finishing_position <= 10) AS r10
  FROM known GROUP BY 1),
pr AS (
  SELECT event_year, rows, CASE WHEN p3 = 0 THEN 0 ELSE CAST(t3 AS DOUBLE) / p3 END AS precision_at_3,
    CASE WHEN r3 = 0 THEN 0 ELSE CAST(t3 AS DOUBLE) / r3 END AS recall_at_3,
    CASE WHEN p10 = 0 THEN 0 ELSE CAST(t10 AS DOUBLE) / p10 END AS precision_at_10,
    CASE WHEN r10 = 0 THEN 0 ELSE CAST(t10 AS DOUBLE) / r10 END AS recall_at_10
  FROM hits),
ranked AS (
  SELECT event_year,
    rank() OVER (PARTITION BY event_year ORDER BY prediction)
      + (count(*) OVER (PARTITION BY event_year, prediction) - 1) / 2.0 AS a,
    rank() OVER (PARTITION BY event_year ORDER BY race_finishing_position)
      + (count(*) OVER (PARTITION BY event_year, race_finishing_position) - 1) / 2.0 AS b
  FROM known),
sp AS (SELECT event_year, round(corr(CAST(a AS DOUBLE), CAST(b AS DOUBLE)), 9) AS spearman FROM ranked GROUP BY 1),
"""

_METRICS = ["precision_at_3", "recall_at_3", "precision_at_10", "recall_at_10"]
_KEYS = ", ".join(DRIVER_EVENT_KEYS)
_ROLLING = LABELLED + FORM + f"""
roll AS (
  SELECT entry.*, season_points_to_date, last3_race_count
  FROM entry JOIN form USING (event_year, event, driver_number)
  WHERE event_year = {YEAR} AND event IN ('{EARLY}', '{LATE}')),
"""


def labelled(spark, folder):
    """Targets with the outcome, without the other features."""
    return training_dataset(bound_targets(spark, folder), binding.results(spark, folder)).withColumn(
        "prediction", F.col("qualifying_position").cast("double")
    )


def known(spark, folder):
    return labelled(spark, folder).dropna(subset=["qualifying_position", e.LABEL])


def predictions(spark, folder):
    return labelled(spark, folder).withColumn("predicted_score", F.col("prediction"))


def scored(spark, folder):
    return e.score_events(predictions(spark, folder))


def _rounded(df, *names, digits=9):
    return df.withColumns({c: F.round(c, digits) for c in names})


@register(with_binding(LABELLED, f"""
SELECT {_KEYS}, qualifying_position AS baseline FROM lab"""))
def grid_baseline(spark, folder):
    df = labelled(spark, folder)
    return df.select(*DRIVER_EVENT_KEYS, F.col(e.baseline_feature(df)).alias("baseline"))


@register(with_binding(LABELLED, f"""
SELECT {_KEYS}, prediction AS qualifying_position, q3_seconds,
  CAST(race_finishing_position AS DOUBLE) AS race_finishing_position
FROM known WHERE q3_seconds IS NOT NULL"""))
def training_clean(spark, folder):
    """Text features are read as numbers; a feature that does not exist is skipped."""
    raw = labelled(spark, folder).withColumn("q3_seconds", F.col("q3_seconds").cast("string"))
    features = ["qualifying_position", "q3_seconds", "no_such_feature"]
    cleaned = e.training_clean(raw, features, drop_missing=True)
    return cleaned.select(*DRIVER_EVENT_KEYS, "qualifying_position", "q3_seconds", e.LABEL)


@register(with_binding(LABELLED, f"""
SELECT {_KEYS}, q3_seconds, q3_seconds - min(q3_seconds) OVER (PARTITION BY event_year, event) AS gap_to_pole FROM lab"""))
def gap_to_pole(spark, folder):
    return e.gap_to_pole(labelled(spark, folder)).select(*DRIVER_EVENT_KEYS, "q3_seconds", "gap_to_pole")


_SPREAD = """
SELECT event_year, event, CASE WHEN count(*) >= 2 THEN max(q3_seconds) - min(q3_seconds) END AS top10_gap_spread
FROM (SELECT *, row_number() OVER (PARTITION BY event_year, event ORDER BY q3_seconds) AS rn FROM lab
      WHERE q3_seconds IS NOT NULL)
WHERE rn <= 10 GROUP BY 1, 2
"""


@register(with_binding(LABELLED, _SPREAD))
def top10_spread(spark, folder):
    return e.top_spread(labelled(spark, folder))


@register(with_binding(LABELLED, """
SELECT event_year, event, avg(qualifying_position - race_finishing_position) AS track_overtake_difficulty
FROM lab GROUP BY 1, 2"""))
def overtake_difficulty(spark, folder):
    return e.overtake_difficulty(labelled(spark, folder))


@register(with_binding(LABELLED, "SELECT event_year, event, count(*) AS drivers FROM known GROUP BY 1, 2"))
def group_sizes(spark, folder):
    return e.group_sizes(known(spark, folder))


@register(with_binding(TRAINING_STEPS + f"""
lab AS (SELECT * FROM training), spread AS ({_SPREAD}),""", f"""
SELECT {_KEYS}, CAST(race_finishing_position AS DOUBLE) AS race_finishing_position,
  CAST(qualifying_position AS DOUBLE) AS qualifying_position, q1_seconds, q2_seconds, q3_seconds,
  q3_seconds - min(q3_seconds) OVER (PARTITION BY event_year, event) AS gap_to_pole, top10_gap_spread,
  practice_best_lap_time_seconds, practice_median_lap_time_seconds, hist_avg_race_lap_time, hist_race_lap_time_std,
  CAST(hist_race_laps_count AS DOUBLE) AS hist_race_laps_count
FROM lab LEFT JOIN spread USING (event_year, event)
QUALIFY race_finishing_position IS NOT NULL"""))
def candidate_features(spark, folder):
    return candidate_frame(spark, folder)


def candidate_frame(spark, folder):
    rows = e.with_gap_features(bound_training(spark, folder))
    cleaned = e.training_clean(rows, e.CANDIDATE_FEATURES)
    return cleaned.select(*DRIVER_EVENT_KEYS, e.LABEL, *e.CANDIDATE_FEATURES)


@register(with_binding(LABELLED, f"""
SELECT {_KEYS}, predicted_score, predicted_position, is_podium_prediction, predicted_rank FROM scored"""))
def predicted_rank(spark, folder):
    return scored(spark, folder).select(
        *DRIVER_EVENT_KEYS, "predicted_score", "predicted_position", "is_podium_prediction", "predicted_rank"
    )


_ERRORS = """
SELECT event_year, event, driver_number, full_name, qualifying_position, predicted_score, predicted_rank,
  race_finishing_position, abs(predicted_rank - race_finishing_position) AS abs_error
FROM scored WHERE race_finishing_position IS NOT NULL
"""


@register(with_binding(LABELLED, _ERRORS))
def score_vs_actual(spark, folder):
    rows = e.with_error(scored(spark, folder)).where(F.col(e.LABEL).isNotNull())
    return rows.select(
        *DRIVER_EVENT_KEYS, "full_name", "qualifying_position", "predicted_score", "predicted_rank", e.LABEL, "abs_error"
    )


@register(with_binding(LABELLED, f"""
SELECT {_KEYS}, CASE WHEN event_year < 2000 THEN 'qualifying' ELSE 'sprint_qualifying' END AS session_type,
  predicted_rank, predicted_score, '{MODEL_RUN}' AS run_id
FROM scored"""))
def score_export(spark, folder):
    """Predictions written by event and session type in the order of their rank, and read back."""
    path = scratch_folder(spark, "predictions")
    kind = F.when(F.col("event_year") < 2000, "qualifying").otherwise("sprint_qualifying")
    rows = scored(spark, folder).select(
        *DRIVER_EVENT_KEYS, kind.alias("session_type"), "predicted_rank", "predicted_score", F.lit(MODEL_RUN).alias("run_id")
    )
    lake.write_ranked(rows, path, ["event_year", "event", "session_type"], "predicted_rank")
    return spark.read.parquet(path)


@register(with_binding(LABELLED, """
SELECT event_year, event, string_agg(abbreviation, ',' ORDER BY predicted_rank) AS predicted_podium
FROM scored WHERE predicted_rank <= 3 GROUP BY 1, 2"""))
def podium_topk(spark, folder):
    return e.podium(predictions(spark, folder))


@register(with_binding(LABELLED, """
SELECT event_year, event, count(*) AS total_drivers, count(*) FILTER (WHERE is_podium_prediction) AS podium_predictions
FROM scored GROUP BY 1, 2"""))
def score_summary(spark, folder):
    return e.score_summary(e.flag_scores(predictions(spark, folder)))


@register(with_binding(LABELLED, "SELECT * FROM pr"))
def precision_recall_at_k(spark, folder):
    return e.precision_recall(known(spark, folder))


@register(with_binding(LABELLED, "SELECT * FROM sp"))
def spearman_by_season(spark, folder):
    return _rounded(e.spearman(known(spark, folder)), "spearman")


@register(with_binding(LABELLED, f"""
SELECT count(*) AS folds, {', '.join(f'round(avg({m}), 9) AS {m}' for m in [*_METRICS, 'spearman'])}
FROM pr JOIN sp USING (event_year)"""))
def loso_summary(spark, folder):
    return _rounded(e.metric_means(e.fold_metrics(known(spark, folder))), *_METRICS, "spearman")


@register(with_binding(LABELLED, """
SELECT round(avg(precision_at_3), 9) AS precision_at_3, CAST(0.25 AS DOUBLE) AS minimum,
  avg(precision_at_3) >= 0.25 AS passed
FROM pr"""))
def quality_gate(spark, folder):
    means = e.metric_means(e.precision_recall(known(spark, folder)))
    return _rounded(e.quality_gate(means, 0.25), "precision_at_3")


_BY_RACE = f"""
SELECT event_year, event, count(*) AS drivers, count(*) FILTER (WHERE abs_error = 0) AS exact,
  count(*) FILTER (WHERE abs_error <= 3) AS within_3, count(*) FILTER (WHERE abs_error <= 10) AS within_10,
  CAST(sum(abs_error) AS BIGINT) AS error_sum,
  CAST(count(*) FILTER (WHERE predicted_rank <= 3 AND race_finishing_position <= 3) AS DOUBLE) * 100
    / NULLIF(count(*) FILTER (WHERE race_finishing_position <= 3), 0) AS podium_accuracy_percent,
  CAST(count(*) FILTER (WHERE predicted_rank <= 10 AND race_finishing_position <= 10) AS DOUBLE) * 100
    / NULLIF(count(*) FILTER (WHERE race_finishing_position <= 10), 0) AS points_accuracy_percent,
  avg(abs_error) AS average_position_error
FROM ({_ERRORS}) GROUP BY 1, 2
"""
_NO_HITS = "* REPLACE (COALESCE(podium_accuracy_percent, 0) AS podium_accuracy_percent, COALESCE(points_accuracy_percent, 0) AS points_accuracy_percent)"


@register(with_binding(LABELLED, f"SELECT {_NO_HITS} FROM ({_BY_RACE})"))
def accuracy_by_race(spark, folder):
    return e.accuracy_by_race(scored(spark, folder))


@register(with_binding(LABELLED, f"""
SELECT event_year, count(*) AS total_races, CAST(sum(exact) AS BIGINT) AS exact, CAST(sum(within_3) AS BIGINT) AS within_3,
  CAST(sum(within_10) AS BIGINT) AS within_10, round(avg(podium_accuracy_percent), 9) AS podium_accuracy_percent,
  round(avg(points_accuracy_percent), 9) AS points_accuracy_percent,
  CAST(sum(error_sum) AS DOUBLE) / CAST(sum(drivers) AS DOUBLE) AS average_position_error
FROM (SELECT {_NO_HITS} FROM ({_BY_RACE})) GROUP BY 1"""))
def accuracy_summary(spark, folder):
    summary = e.accuracy_summary(e.accuracy_by_race(scored(spark, folder)))
    return _rounded(summary, "podium_accuracy_percent", "points_accuracy_percent")


@register(with_binding(ENTRIES, """
SELECT DISTINCT event_year, event FROM entry ANTI JOIN b_weather USING (event_year, event)"""))
def missing_weather(spark, folder):
    return quality.missing_weather(bound_targets(spark, folder), binding.weather(spark, folder))


@register(with_binding(ENTRIES, """
SELECT event_year, count(*) AS targets, count(points_before) AS with_history,
  CAST(COALESCE(sum(points_before), 0) AS DOUBLE) AS points_before,
  CAST(COALESCE(sum(points_after), 0) AS DOUBLE) AS points_after, CAST(0 AS BIGINT) AS violations
FROM (
  SELECT d.event_year, d.event, d.driver_number,
    sum(CASE WHEN s.session_date_utc < d.qualifying_session_date_utc THEN CAST(r.points AS DECIMAL(18,4)) END)
      AS points_before,
    sum(CASE WHEN s.session_date_utc >= d.qualifying_session_date_utc THEN CAST(r.points AS DECIMAL(18,4)) END)
      AS points_after
  FROM entry d
  LEFT JOIN b_results r ON r.event_year = d.event_year AND r.driver_number = d.driver_number AND r.session IN ('R', 'S')
  LEFT JOIN b_dim s ON s.event_year = r.event_year AND s.event = r.event AND s.session = r.session
  GROUP BY 1, 2, 3)
GROUP BY 1"""))
def leakage_audit(spark, folder):
    targets = bound_targets(spark, folder)
    results, sessions = binding.results(spark, folder), binding.sessions(spark, folder)
    return quality.leakage_audit(season_form(targets, results, sessions), results, sessions)


def _range(label: str, event: str) -> str:
    of = f"FILTER (WHERE event = '{event}')"
    return (
        f"min(value) {of} AS {label}_min, max(value) {of} AS {label}_max,"
        f" round(avg(value) {of}, 4) AS {label}_mean"
    )


@register(with_binding(_ROLLING, f"""
SELECT *, CASE WHEN CASE name WHEN 'season_points_to_date' THEN late_max >= early_max
    WHEN 'last3_race_count' THEN early_mean BETWEEN 0 AND 3 AND late_mean BETWEEN 0 AND 3
    ELSE late_min >= early_max END THEN 'OK' ELSE 'CHECK' END AS verdict
FROM (
  SELECT name, {_range('early', EARLY)}, {_range('late', LATE)}
  FROM (SELECT event, 'target_event_number' AS name, CAST(target_event_number AS DOUBLE) AS value FROM roll
        UNION ALL SELECT event, 'season_points_to_date', season_points_to_date FROM roll
        UNION ALL SELECT event, 'last3_race_count', CAST(last3_race_count AS DOUBLE) FROM roll)
  GROUP BY 1)"""))
def rolling_plausibility(spark, folder):
    ranges = quality.rolling_plausibility(bound_form(spark, folder), YEAR, EARLY, LATE)
    return _rounded(ranges, "early_mean", "late_mean", digits=4)


@register(with_binding(_ROLLING, f"""
SELECT a.abbreviation, a.season_points_to_date AS early_season_points_to_date,
  a.last3_race_count AS early_last3_race_count, b.season_points_to_date AS late_season_points_to_date,
  b.last3_race_count AS late_last3_race_count,
  CASE WHEN b.season_points_to_date >= a.season_points_to_date THEN 'OK'
       WHEN b.season_points_to_date < a.season_points_to_date THEN 'CHECK' END AS verdict
FROM roll a JOIN roll b ON a.abbreviation = b.abbreviation AND a.event = '{EARLY}' AND b.event = '{LATE}'"""))
def rolling_compare(spark, folder):
    return quality.rolling_compare(bound_form(spark, folder), YEAR, EARLY, LATE)


@register(with_binding(ENTRIES, "SELECT count(*) AS targets, CAST(0 AS BIGINT) AS repeated_keys FROM entry"))
def target_key_check(spark, folder):
    return quality.target_key_check(bound_targets(spark, folder))
