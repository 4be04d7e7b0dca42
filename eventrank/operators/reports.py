"""Run metadata and the reports made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HASH_LENGTH = 8


def run_metadata(folds: DataFrame, training: DataFrame, **facts: str) -> DataFrame:
    """One row for a training run: facts, mean metrics, metrics of each fold, size and seasons of the training set."""
    metrics = ["precision_at_3", "recall_at_3", "spearman"]
    fold = F.struct(F.col("event_year").alias("held_out_season"), "rows", *metrics)
    measured = folds.agg(
        F.struct(*[F.avg(m).alias(m) for m in metrics]).alias("metrics"),
        # One entry per season.
        F.sort_array(F.collect_list(fold)).alias("fold_metrics"),
    )
    size = training.agg(
        F.count(F.lit(1)).alias("train_rows"),
        F.array(F.min("event_year"), F.max("event_year")).alias("season_range"),
    )
    both = measured.unionByName(size, allowMissingColumns=True)
    names = ["metrics", "fold_metrics", "train_rows", "season_range"]
    merged = both.agg(*[F.max(c).alias(c) for c in names])
    return merged.select(*[F.lit(v).alias(k) for k, v in facts.items()], *names)


def run_summary(runs: DataFrame) -> DataFrame:
    """Flat rows of run metadata, newest first."""
    text = ["trained_at_utc", "run_type", "model_config", "feature_set_name", "dataset_ref"]
    return runs.select(
        "run_id",
        *[F.coalesce(c, F.lit("")).alias(c) for c in text],
        "metrics.precision_at_3", "metrics.recall_at_3", "metrics.spearman",
        "train_rows",
        F.get("season_range", F.lit(0)).alias("first_season"),
        F.get("season_range", F.lit(1)).alias("last_season"),
        F.coalesce(F.substring("git_commit", 1, HASH_LENGTH), F.lit("")).alias("git_commit"),
    ).orderBy(F.desc("run_id"))
