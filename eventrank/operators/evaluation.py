"""Scores, ranks and how well they match the outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventrank.functions.values import percentage
from eventrank.operators.order_stats import rank_within, with_average_rank
from eventrank.schemas import EVENT_KEYS

PODIUM = 3
TOP = 10
LABEL = "race_finishing_position"
BASELINE_FEATURES = ["qualifying_position", "grid_starting_position"]

# The features of the candidate model.
CANDIDATE_FEATURES = [
    "qualifying_position", "q1_seconds", "q2_seconds", "q3_seconds", "gap_to_pole", "top10_gap_spread",
    "practice_best_lap_time_seconds", "practice_median_lap_time_seconds",
    "hist_avg_race_lap_time", "hist_race_lap_time_std", "hist_race_laps_count",
]


def share(part: Column, whole: Column) -> Column:
    """Part of the whole, 0 when the whole is empty."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def gap_to_pole(df: DataFrame, time: str = "q3_seconds") -> DataFrame:
    """Distance to the best time of the event, which is aggregated before it is joined back."""
    pole = df.groupBy(*EVENT_KEYS).agg(F.min(time).alias("pole_seconds"))
    return df.join(pole, EVENT_KEYS, "left").withColumn("gap_to_pole", F.col(time) - F.col("pole_seconds")).drop(
        "pole_seconds"
    )


def top_spread(df: DataFrame, time: str = "q3_seconds", depth: int = TOP) -> DataFrame:
    """Per event, distance between the best and the ``depth``-th time; NULL with fewer than two times."""
    place = F.row_number().over(Window.partitionBy(*EVENT_KEYS).orderBy(time))
    best = df.where(F.col(time).isNotNull()).select(*EVENT_KEYS, time).withColumn("place", place)
    spread = F.when(F.count(F.lit(1)) >= 2, F.max(time) - F.min(time))
    return best.where(F.col("place") <= depth).groupBy(*EVENT_KEYS).agg(spread.alias("top10_gap_spread"))


def with_gap_features(df: DataFrame) -> DataFrame:
    return gap_to_pole(df).join(top_spread(df), EVENT_KEYS, "left")


def overtake_difficulty(df: DataFrame) -> DataFrame:
    """Mean places won per event. It uses the outcome of the same race: for analysis only, never a feature."""
    gain = F.col("qualifying_position") - F.col(LABEL)
    return df.groupBy(*EVENT_KEYS).agg(F.avg(gain).alias("track_overtake_difficulty"))


def group_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy(*EVENT_KEYS).agg(F.count(F.lit(1)).alias("drivers"))


def baseline_feature(df: DataFrame) -> str:
    for name in BASELINE_FEATURES:
        if name in df.columns:
            return name
    raise ValueError(f"none of {BASELINE_FEATURES} is a column")


def training_clean(df: DataFrame, features: Sequence[str], drop_missing: bool = False) -> DataFrame:
    """Label and features as numbers, rows without label left out; features that do not exist are skipped."""
    available = [c for c in features if c in df.columns]
    numbers = {c: F.col(c).try_cast("double") for c in [*available, LABEL]}
    cleaned = df.withColumns(numbers).dropna(subset=[LABEL])
    return cleaned.dropna(subset=available) if drop_missing else cleaned


def flag_scores(df: DataFrame, score: str = "predicted_score") -> DataFrame:
    """Rows with a score (NaN is none), their rounded position (half to even) and the podium flag."""
    known = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    position = F.rint(known).try_cast("int")
    return df.where(known.isNotNull()).withColumns(
        {"predicted_position": position, "is_podium_prediction": position <= PODIUM}
    )


def score_events(df: DataFrame, score: str = "predicted_score") -> DataFrame:
    """Flagged scores with the rank within the event; equal scores stand in the order of the driver numbers."""
    return rank_within(flag_scores(df, score), EVENT_KEYS, score, "driver_number", "predicted_rank")


def with_error(scored: DataFrame) -> DataFrame:
    return scored.withColumn("abs_error", F.abs(F.col("predicted_rank") - F.col(LABEL)).cast("int"))


def podium(df: DataFrame, score: str = "predicted_score", depth: int = PODIUM) -> DataFrame:
    """The first ``depth`` drivers of each event; each task passes on no more than that per event."""
    place = F.row_number().over(Window.partitionBy(*EVENT_KEYS).orderBy(score, "driver_number"))
    first = df.where(F.col(score).isNotNull()).withColumn("place", place).where(F.col("place") <= depth)
    rows = F.sort_array(F.collect_list(F.struct("place", "abbreviation")))
    return first.groupBy(*EVENT_KEYS).agg(F.array_join(rows["abbreviation"], ",").alias("predicted_podium"))


def score_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy(*EVENT_KEYS).agg(
        F.count(F.lit(1)).alias("total_drivers"), F.count_if("is_podium_prediction").alias("podium_predictions")
    )


def _hits(prediction: Column, k: int) -> tuple[Column, Column, Column]:
    """Rows at most ``k`` in both, in the prediction, in the outcome."""
    said, real = prediction <= k, F.col(LABEL) <= k
    return F.count_if(said & real), F.count_if(said), F.count_if(real)


def precision_recall(df: DataFrame, fold: str = "event_year", prediction: str = "prediction", ks=(PODIUM, TOP)) -> DataFrame:
    columns = [F.count(F.lit(1)).alias("rows")]
    for k in ks:
        both, said, real = _hits(F.col(prediction), k)
        columns += [share(both, said).alias(f"precision_at_{k}"), share(both, real).alias(f"recall_at_{k}")]
    return df.groupBy(fold).agg(*columns)


def spearman(df: DataFrame, fold: str = "event_year", prediction: str = "prediction") -> DataFrame:
    """Rank correlation of prediction and outcome per fold; 0 if one of them is constant.

    Works on counted value pairs and whole-number ranks, so the sums are exact and no fold is ordered as a whole. Rows that
    lack one of both are left out.
    """
    pairs = df.where(F.col(LABEL).isNotNull()).groupBy(fold, prediction, LABEL).agg(F.count(F.lit(1)).alias("pairs"))
    for column, name in ((prediction, "a"), (LABEL, "b")):
        ranked = with_average_rank(pairs, [fold], column, "pairs", name)
        pairs = ranked.withColumn(name, F.col(name).cast("decimal(19,0)"))
    n, a, b = F.col("pairs").cast("decimal(19,0)"), F.col("a"), F.col("b")

    def total(term: Column) -> Column:
        return F.sum(term.cast("decimal(28,0)"))

    sums = pairs.groupBy(fold).agg(
        F.sum(n).alias("n"), total(n * a).alias("sa"), total(n * b).alias("sb"),
        total(n * a * b).alias("sab"), total(n * a * a).alias("saa"), total(n * b * b).alias("sbb"),
    )

    def scatter(xy: str, x: str, y: str) -> Column:
        return (F.col("n") * F.col(xy) - F.col(x) * F.col(y)).cast("double")

    spread = F.sqrt(scatter("saa", "sa", "sa")) * F.sqrt(scatter("sbb", "sb", "sb"))
    return sums.select(fold, F.coalesce(F.try_divide(scatter("sab", "sa", "sb"), spread), F.lit(0.0)).alias("spearman"))


def fold_metrics(df: DataFrame, fold: str = "event_year", prediction: str = "prediction") -> DataFrame:
    return precision_recall(df, fold, prediction).join(spearman(df, fold, prediction), fold)


def metric_means(folds: DataFrame) -> DataFrame:
    names = [c for c in folds.columns if c.startswith(("precision", "recall", "spearman"))]
    return folds.agg(F.count(F.lit(1)).alias("folds"), *[F.avg(c).alias(c) for c in names])


def quality_gate(means: DataFrame, minimum: float = 0.0) -> DataFrame:
    passed = F.col("precision_at_3") >= F.lit(minimum)
    return means.select("precision_at_3", F.lit(minimum).alias("minimum"), passed.alias("passed"))


def require_quality(means: DataFrame, minimum: float = 0.0) -> None:
    row = quality_gate(means, minimum).first()
    if not row["passed"]:
        raise ValueError(f"precision_at_3={row['precision_at_3']:.4f} is below the minimum {minimum:.4f}")


def accuracy_by_race(scored: DataFrame) -> DataFrame:
    """Hits of the predicted rank per race with a known outcome."""
    known = with_error(scored).where(F.col(LABEL).isNotNull())
    rank, real, error = F.col("predicted_rank"), F.col(LABEL), F.col("abs_error")

    def hit_rate(k: int) -> Column:
        return percentage(F.count_if((rank <= k) & (real <= k)), F.count_if(real <= k))

    return known.groupBy(*EVENT_KEYS).agg(
        F.count(F.lit(1)).alias("drivers"),
        F.count_if(error == 0).alias("exact"),
        F.count_if(error <= PODIUM).alias("within_3"),
        F.count_if(error <= TOP).alias("within_10"),
        F.sum("abs_error").alias("error_sum"),
        hit_rate(PODIUM).alias("podium_accuracy_percent"),
        hit_rate(TOP).alias("points_accuracy_percent"),
        F.avg("abs_error").alias("average_position_error"),
    )


def accuracy_summary(by_race: DataFrame) -> DataFrame:
    """All races of a season in one row."""
    return by_race.groupBy("event_year").agg(
        F.count(F.lit(1)).alias("total_races"),
        *[F.sum(c).alias(c) for c in ("exact", "within_3", "within_10")],
        F.avg("podium_accuracy_percent").alias("podium_accuracy_percent"),
        F.avg("points_accuracy_percent").alias("points_accuracy_percent"),
        share(F.sum("error_sum"), F.sum("drivers")).alias("average_position_error"),
    )
