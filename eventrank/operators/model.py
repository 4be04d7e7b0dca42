"""Models over the feature table: imputation, encoding, boosted trees, pairwise ranking, season-wise validation."""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import QuantileDiscretizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventrank.operators.evaluation import LABEL, score_events
from eventrank.operators.order_stats import medians, offsets, rank_within, sliced, value_counts
from eventrank.schemas import EVENT_KEYS
from eventrank.sources.session import stored

# Settings of the boosted trees.
TREES, DEPTH, STEP, SUBSAMPLE, SEED = 200, 3, 0.05, 0.9, 42
SIDE_BY_SIDE = 4
# Bins of a feature; no tree tells values of one bin apart.
BINS = 32
# Rows that boosted trees are fitted on one by one, and weighted rows of a task when there are more.
SHARES, TASK_SHARES = 1_000_000, 50_000
# Share of the rows by which a bound of the middle may be off; twice as far away it still holds the median.
NEAR = 0.005


def feature_medians(train: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact median of each feature, in two passes over the rows whatever the number of features.

    The first finds bounds that hold the middle of each feature; only values within them are counted one by one.
    """
    values = [f"value_{i}" for i in range(len(features))]
    numbers = train.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(v) for c, v in zip(features, values, strict=True)])
    bounds = dict(zip(values, numbers.approxQuantile(values, [0.5 - 2 * NEAR, 0.5 + 2 * NEAR], NEAR), strict=True))
    known = {v: c for v, c in zip(values, features, strict=True) if bounds[v]}
    if not known:
        return {}
    # A value outside counts as the bound on its side, which leaves the middle where it is.
    clamped = [F.when(F.col(v).isNotNull(), F.least(F.greatest(F.col(v), F.lit(bounds[v][0])), F.lit(bounds[v][1]))) for v in known]
    cells = F.explode(F.array(*[F.struct(F.lit(v).alias("feature"), c.alias("value")) for v, c in zip(known, clamped, strict=True)]))
    within = numbers.select(cells.alias("cell"))
    found = medians(value_counts(within.select("cell.*"), ["feature"], "value"), ["feature"], "value")
    # One number per feature comes back, as with any fitted model.
    return {known[row["feature"]]: row["median"] for row in found.collect()}


def fold_medians(df: DataFrame, features: Sequence[str], fold: str = "event_year") -> DataFrame:
    """``fold``, ``feature`` and ``median`` over the rows of all other folds, exact.

    One counted table serves all folds: how many rows of a feature lie below a value, less those of the fold itself. A
    feature that has no value outside a fold has no median there. ``df`` is read once, but for the names of the folds.
    """
    folds = sorted(r[fold] for r in df.select(fold).distinct().collect() if r[fold] is not None)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value")) for c in features]))
    long = df.select(fold, cells.alias("cell")).select(fold, "cell.*").where("value IS NOT NULL")
    own = {f"own{i}": F.count_if(F.col(fold) == season) for i, season in enumerate(folds)}
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), *[c.alias(name) for name, c in own.items()])
    rows = sliced(counts, ["feature", "value"])
    sums = ["n", *own]
    first = offsets(rows, ["feature"], {f"{c}_before": F.sum(c) for c in sums})
    inside = Window.partitionBy("feature", "slice").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    below = {f"{c}_below": F.col(f"{c}_before") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums}
    sizes = rows.groupBy("feature").agg(*[F.sum(c).alias(f"{c}_size") for c in sums])
    placed = rows.join(first, ["feature", "slice"]).withColumns(below).join(sizes, "feature")
    others = lambda name, i: (F.col(f"n{name}") - F.col(f"own{i}{name}"))
    left_out = F.explode(F.array(*[
        F.struct(F.lit(season).alias(fold), others("", i).alias("n"), others("_below", i).alias("below"), others("_size", i).alias("size"))
        for i, season in enumerate(folds)
    ]))
    each = placed.select("feature", "value", left_out.alias("fold")).select("feature", "value", "fold.*").where("n > 0")
    upto, size = F.col("below") + F.col("n"), F.col("size")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("below") < rank) & (upto >= rank), F.col("value")))

    middle = (at(F.floor((size + 1) / 2)) + at(F.floor(size / 2) + 1)) / 2
    return each.groupBy(fold, "feature").agg(middle.alias("median"))


def impute(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in values.items()})


def most_frequent(train: DataFrame, column: str) -> str | None:
    """The value that occurs most often, the smallest of them on a tie."""
    counts = value_counts(train, [], column)
    row = counts.orderBy(F.desc("n"), column).first()
    return None if row is None else row[column]


def numbered(values: DataFrame, column: str, code: str) -> DataFrame:
    """Distinct values with their number from 0 in ascending order; no task and not the driver sees all of them."""
    ranged = values.select(column).distinct().repartitionByRange(column).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "numbered")
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # The window sees one row per partition.
    first = sizes.select("part", (F.sum("n").over(Window.partitionBy().orderBy("part")) - F.col("n")).alias("first"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(column)) - 1
    return ranged.withColumn("place", place).join(first, "part").select(column, (F.col("first") + F.col("place")).cast("int").alias(code))


def ordinal_codes(train: DataFrame, df: DataFrame, column: str, code: str) -> DataFrame:
    """Missing values become the most frequent one, values get codes in text order, unknown ones -1."""
    usual = most_frequent(train, column)
    filled = df.withColumn(column, F.coalesce(F.col(column), F.lit(usual)))
    codes = numbered(train.where(F.col(column).isNotNull()), column, code)
    return filled.join(codes, column, "left").withColumn(code, F.coalesce(code, F.lit(-1))).select(*df.columns, code)


def known_features(features: Sequence[str], values: dict[str, float]) -> list[str]:
    """The features that have a median; it is an error if none has."""
    used = [c for c in features if c in values]
    if not used:
        raise ValueError("no feature has a value to learn from")
    return used


def binned(train: DataFrame, features: Sequence[str], values: dict[str, float]) -> Transformer:
    """Cuts the imputed features into as many quantiles as MLlib's trees tell apart, numbered in columns of their own."""
    used = known_features(features, values)
    return QuantileDiscretizer(inputCols=used, outputCols=[f"_bin_{c}" for c in used], numBuckets=BINS).fit(impute(train, values))


def dealt(rows: DataFrame, columns: Sequence[str], size: int) -> DataFrame:
    """Rows that are equal in ``columns``, dealt evenly to shares of at most ``size`` rows, with their number as ``weight``."""
    cells = stored(rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")), "cells")
    parts = F.ceil(F.col("n") / size).cast("int")
    tasks = 1 + (cells.agg(F.sum(parts)).first()[0] or 0) // TASK_SHARES
    shares = cells.select(*columns, (F.col("n") / parts).alias("weight"), F.explode(F.sequence(F.lit(1), parts)).alias("share"))
    # Stored, as fitting reads them more than once.
    return stored(shares.drop("share").repartition(tasks), "shares")


def boosted_trees(
    features: Sequence[str], trees: int = TREES, depth: int = DEPTH, seed: int = SEED, weight: str = ""
) -> Pipeline:
    vector = VectorAssembler(inputCols=list(features), outputCol="features")
    # Column sampling exists per node only; a single feature is always used.
    columns = "all" if len(features) == 1 else "0.9"
    model = GBTRegressor(
        featuresCol="features", labelCol=LABEL, predictionCol="prediction", maxIter=trees, maxDepth=depth,
        stepSize=STEP, subsamplingRate=SUBSAMPLE, featureSubsetStrategy=columns, seed=seed, weightCol=weight,
    )
    return Pipeline(stages=[vector, model])


def fit_predict(
    train: DataFrame, test: DataFrame, features: Sequence[str], trees: int = TREES, values: dict[str, float] | None = None,
    bins: Transformer | None = None,
) -> DataFrame:
    """Impute with the medians of ``train`` (or those given), fit on it, predict ``test``.

    A feature without any value in ``train`` has no median and is left out of the fit.
    """
    model, values = fit(train, features, trees, values, bins)
    return predicted(model, impute(test, values))


def predicted(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with their ``prediction``, without what the stages of the model add for themselves."""
    return model.transform(rows).select(*rows.columns, "prediction")


def fit(
    train: DataFrame, features: Sequence[str], trees: int = TREES, values: dict[str, float] | None = None,
    bins: Transformer | None = None, shares: int = SHARES,
) -> tuple[PipelineModel, dict[str, float]]:
    """The fitted trees, and the medians of the features that they use.

    MLlib keeps what it fits as objects and passes over them for each level of each tree. Of more than ``shares`` rows, those
    of equal bins and label are therefore dealt to shares of equal size, so that there are at most ``shares`` and one for
    each combination that occurs. A share is a weighted row: it has the same splits and means as its rows, and each tree
    takes it or leaves it as it does a row. ``values`` and ``bins`` are those of ``train``, if they are known.
    """
    values = feature_medians(train, features) if values is None else values
    used = known_features(features, values)
    known, rows = impute(train, values), train.count()
    if rows <= shares:
        return boosted_trees(used, trees).fit(known), values
    bins = binned(train, used, values) if bins is None else bins
    codes = bins.getOutputCols()
    weighted = dealt(bins.transform(known), [LABEL, *codes], math.ceil(rows / shares))
    fitted = boosted_trees(codes, trees, weight="weight").fit(weighted)
    return PipelineModel([bins, *fitted.stages]), values


def score_rows(rows: DataFrame, model: PipelineModel, values: dict[str, float], required: Sequence[str]) -> DataFrame:
    """Scores, rounded places, podium flags and ranks of rows that may hold anything.

    Features are read as numbers; what is none, NaN too, is missing. Rows without a required feature are left out, other
    gaps get the medians of the fit. It is an error if no row is left.
    """
    nothing = F.lit(None).cast("double")
    numbers = {c: F.nanvl(F.col(c).try_cast("double"), nothing) if c in rows.columns else nothing for c in values}
    valid = rows.withColumns(numbers).dropna(subset=list(required))
    if valid.isEmpty():
        raise ValueError(f"no row has {', '.join(required)}")
    return score_events(predicted(model, impute(valid, values)), "prediction")


def seasons(df: DataFrame) -> list[int]:
    return sorted(r["event_year"] for r in df.select("event_year").distinct().collect())


def season_folds(df: DataFrame) -> DataFrame:
    """Rows to train on and to test on for each season held out."""
    per_season = df.groupBy("event_year").agg(F.count(F.lit(1)).alias("test_rows"))
    # The window sees one row per season.
    others = F.sum("test_rows").over(Window.partitionBy()) - F.col("test_rows")
    return per_season.select(F.col("event_year").alias("held_out_season"), "test_rows", others.alias("train_rows"))


def cross_validate(df: DataFrame, features: Sequence[str], trees: int = TREES) -> DataFrame:
    """Predictions of every season by a model fitted on all others. ``df`` is read once per season: store it first."""
    held_out = seasons(df)
    if len(held_out) < 2:
        raise ValueError("leave-one-season-out needs at least two seasons")

    values: dict[int, dict[str, float]] = {season: {} for season in held_out}
    for row in fold_medians(df, features).collect():
        values[row["event_year"]][row["feature"]] = row["median"]

    def of_season(season: int) -> DataFrame:
        test = F.col("event_year") == season
        return fit_predict(df.where(~test), df.where(test), features, trees, values[season])

    # Folds are fitted side by side: the driver only waits for their jobs.
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        parts = list(pool.map(inheritable_thread_target(df.sparkSession)(of_season), held_out))
    return reduce(DataFrame.unionByName, parts)


def neighbour_pairs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Each finisher of an event next to the one right behind, with the differences of their features.

    The chain of neighbours fixes the whole order of an event, so it says the same as all pairs of drivers while
    it grows with the drivers only. Neighbours meet in an equi-join on the place.
    """
    placed = rank_within(df.where(F.col(LABEL).isNotNull()), EVENT_KEYS, LABEL, "driver_number", "place")
    placed = stored(placed.select(*EVENT_KEYS, "place", "driver_number", *features), "placed")
    ahead = placed.select(*EVENT_KEYS, "place", F.col("driver_number").alias("winner"), *features)
    behind = placed.select(
        *EVENT_KEYS, (F.col("place") - 1).alias("place"), F.col("driver_number").alias("loser"),
        *[F.col(c).alias(f"other_{c}") for c in features],
    )
    pairs = ahead.join(behind, [*EVENT_KEYS, "place"])
    return pairs.select(
        *EVENT_KEYS, "place", "winner", "loser", *[(F.col(c) - F.col(f"other_{c}")).alias(c) for c in features]
    )


def pairwise_scores(train: DataFrame, df: DataFrame, features: Sequence[str], steps: int = 20) -> DataFrame:
    """Linear score learned from who beat whom; a lower score means a better expected place."""
    values = feature_medians(train, features)
    features = [c for c in features if c in values]
    pairs = neighbour_pairs(impute(train, values), features)
    sign = F.explode(F.array(F.lit(1.0), F.lit(-1.0))).alias("sign")
    # Stored, as fitting reads them more than once.
    both = stored(pairs.select(*features), "pairs").select(*features, sign).select(
        *[(F.col(c) * F.col("sign")).alias(c) for c in features], (F.col("sign") < 0).cast("double").alias("label")
    )
    vector = VectorAssembler(inputCols=list(features), outputCol="features")
    learner = LogisticRegression(maxIter=steps, fitIntercept=False, regParam=0.01)
    model = learner.fit(vector.transform(both))
    weights = [float(x) for x in model.coefficients]
    scored = vector.transform(impute(df, values)).withColumn("_x", vector_to_array("features"))
    terms = F.zip_with("_x", F.array(*[F.lit(x) for x in weights]), lambda x, y: x * y)
    score = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return scored.withColumn("predicted_score", score).drop("features", "_x")
