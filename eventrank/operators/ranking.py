"""Boosted trees that learn the order of events: the gradient of a pairwise loss, and one regression tree a round.

For a driver who finished ahead of another the loss is log(1 + exp(own score - other score)), so a lower score stands for
a better place. A row's gradient is the sum over all rows of its event that finished elsewhere. It depends on label and
score only, so equal rows are one cell with a count; cells of an event are cut into blocks, and a block of cells meets a
block of partners in one row. No pair becomes a row, and no event has to fit into a task.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrank.operators import pulls
from eventrank.operators.evaluation import LABEL
from eventrank.operators.model import BINS, DEPTH, SEED, STEP, SUBSAMPLE, TREES, binned, feature_medians, impute, known_features
from eventrank.schemas import EVENT_KEYS
from eventrank.sources.session import ship, stored

# Fixed value: share of the features that each tree may use.
COLUMNS = 0.9
# Cells of a block; a block of partners is met by as many.
BLOCK = 512
# Rows of a task that are compared in each round.
TASK_ROWS = 200_000
# Trees whose predictions are added up in one plan.
CHAIN = 20
# Rounds whose sums are taken in one pass over the rows.
ROUNDS = 10


def pairwise_gradients(
    rows: DataFrame, keys: Sequence[str] = EVENT_KEYS, label: str = LABEL, score: str = "score", block: int = BLOCK
) -> DataFrame:
    """``gradient`` and ``curvature`` of each ``keys``, ``label`` and ``score`` that occurs in ``rows``.

    Rows without label or score have none. Rows of one event with equal labels say nothing about each other.
    """
    known = rows.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    cells = known.groupBy(*keys, F.col(label).cast("double").alias("y"), F.col(score).cast("double").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    sizes = cells.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = cells.join(sizes, list(keys)).withColumn("block", F.pmod(F.xxhash64("y", "s"), F.col("blocks")).cast("int"))
    cell = F.struct("y", "s", "n")
    # Sorted, so that sums are added up in the same order whenever a task runs.
    blocks = dealt.groupBy(*keys, "block").agg(F.sort_array(F.collect_list(cell)).alias("own"))
    others = blocks.select(*keys, F.col("block").alias("other"), F.col("own").alias("partners"))

    def pull(own: Column) -> Column:
        zero = F.struct(F.lit(0.0).alias("g"), F.lit(0.0).alias("h"))

        def add(sums: Column, with_: Column) -> Column:
            side = F.signum(with_["y"] - own["y"])
            p = 1 / (1 + F.exp(side * (with_["s"] - own["s"])))
            return F.struct((sums["g"] + side * with_["n"] * p).alias("g"), (sums["h"] + F.abs(side) * with_["n"] * p * (1 - p)).alias("h"))

        return F.aggregate("partners", zero, add)

    met = blocks.join(others, list(keys)).select(
        *keys, "other", F.explode(F.transform("own", lambda own: F.struct(own["y"].alias("y"), own["s"].alias("s"), pull(own).alias("sums")))).alias("cell")
    )
    parts = F.sort_array(F.collect_list(F.struct("other", "cell.sums")))
    total = met.groupBy(*keys, "cell.y", "cell.s").agg(parts.alias("parts"))
    sum_of = lambda name: F.aggregate(F.transform("parts", lambda x: x["sums"][name]), F.lit(0.0), lambda a, x: a + x)
    return total.select(*keys, F.col("y").alias(label), F.col("s").alias(score), sum_of("g").alias("gradient"), sum_of("h").alias("curvature"))


# The loss of a row by itself, for ``boost``.
squared_gradients = pulls.squared_pulls


@dataclass
class Boosted:
    """Trees with the features each of them may use, the medians for missing values, the step of all trees, and the
    bins of the features that the trees look at."""

    medians: dict[str, float]
    step: float
    trees: list[Transformer] = field(default_factory=list)
    bins: Transformer | None = None

    def scored(self, rows: DataFrame, score: str = "predicted_score") -> DataFrame:
        """``rows`` with the sum of all trees; missing features get the medians of the fit."""
        out = impute(rows, self.medians).withColumn(score, F.lit(0.0))
        kept = out.columns
        if self.trees:
            out = self.bins.transform(out)
        for i, tree in enumerate(self.trees, 1):
            out = _raised(out, tree, self.step, score)
            if i % CHAIN == 0 and i < len(self.trees):
                out = stored(out, "scores")
        return out.select(*kept)


def _raised(rows: DataFrame, tree: Transformer, step: float, score: str) -> DataFrame:
    found = tree.transform(rows)
    return found.withColumn(score, F.col(score) + step * F.col("_raise")).drop("_raise", "_features")


def _columns(features: Sequence[str], seed: int, number: int) -> list[str]:
    """The features of one tree, in their order."""
    used = max(1, round(COLUMNS * len(features)))
    chosen = random.Random(f"{seed}:{number}").sample(range(len(features)), used)
    return [features[i] for i in sorted(chosen)]


def _nodes(node, places: Sequence[int]):
    """A fitted tree as numbers, see ``pulls.leaf_values``; ``places`` are those of its features among all."""
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (places[split.featureIndex()], float(split.threshold()), _nodes(node.leftChild(), places), _nodes(node.rightChild(), places))


def boost(
    train: DataFrame,
    features: Sequence[str],
    gradients=pulls.pairwise_pulls,
    trees: int = TREES,
    depth: int = DEPTH,
    step: float = STEP,
    seed: int = SEED,
    keys: Sequence[str] = EVENT_KEYS,
    block: int = BLOCK,
    values: dict[str, float] | None = None,
    bins: Transformer | None = None,
) -> Boosted:
    """Trees fitted round by round to Newton steps: a row's target is its gradient over its curvature, which weighs it.

    Each tree sees ``SUBSAMPLE`` of the rows, chosen by a hash of all they hold, and ``COLUMNS`` of the features. Features
    are cut into ``BINS`` quantiles once, as many as MLlib's trees tell apart, and rows of equal bins are one weighted row
    for the tree: their mean target has the same best splits and leaves. Rows are stored once, an event in one row, so a
    round is one pass over them and shuffles sums only; an event of more than ``block`` rows is kept as rows, which meet
    in ``pairwise_gradients``. With ``squared_gradients`` rows of equal bins have equal scores and differ by label only, so
    one pass sums up ``ROUNDS`` rounds, see ``_summed``. A feature without any value is left out; rows without a label, and
    events in which nobody is ahead of anybody, teach nothing. ``values`` and ``bins`` are those of ``train``, if known.
    """
    spark = train.sparkSession
    ship(spark)
    values = feature_medians(train, features) if values is None else values
    used = known_features(features, values)
    known = impute(train.select(*keys, LABEL, *used), values)
    bins = binned(known, used, values) if bins is None else bins
    codes = bins.getOutputCols()
    model = Boosted(values, step, bins=bins)
    luck = F.xxhash64(F.lit(seed), *keys, *used).alias("_luck")
    labelled = bins.transform(known.where(F.col(LABEL).isNotNull()).dropna(subset=list(keys)))
    rows = labelled.select(*keys, F.col(LABEL).cast("double").alias(LABEL), luck, *[F.col(c).cast("tinyint").alias(c) for c in codes])
    alone = gradients is squared_gradients
    events, crowds = (rows.drop(*keys), None) if alone else _dealt(rows, [LABEL, "_luck", *codes], keys, block)
    events = events if alone and trees <= ROUNDS else stored(events, "events")
    sums = ["gradient double", "curvature double"]
    schema = ", ".join([*sums, *([] if alone else ["_luck bigint"]), *[f"{c} tinyint" for c in codes]])
    nodes: list = []
    for number in range(trees):
        # The plan runs in this round, so it may hold the list of nodes as it is.
        if alone:
            if number % ROUNDS == 0:
                summed = _summed(events, codes, range(number, min(trees, number + ROUNDS)))
            part = summed.select(f"rows{number}", f"labels{number}", *codes)
            sample = part.mapInArrow(lambda batches, n=tuple(nodes): pulls.squared_batches(batches, n, step), schema)
        else:
            sample = events.mapInArrow(lambda batches, n=tuple(nodes): pulls.pulled_batches(batches, n, step, gradients), schema)
            if crowds is not None:
                crowds = stored(crowds, "round")
                sample = sample.unionByName(crowds.join(pairwise_gradients(crowds, keys), [*keys, LABEL, "score"]).select(*sample.columns))
            sample = sample.where(_sampled(number))
        sample = sample.where(F.col("curvature") > 1e-12)
        chosen = _columns(codes, seed, number)
        cells = sample.groupBy(*chosen).agg(F.sum("gradient").alias("pull"), F.sum("curvature").alias("curvature"))
        cells = stored(cells.withColumn("target", -F.col("pull") / F.col("curvature")), "cells")
        if cells.isEmpty():
            break
        vector = VectorAssembler(inputCols=chosen, outputCol="_features")
        learner = DecisionTreeRegressor(
            featuresCol="_features", labelCol="target", weightCol="curvature", predictionCol="_raise", maxDepth=depth, maxBins=BINS, seed=seed
        )
        fitted = learner.fit(vector.transform(cells))
        model.trees.append(PipelineModel([vector, fitted]))
        nodes.append(_nodes(fitted._call_java("rootNode"), [codes.index(c) for c in chosen]))
        if crowds is not None:
            crowds = _raised(crowds, model.trees[-1], step, "score")
    return model


def _sampled(number: int) -> Column:
    """Whether the tree of this number sees a row."""
    return F.xxhash64(F.lit(number), "_luck").cast("double") / 2.0**64 + 0.5 < SUBSAMPLE


def _summed(rows: DataFrame, codes: Sequence[str], rounds: Sequence[int]) -> DataFrame:
    """For each combination of ``codes`` and each of ``rounds``, the number of sampled rows and the sum of their labels."""
    seen = {n: _sampled(n) for n in rounds}
    counts = [F.count_if(seen[n]).alias(f"rows{n}") for n in rounds]
    labels = [F.sum(F.when(seen[n], F.col(LABEL)).otherwise(0.0)).alias(f"labels{n}") for n in rounds]
    return stored(rows.groupBy(*codes).agg(*counts, *labels), "summed")


def _dealt(rows: DataFrame, columns: Sequence[str], keys: Sequence[str], block: int) -> tuple[DataFrame, DataFrame | None]:
    """``columns`` as lists of an event's rows, and the rows of events of more than ``block`` rows with a score of 0."""
    rows = stored(rows, "coded")
    tasks = max(1, rows.count() // TASK_ROWS)
    crowded = stored(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block).select(*keys), "crowded")
    crowds = None
    if not crowded.isEmpty():
        crowds = rows.join(crowded, list(keys), "left_semi").withColumn("score", F.lit(0.0))
        rows = rows.join(crowded, list(keys), "left_anti")
    # Sorted, so that sums are added up in the same order whenever a task runs.
    events = rows.repartition(tasks, *keys).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("rows"))
    return events.select(*[F.col(f"rows.{c}").alias(c) for c in columns]), crowds
