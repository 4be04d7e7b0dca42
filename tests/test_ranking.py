"""Pairwise gradients against brute force, and what boosting learns from them."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventrank.operators import evaluation as e
from eventrank.operators import pulls, ranking
from eventrank.schemas import EVENT_KEYS

LABEL = e.LABEL


def loss(rows):
    """Sum over all pairs of an event of log(1 + exp(score of the one ahead - score of the one behind))."""
    return sum(
        math.log1p(math.exp(a[2] - b[2])) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1]
    )


def numeric(rows, i, step=1e-4):
    """First and second derivative of the loss by the score of one row."""
    def at(delta):
        moved = list(rows)
        moved[i] = (*rows[i][:2], rows[i][2] + delta)
        return loss(moved)

    return (at(step) - at(-step)) / (2 * step), (at(step) - 2 * at(0) + at(-step)) / step**2


@pytest.mark.parametrize("block", [512, 3])
def test_gradients_equal_derivatives(spark, block):
    r = random.Random(5)
    rows = [(event, r.randint(1, 6), r.choice([0.0, 0.5, -1.25, r.uniform(-3, 3)])) for event in "aab" * 7]
    rows += [("alone", 1, 0.5), ("even", 2, 0.1), ("even", 2, 0.9)] + rows[:3]
    df = spark.createDataFrame([(2024, *x) for x in rows], f"event_year int, event string, {LABEL} int, score double")
    extra = df.withColumn(LABEL, F.lit(None).cast("int"))
    found = {(g.event, g[LABEL], g.score): g for g in ranking.pairwise_gradients(df.union(extra), block=block).collect()}
    assert set(found) == {(a, float(b), c) for a, b, c in rows}
    for i, (event, label, score) in enumerate(rows):
        gradient, curvature = numeric(rows, i)
        assert found[event, label, score].gradient == pytest.approx(gradient, abs=1e-5)
        assert found[event, label, score].curvature == pytest.approx(curvature, abs=1e-3)


def races(spark, seasons=4, events=25, drivers=10):
    """Whoever is nearest to the middle of a feature wins; another feature is noise, one has gaps, one has no value."""
    r, out = random.Random(8), []
    for year in range(2020, 2020 + seasons):
        for event in range(events):
            entries = [(r.uniform(0, 10), r.uniform(0, 1)) for _ in range(drivers)]
            order = sorted(range(drivers), key=lambda d: abs(entries[d][0] - 5))
            out += [(year, f"e{event}", d, *entries[d], entries[d][1] if d % 3 else None, None, order.index(d) + 1) for d in range(drivers)]
    names = f"event_year int, event string, driver_number int, middle double, noise double, gaps double, nothing double, {LABEL} int"
    return spark.createDataFrame(out, names)


FEATURES = ["middle", "noise", "gaps", "nothing"]


def right(scored):
    ranks = e.score_events(scored)
    return ranks.agg(F.avg((F.abs(F.col("predicted_rank") - F.col(LABEL)) <= 1).cast("int"))).first()[0]


def test_boosting_orders_an_unseen_season(spark):
    rows = races(spark)
    train, test = rows.where("event_year < 2023"), rows.where("event_year = 2023")
    model = ranking.boost(train, FEATURES, trees=8, step=0.5)
    assert len(model.trees) == 8 and "nothing" not in model.medians
    assert right(model.scored(test)) > 0.7
    first = [r.predicted_score for r in model.scored(test).orderBy("event", "driver_number").collect()]
    again = ranking.boost(train, FEATURES, trees=8, step=0.5)
    assert first == pytest.approx([r.predicted_score for r in again.scored(test).orderBy("event", "driver_number").collect()])


def test_squared_error_learns_places(spark):
    rows = races(spark)
    train, test = rows.where("event_year < 2023"), rows.where("event_year = 2023")
    model = ranking.boost(train, FEATURES, ranking.squared_gradients, trees=6, step=0.5)
    error = F.avg(F.pow(F.col("predicted_score") - F.col(LABEL), 2))
    mean, spread = train.agg(F.avg(LABEL)).first()[0], test.agg(F.var_pop(LABEL)).first()[0]
    assert abs(mean - 5.5) < 0.01 and model.scored(test).agg(error).first()[0] < 0.5 * spread


def test_each_tree_sees_most_columns():
    names = [f"c{i}" for i in range(11)]
    chosen = [ranking._columns(names, 42, k) for k in range(50)]
    assert all(len(c) == 10 and c == sorted(c, key=names.index) for c in chosen)
    assert {n for n in names if any(n not in c for c in chosen)} == set(names)
    assert ranking._columns(["x"], 42, 0) == ["x"]


def test_nothing_to_learn_from(spark):
    rows = races(spark, 1, 1, 2)
    with pytest.raises(ValueError, match="no feature"):
        ranking.boost(rows, ["nothing"])
    alone = rows.where("driver_number = 0")
    assert ranking.boost(alone, ["middle"], trees=3).trees == []
    assert [x.predicted_score for x in ranking.Boosted({"middle": 1.0}, 0.1).scored(alone).collect()] == [0.0]
    assert EVENT_KEYS == ["event_year", "event"]


def test_crowded_events_learn_the_same(spark):
    """Events of more rows than a block meet block by block, others in one task; the trees are the same."""
    rows = races(spark, 2, 6)
    models = [ranking.boost(rows, FEATURES, trees=3, step=0.5, block=block) for block in (512, 4)]
    found = [[x.predicted_score for x in m.scored(rows).orderBy(*EVENT_KEYS, "driver_number").collect()] for m in models]
    assert found[0] == pytest.approx(found[1]) and len(set(found[0])) > 2


def test_rounds_store_sums_only(spark, monkeypatch):
    """What a round writes is bounded by the bins of the features, however many rows there are."""
    sizes, kept = [], ranking.stored
    monkeypatch.setattr(ranking, "stored", lambda df, label: (out := kept(df, label), sizes.append((label, out.count())))[0])
    rows = races(spark, 2, 6).withColumn("middle", F.round("middle")).drop("noise", "gaps", "nothing")
    assert len(ranking.boost(rows, ["middle"], trees=3, step=0.5).trees) == 3
    rounds = [n for label, n in sizes if label not in ("coded", "crowded", "events")]
    assert len(rounds) == 3 and max(rounds) <= 11


def test_squared_rounds_are_summed_in_few_passes(spark, monkeypatch):
    """Rows are read once for ten rounds, the tables between are bounded by bins, and the trees are those fitted on rows."""
    sizes, kept = [], ranking.stored
    rows = races(spark, 2, 12).withColumn("middle", F.round("middle")).drop("noise", "gaps", "nothing")
    rows = rows.union(rows.limit(7)).union(rows.limit(5).withColumn(LABEL, F.lit(None).cast("int")))
    by_rows = ranking.boost(rows, ["middle"], lambda label, score, ends: pulls.squared_pulls(label, score, ends), trees=12, step=0.5)
    monkeypatch.setattr(ranking, "stored", lambda df, label: (out := kept(df, label), sizes.append((label, out.count())))[0])
    few = ranking.boost(rows, ["middle"], ranking.squared_gradients, trees=3, step=0.5)
    assert [label for label, _ in sizes] == ["summed", "cells", "cells", "cells"] and max(n for _, n in sizes) <= 11
    values = ranking.feature_medians(rows, ["middle"])
    model = ranking.boost(rows, ["middle"], ranking.squared_gradients, trees=12, step=0.5, values=values, bins=by_rows.bins)
    assert [label for label, _ in sizes].count("summed") == 3 and len(few.trees) == 3 and len(model.trees) == 12
    found = [[x.predicted_score for x in m.scored(rows).orderBy(*EVENT_KEYS, "driver_number", LABEL).collect()] for m in (by_rows, model)]
    assert found[0] == pytest.approx(found[1]) and len(set(found[0])) > 5


@pytest.mark.parametrize("pairs", [1, 5, 1 << 20])
def test_pulls_equal_gradients_of_blocks(spark, pairs):
    r = random.Random(3)
    rows = [(e, r.randint(1, 4), r.uniform(-2, 2)) for e, n in (("a", 7), ("b", 1), ("c", 4)) for _ in range(n)]
    df = spark.createDataFrame([(2024, *x) for x in rows], f"event_year int, event string, {LABEL} int, score double")
    expected = {(g.event, g.score): (g.gradient, g.curvature) for g in ranking.pairwise_gradients(df).collect()}
    label, score = np.array([float(x[1]) for x in rows]), np.array([x[2] for x in rows])
    found = pulls.pairwise_pulls(label, score, np.array([0, 7, 8, 12]), pairs)
    for (event, _, s), g, h in zip(rows, *found, strict=True):
        assert (g, h) == pytest.approx(expected[event, s])
