import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventrank.operators import evaluation as e
from eventrank.operators import model as m

SCHEMA = "event_year int, event string, driver_number int, prediction double, race_finishing_position int"


def frame(spark, rows):
    return spark.createDataFrame([(y, "a", i, float(p), r) for i, (y, p, r) in enumerate(rows)], SCHEMA)


def test_scores_round_half_to_even_and_break_ties_by_number(spark):
    rows = [(2024, "a", 9, 2.5), (2024, "a", 4, 2.5), (2024, "a", 1, 3.5), (2024, "a", 2, None)]
    df = spark.createDataFrame(rows, "event_year int, event string, driver_number int, predicted_score double")
    got = {r.driver_number: (r.predicted_position, r.is_podium_prediction, r.predicted_rank) for r in e.score_events(df).collect()}
    assert got == {4: (2, True, 1), 9: (2, True, 2), 1: (4, False, 3)}


def test_spearman_equals_pandas(spark):
    rng = random.Random(11)
    rows = [(y, rng.randint(1, 8) / 2, rng.randint(1, 12)) for y in (2022, 2023) for _ in range(200)]
    rows += [(2024, 3.0, i) for i in range(5)]
    got = {r.event_year: r.spearman for r in e.spearman(frame(spark, rows)).collect()}
    pdf = pd.DataFrame(rows, columns=["y", "p", "r"])
    for year, part in pdf[pdf.y < 2024].groupby("y"):
        want = part.p.rank(method="average").corr(part.r.rank(method="average"))
        assert got[year] == pytest.approx(want, abs=1e-12)
    assert got[2024] == 0.0


def test_precision_without_predictions_is_zero(spark):
    row = e.precision_recall(frame(spark, [(2024, 9.0, 1), (2024, 8.0, 12)])).first()
    assert (row.precision_at_3, row.recall_at_3, row.precision_at_10, row.recall_at_10) == (0.0, 0.0, 0.5, 1.0)


def test_quality_gate(spark):
    means = spark.createDataFrame([(0.4,)], "precision_at_3 double")
    e.require_quality(means, 0.4)
    with pytest.raises(ValueError, match="0.4000 is below the minimum 0.5000"):
        e.require_quality(means, 0.5)


def test_spread_needs_two_times(spark):
    rows = [(2024, "one", 80.0), (2024, "one", None), (2024, "two", 80.0), (2024, "two", 81.5)]
    rows += [(2024, "many", 80.0 + i) for i in range(15)]
    df = spark.createDataFrame(rows, "event_year int, event string, q3_seconds double")
    got = {r.event: r.top10_gap_spread for r in e.top_spread(df).collect()}
    assert got == {"one": None, "two": 1.5, "many": 9.0}


def test_baseline_feature(spark):
    assert e.baseline_feature(spark.createDataFrame([(1,)], "grid_starting_position int")) == "grid_starting_position"
    with pytest.raises(ValueError):
        e.baseline_feature(spark.createDataFrame([(1,)], "other int"))


def test_ordinal_codes(spark):
    train = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "c string")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "i int, c string")
    assert {r.i: r.code for r in m.ordinal_codes(train, df, "c", "code").collect()} == {1: 0, 2: 1, 3: 0, 4: -1}


def test_one_season_cannot_be_validated(spark):
    with pytest.raises(ValueError, match="at least two seasons"):
        m.cross_validate(frame(spark, [(2024, 1.0, 1), (2024, 2.0, 2)]), ["prediction"], 1)


def test_neighbours_cover_the_order(spark):
    rows = [(2024, p, r) for p, r in ((5, 3), (4, 1), (9, None), (7, 2))]
    got = sorted((r.place, r.prediction) for r in m.neighbour_pairs(frame(spark, rows), ["prediction"]).collect())
    assert got == [(1, -3.0), (2, 2.0)]


@pytest.fixture(scope="module")
def outcome(spark):
    """The finish follows the grid with a little noise."""
    rng = random.Random(2)
    rows = []
    for year in (2022, 2023):
        for event in "abcdef":
            order = sorted(range(1, 13), key=lambda g: g + rng.gauss(0, 1.0))
            rows += [(year, event, grid, float(grid), place) for place, grid in enumerate(order, 1)]
    schema = SCHEMA.replace("prediction", "grid")
    return spark.createDataFrame(rows, schema)


def test_boosted_trees_learn_the_grid(outcome):
    scored = m.cross_validate(outcome, ["grid"], 40)
    assert scored.count() == outcome.count()
    assert all(r.spearman > 0.8 for r in e.spearman(scored).collect())


def test_equal_rows_are_dealt_to_even_shares(spark):
    rows = [(1, 0.0)] * 10 + [(2, 0.0)] + [(1, 1.0)] * 4 + [(None, 1.0)] * 2
    found = m.dealt(spark.createDataFrame(rows, "label int, code double"), ["label", "code"], 4).collect()
    weights = {}
    for r in found:
        weights.setdefault((r.label, r.code), []).append(r.weight)
    assert weights == {(1, 0.0): [10 / 3] * 3, (2, 0.0): [1.0], (1, 1.0): [4.0], (None, 1.0): [2.0]}


def test_trees_of_many_rows_are_fitted_on_shares(spark, outcome, monkeypatch):
    """What MLlib holds is bounded by shares and combinations, not by rows, and the trees learn the same."""
    sizes, kept = {}, m.stored
    monkeypatch.setattr(m, "stored", lambda df, label: (out := kept(df, label), sizes.update({label: out.count()}))[0])
    rows = outcome.union(outcome).union(outcome).withColumn("gap", F.when(F.col("grid") % 3 != 0, F.col("grid") * 0.37))
    model, values = m.fit(rows, ["grid", "gap"], 40, shares=60)
    assert sizes["cells"] < 144 and sizes["cells"] <= sizes["shares"] <= sizes["cells"] + 60 < rows.count()
    alone, _ = m.fit(rows, ["grid", "gap"], 40)
    assert len(alone.stages) == 2 and len(model.stages) == 3
    found = [m.predicted(x, m.impute(rows, values)) for x in (model, alone)]
    assert found[0].columns == found[1].columns == [*rows.columns, "prediction"]
    near = [x.agg(F.avg(F.pow(F.col("prediction") - F.col(e.LABEL), 2))).first()[0] for x in found]
    assert near[0] < 1.1 * near[1] and all(r.spearman > 0.8 for x in found for r in e.spearman(x).collect())


def test_shares_keep_weight_means(spark):
    """Trees of shares and of rows agree on a table whose rows are equal in large groups."""
    rows = spark.range(4000).selectExpr("CAST(2020 AS INT) event_year", "CAST(id % 4 AS DOUBLE) x", f"CAST(IF(id % 4 = 3 OR id < 1000, 9, 1) AS INT) {e.LABEL}")
    models = [m.fit(rows, ["x"], 60, shares=n)[0] for n in (400, 10_000)]
    found = [{r.x: r.prediction for r in m.predicted(x, rows).dropDuplicates(["x"]).collect()} for x in models]
    assert found[0] == pytest.approx(found[1], abs=0.15) and found[0][3.0] - found[0][0.0] > 4


def test_pairwise_ranking_learns_the_grid(outcome):
    scored = e.score_events(m.pairwise_scores(outcome, outcome, ["grid"]))
    assert all(r.predicted_rank == r.driver_number for r in scored.collect())


def test_scoring_leaves_out_what_is_no_number(spark):
    train = spark.createDataFrame([(2000 + i % 3, "a", i, float(i % 7), None, i % 7 + 1) for i in range(60)],
                                  f"event_year int, event string, driver_number int, x double, gap double, {e.LABEL} int")
    model, values = m.fit(train, ["x", "gap"], trees=3)
    assert list(values) == ["x"]
    rows = spark.createDataFrame([(2004, "a", 1, "3"), (2004, "a", 2, "NaN"), (2004, "a", 3, "fast"), (2004, "a", 4, "1.5"), (2004, "a", 5, None)],
                                 "event_year int, event string, driver_number int, x string")
    scored = m.score_rows(rows, model, values, ["x"]).collect()
    assert {r.driver_number: r.predicted_rank for r in scored} == {4: 1, 1: 2}
    with pytest.raises(ValueError, match="no row"):
        m.score_rows(rows.where("driver_number IN (2, 3)"), model, values, ["x"])


def test_nan_score_is_no_score(spark):
    rows = spark.createDataFrame([(2000, "a", 1, float("nan")), (2000, "a", 2, 2.5)], "event_year int, event string, driver_number int, predicted_score double")
    assert [(r.driver_number, r.predicted_position, r.predicted_rank) for r in e.score_events(rows).collect()] == [(2, 2, 1)]


def test_labels_are_numbered_in_order(spark):
    rows = spark.range(5000).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("c"))
    codes = m.numbered(rows.repartition(5).union(rows), "c", "code")
    assert codes.where("code <> cast(substring(c, 2) AS int)").count() == 0 and codes.count() == 5000


def test_fold_medians_equal_medians_of_the_other_folds(spark):
    import random

    r = random.Random(2)
    value = lambda: r.choice([None, float("nan"), 1.0, 2.0, round(r.uniform(0, 5), 1)])
    rows = [(2020 + i % 5, value(), value(), None if i % 5 else 3.0) for i in range(400)]
    df = spark.createDataFrame(rows, "event_year int, a double, b double, only2020 double")
    found = {}
    for x in m.fold_medians(df, ["a", "b", "only2020"]).collect():
        found.setdefault(x.event_year, {})[x.feature] = x.median
    clean = df.replace(float("nan"), None)
    want = {s: m.feature_medians(clean.where(df.event_year != s), ["a", "b", "only2020"]) for s in range(2020, 2025)}
    assert found == want and "only2020" not in found[2020]
