import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from eventrank.operators import order_stats
from eventrank.operators.model import feature_medians
from eventrank.operators.order_stats import rank_within


@pytest.fixture(scope="module")
def rows():
    """Four groups; one holds most rows, and a third of its rows are equal."""
    rng = random.Random(3)
    out = []
    for group, size in (("hot", 1500), ("one", 1), ("two", 2), ("odd", 301)):
        for i in range(size):
            value = 7.25 if group == "hot" and i % 3 == 0 else rng.uniform(-50, 50)
            out.append((group, value, i))
    rng.shuffle(out)
    return out


def groups(rows):
    found = {}
    for group, value, tie in rows:
        found.setdefault(group, []).append((value, tie))
    return found


@pytest.fixture(scope="module", params=[1.0, 1e-9, 1e12])
def scaled(request, rows):
    return [(group, value * request.param, tie) for group, value, tie in rows]


def test_rank_within(spark, scaled):
    rows = scaled
    df = spark.createDataFrame(rows, "g string, x double, tie int")
    got = {(r.g, r.tie): r.place for r in order_stats.rank_within(df, ["g"], "x", "tie", "place").collect()}
    for group, members in groups(rows).items():
        for place, (_, tie) in enumerate(sorted(members), 1):
            assert got[(group, tie)] == place


def test_medians(spark, scaled):
    rows = scaled
    counts = order_stats.value_counts(spark.createDataFrame(rows, "g string, x double, tie int"), ["g"], "x")
    got = {r.g: r["median"] for r in order_stats.medians(counts, ["g"], "x").collect()}
    for group, members in groups(rows).items():
        assert got[group] == pytest.approx(statistics.median(v for v, _ in members), rel=1e-12, abs=1e-21)


def test_average_ranks(spark):
    df = spark.createDataFrame([("a", x) for x in (3.0, 1.0, 3.0, 2.0, 3.0)], "g string, x double")
    ranks = order_stats.running_counts(order_stats.value_counts(df, ["g"], "x"), ["g"], "x")
    got = {r.x: r.r / 2 for r in ranks.select("x", order_stats.twice_average_rank().alias("r")).collect()}
    assert got == {1.0: 1.0, 2.0: 2.0, 3.0: 4.0}


def test_narrow_range_far_from_zero_is_sliced(spark):
    counts = spark.range(100_000).select(F.lit("g").alias("g"), (F.col("id") + 1.7e9).alias("x"), F.lit(1).alias("n"))
    slices = order_stats.sliced(counts, ["g", "x"], slices=64).groupBy("slice").count()
    assert slices.count() > 50 and slices.agg(F.max("count")).first()[0] < 5000


def test_nan_is_not_ranked(spark):
    df = spark.createDataFrame([("a", x, i) for i, x in enumerate((math.nan, 1.0, 2.0, 3.0, 5.0))], "g string, x double, tie int")
    ranks = {r.tie: r.place for r in order_stats.rank_within(df, ["g"], "x", "tie", "place").collect()}
    assert ranks == {1: 1, 2: 2, 3: 3, 4: 4}
    assert order_stats.medians(order_stats.value_counts(df, ["g"], "x"), ["g"], "x").first()["median"] == 2.5


def test_constant_value_is_ranked_by_tie(spark):
    df = spark.range(2000).select(F.lit("g").alias("g"), F.lit(4.0).alias("x"), (2000 - F.col("id")).alias("tie"))
    ranks = order_stats.rank_within(df, ["g"], "x", "tie", "place")
    assert ranks.where("place <> tie").count() == 0 and ranks.count() == 2000


def test_constant_group_is_sliced_by_tie(spark):
    df = spark.range(50_000).select(F.lit("g").alias("g"), F.lit(4.0).alias("x"), F.col("id").alias("tie"))
    sizes = [r["count"] for r in order_stats.sliced(df, ["g", "x", "tie"], slices=16).groupBy("slice").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 50_000 / 16


@pytest.mark.parametrize("name", ["predicted_rank", "spearman_by_season", "accuracy_by_race", "pair_expand"])
def test_ranks_take_few_exchanges(spark, name):
    from eventrank.catalog import load

    plan = load()[0][name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 12


def test_crowded_groups_rank_like_others(spark):
    r = random.Random(4)
    rows = [(g, r.choice([None, float("nan"), *range(5)]), i) for i, g in enumerate(["a"] * 40 + ["b"] * 3 + [None] * 20 + ["c"])]
    df = spark.createDataFrame([(g, None if v is None else float(v), i) for g, v, i in rows], "g string, v double, i int")
    ranks = [sorted(rank_within(df, ["g"], "v", "i", "rank", crowd).collect(), key=lambda x: x.i) for crowd in (100, 10, 0)]
    assert ranks[0] == ranks[1] == ranks[2]
    assert {x.g for x in ranks[0]} == set("abc")
    for g in "abc":
        group = sorted((x for x in ranks[0] if x.g == g), key=lambda x: (x.v, x.i))
        assert [x["rank"] for x in group] == list(range(1, len(group) + 1))


def test_feature_medians_are_exact(spark):
    r = random.Random(6)
    columns = [[r.gauss(0, 1) for _ in range(2001)], [r.choice([1.0, 7.0]) for _ in range(2001)], [r.choice([None, float("nan"), 3.0, -2.5]) for _ in range(2001)]]
    df = spark.createDataFrame(list(zip(*columns, [None] * 2001, strict=True)), "a double, b double, c double, d double")
    known = [[x for x in c if x is not None and x == x] for c in columns]
    assert feature_medians(df, ["a", "b", "c", "d"]) == {n: statistics.median(c) for n, c in zip("abc", known, strict=True)}
    assert feature_medians(df.limit(0), ["a"]) == {}
