"""Nearest rows of another table against brute force."""

import datetime as dt
import random

import pytest

from eventrank.operators.nearest import nearest_join

START = dt.datetime(2024, 1, 1)
KIND = "k string, at timestamp_ntz, n int"


def moments(seed, n, keys="ab", seconds=400_000):
    r = random.Random(seed)
    return [(r.choice([*keys, None]), START + dt.timedelta(seconds=r.choice([r.randrange(seconds), 3600 * r.randrange(4)])), i) for i in range(n)]


def by_force(left, right):
    out = {}
    for k, at, n in left:
        found = [(abs((t - at).total_seconds()), t, m) for key, t, m in right if key == k and k is not None and at and t]
        out[n] = min(found)[2] if found and at else None
    return out


@pytest.mark.parametrize("bucket", [60, 3600, 86_400 * 30])
def test_nearest_equals_brute_force(spark, bucket):
    left = moments(1, 300, "abc") + [("a", None, 1000), ("never", START, 1001)]
    # Only early and late buckets of one key are filled, and times repeat.
    right = [x for x in moments(2, 120) if x[0] != "b" or x[1].day not in (2, 3)] + [("a", None, 7777)] + [("b", START, 5000 + i) for i in range(200)]
    rows = nearest_join(spark.createDataFrame(left, KIND), spark.createDataFrame(right, KIND), ["k"], "at", "at", ["n"], bucket)
    found = rows.collect()
    assert rows.columns == ["k", "at", "n", "nearest"]
    assert {r.n: r.nearest and r.nearest.n for r in found} == by_force(left, right) and len(found) == len(left)


def test_equally_near_and_repeated_rows(spark):
    hour = dt.timedelta(hours=1)
    left = [("a", START + hour, 1), ("a", START + hour, 1)]
    right = [("a", START + 2 * hour, 1), ("a", START, 9), ("a", START, 3)]
    rows = nearest_join(spark.createDataFrame(left, KIND), spark.createDataFrame(right, KIND), ["k"], "at", "at", ["n"], 3600).collect()
    assert [r.nearest.n for r in rows] == [3, 3]


def test_nothing_to_match(spark):
    left, none = spark.createDataFrame([("a", START, 1)], KIND), spark.createDataFrame([], KIND)
    assert [r.nearest for r in nearest_join(left, none, ["k"], "at", "at", ["n"]).collect()] == [None]
    assert nearest_join(none, left, ["k"], "at", "at", ["n"]).collect() == []
