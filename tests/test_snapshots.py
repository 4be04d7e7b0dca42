"""Commits that appear whole or not at all, and merges that write what their keys touch."""

import pathlib

import pytest
from pyspark.sql import functions as F

from eventrank.sources import snapshots as s

SCHEMA = "id bigint, at int, x string"


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def numbers(spark, first, upto, at, x):
    return spark.range(first, upto).select("id", F.lit(at).alias("at"), F.lit(x).alias("x"))


def read(spark, folder, version=None):
    return {r.id: (r.at, r.x) for r in s.read_merged(spark, folder, SCHEMA, ["id"], ["at"], version).collect()}


def lots(folder):
    return {p.name for p in pathlib.Path(f"{folder}/data").glob("lot=*")}


def test_readers_see_one_version(spark, folder):
    schema = "id bigint, year int"
    part = lambda n, year: spark.range(n).withColumn("year", F.lit(year))
    assert s.write_snapshot(part(3, 2024), folder, ["year"]) == 1
    old = s.read_snapshot(spark, folder, schema)
    assert s.write_snapshot(part(5, 2025).union(part(1, None)), folder, ["year"]) == 2
    assert old.count() == 3 and {r.year for r in old.collect()} == {2024}
    assert sorted((r.id, r.year or 0) for r in s.read_snapshot(spark, folder, schema).collect()) == [(0, 0), *[(i, 2025) for i in range(5)]]
    assert s.read_snapshot(spark, folder, schema, 1).count() == 3
    assert s.write_snapshot(part(0, 1), folder, ["year"]) is None and s.current_version(spark, folder) == 2
    s.write_snapshot(part(2, 2026), folder, ["year"])
    assert s.versions(spark, folder) == [2, 3] and len(lots(folder)) == 2
    with pytest.raises(ValueError, match="no version 1"):
        s.read_snapshot(spark, folder, schema, 1)


def test_a_commit_that_breaks_off_changes_nothing(spark, folder, monkeypatch):
    s.write_snapshot(spark.range(3).toDF("id"), folder)

    def broken(*_):
        raise RuntimeError("lost")

    for name in ("_written", "publish"):
        with monkeypatch.context() as patch:
            patch.setattr(s, name, broken)
            with pytest.raises(RuntimeError):
                s.write_snapshot(spark.range(9).toDF("id"), folder)
        assert s.read_snapshot(spark, folder, "id bigint").count() == 3
    assert len(lots(folder)) == 3 and s.sweep(spark, folder) == 2 and len(lots(folder)) == 1
    assert s.read_snapshot(spark, folder, "id bigint").count() == 3


def test_the_second_of_two_writers_fails(spark, folder):
    s.write_snapshot(spark.range(3).toDF("id"), folder)
    found = s.live_lots(spark, folder)
    s.publish(spark, folder, found, 1)
    with pytest.raises(s.Conflict):
        s.publish(spark, folder, found, 1)
    assert s.versions(spark, folder) == [1, 2]


def test_no_table(spark, folder):
    assert s.current_version(spark, folder) is None and s.expire(spark, folder) == 0
    with pytest.raises(ValueError, match="no version"):
        s.live_lots(spark, folder)
    assert s.merge(rows(spark), folder, ["id"], ["at"]) is None


def test_ten_keys_of_a_thousand_groups(spark, folder):
    s.merge(numbers(spark, 0, 20_000, 1, "old"), folder, ["id"], ["at"], groups=1000)
    before = lots(folder)
    assert len(before) == 1000
    s.merge(numbers(spark, 500, 510, 2, "new"), folder, ["id"], ["at"], groups=1000, keep=9)
    assert 1 <= len(lots(folder) - before) <= 10 and before <= lots(folder)
    found = s.read_merged(spark, folder, SCHEMA, ["id"], ["at"])
    assert found.count() == 20_000 and found.where("x = 'new'").count() == 10
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()


def test_groups_are_rewritten_when_additions_outgrow_them(spark, folder):
    s.merge(numbers(spark, 0, 100, 1, "a"), folder, ["id"], ["at"], groups=1, ratio=0.5)
    kinds = lambda: sorted((r.kind, r.rows) for r in s.live_lots(spark, folder).collect())
    s.merge(numbers(spark, 90, 120, 2, "b"), folder, ["id"], ["at"], groups=1, ratio=0.5)
    assert kinds() == [("added", 30), ("base", 100)]
    s.merge(numbers(spark, 0, 30, 3, "c"), folder, ["id"], ["at"], groups=1, ratio=0.5)
    assert kinds() == [("base", 120)]
    want = {i: (1, "a") for i in range(100)} | {i: (2, "b") for i in range(90, 120)} | {i: (3, "c") for i in range(30)}
    assert read(spark, folder) == want


def test_merging_again_and_late_rows_change_nothing(spark, folder):
    first, second = rows(spark, (1, 5, "a"), (1, 7, "b"), (None, 1, "n"), (2, 1, None)), rows(spark, (1, 6, "late"), (None, 2, "m"), (3, 1, "c"))
    want = {1: (7, "b"), None: (2, "m"), 2: (1, None), 3: (1, "c")}
    for batch in (first, second, second, first):
        s.merge(batch, folder, ["id"], ["at"], groups=2)
    assert read(spark, folder) == want
    assert s.merge(rows(spark), folder, ["id"], ["at"], groups=2) == s.current_version(spark, folder)


def test_lookup_reads_the_groups_of_its_keys(spark, folder):
    table = spark.range(300).select((F.col("id") % 30).alias("id"), F.col("id").cast("int").alias("at"), F.lit("x").alias("x"))
    keep = ["id", "at"]
    s.merge(table, folder, keep, ["at"], groups=16, by=["id"])
    asked = spark.createDataFrame([(4,), (9,), (77,), (None,)], "id bigint")
    found = s.lookup(spark, folder, SCHEMA, keep, ["at"], asked, groups=16)
    assert sorted((r.id, r.at) for r in found.collect()) == sorted((i % 30, i) for i in range(300) if i % 30 in (4, 9))
