"""Files of other types than the wanted ones, and files that are known from an earlier check."""

import os
import pathlib

import pytest
from pyspark.sql import functions as F

from eventrank.sources import drift, lake, snapshots

SCHEMA = "k bigint, x double"


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("float", "int", "double"), ("float", "smallint", "float"),
    ("date", "timestamp", "timestamp"), ("date", "int", "string"), ("boolean", "bigint", "string"), ("string", "double", "string"), ("int", "int", "int"),
])
def test_wider(a, b, want):
    assert drift.wider(a, b) == drift.wider(b, a) == want


def deliver(spark, folder):
    one = lambda name, select: spark.range(1).selectExpr(*select).coalesce(1).write.parquet(f"{folder}/{name}")
    one("wanted", ["1L AS k", "0.5D AS x"])
    one("narrow", ["2 AS k", "cast(1.5 AS float) AS x"])
    one("whole", ["3L AS k", "7L AS x"])
    one("text", ["'4' AS k", "'n/a' AS x", "true AS more"])
    one("fraction", ["5.0D AS k", "2.5D AS x"])
    one("broken", ["6.5D AS k", "'8' AS x"])
    one("less", ["7L AS k"])
    one("flag", ["8L AS k", "true AS x"])
    spark.createDataFrame([("no table",)], "value string").coalesce(1).write.text(f"{folder}/junk")


def test_wanted_types(spark, folder):
    deliver(spark, folder)
    rows = drift.read_drifting(spark, [folder], SCHEMA)
    assert rows.dtypes == [("k", "bigint"), ("x", "double")]
    want = [(1, 0.5), (2, 1.5), (3, 7.0), (4, None), (5, 2.5), (None, 8.0), (7, None), (8, 1.0)]
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(want, key=str)


def test_widened_types_lose_nothing(spark, folder):
    deliver(spark, folder)
    rows = drift.read_drifting(spark, [folder], SCHEMA, widen=True)
    assert rows.dtypes == [("k", "string"), ("x", "string")]
    found = {r.k: r.x for r in rows.collect()}
    assert found == {"1": "0.5", "2": "1.5", "3": "7", "4": "n/a", "5.0": "2.5", "6.5": "8", "7": None, "8": "true"}


def test_numbers_stay_numbers(spark, folder):
    spark.range(3).selectExpr("cast(id AS int) AS k", "id AS x").write.parquet(f"{folder}/a")
    spark.range(3).selectExpr("id AS k", "id + 0.25D AS x").write.parquet(f"{folder}/b")
    assert drift.read_drifting(spark, [folder], "k int, x bigint", widen=True).dtypes == [("k", "bigint"), ("x", "double")]


def test_partitions_of_drifting_files(spark, folder):
    one = lambda year, event, k, x: spark.createDataFrame([(year, event, k, x)], ["year", "event", "k", "x"])
    lake.write_partitioned(one(2023, "são paulo", 1, 0.5), folder, ["year", "event"])
    lake.write_partitioned(one(2024, "a/b", "2", "1.5"), folder, ["year", "event"], whole=False)
    lake.write_partitioned(one(2025, "c", 3.0, 7).withColumn("event", F.lit(None).cast("string")), folder, ["year", "event"], whole=False)
    rows = drift.read_drifting(spark, [folder], SCHEMA, parts="year int, event string")
    want = [(1, 0.5, 2023, "são paulo"), (2, 1.5, 2024, "a_b"), (3, 7.0, 2025, None)]
    assert sorted(map(tuple, rows.collect())) == want


def test_a_known_file_is_not_read_again(spark, folder):
    data, state = f"{folder}/data", f"{folder}/state"
    wide = spark.range(20_000).select("id", F.md5(F.col("id").cast("string")).alias("x"))
    wide.coalesce(1).write.parquet(f"{data}/a")
    schema = "id bigint, x string"
    check = lambda: sorted((r.file_path.split("/")[-2], r.read, r.good, r.known) for r in drift.checked_files(spark, [data], schema, state).collect())
    assert check() == [("a", 20_000, True, False)]
    # Its pages are spoiled, but length and time are as they were: whoever read it again would notice.
    file = next(pathlib.Path(f"{data}/a").glob("*.parquet"))
    before, content = file.stat(), bytearray(file.read_bytes())
    content[1000 : len(content) // 2] = b"\xff" * (len(content) // 2 - 1000)
    file.write_bytes(bytes(content))
    os.utime(file, ns=(before.st_atime_ns, before.st_mtime_ns))
    file.with_name(f".{file.name}.crc").unlink()
    spark.range(5).selectExpr("id", "'y' AS x").coalesce(1).write.parquet(f"{data}/b")
    version = snapshots.current_version(spark, state)
    assert check() == [("a", 20_000, True, True), ("b", 5, True, False)]
    assert check() == [("a", 20_000, True, True), ("b", 5, True, True)]
    assert snapshots.current_version(spark, state) == version + 1
    # A file that has changed is read again.
    os.utime(file)
    assert [x[2:] for x in check()] == [(False, False), (True, True)]
    assert lake.read_bulk(spark, [data], schema, drift.checked_files(spark, [data], schema, state)).count() == 5
