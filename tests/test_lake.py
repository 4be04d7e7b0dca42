import pathlib

import pytest
from pyspark.sql import functions as F

from eventrank.schemas import conform
from eventrank.sources import lake, session, snapshots
from eventrank.streaming import ingest

PARTS = ["event_year", "event", "session"]
SCHEMA = "driver_number int, points double, event_year int, event string, session string"


def rows(spark, *values):
    return spark.createDataFrame(list(values), "event_year int, event string, session string, driver_number int, points double")


def content(spark, path):
    found = lake.read_partitioned(spark, path, SCHEMA, PARTS).select(*PARTS, "driver_number").collect()
    return sorted((tuple(r) for r in found), key=str)


def test_missing_partition_column(spark, folder):
    with pytest.raises(ValueError, match="session"):
        lake.write_partitioned(rows(spark).drop("session"), folder, PARTS)


def test_whole_write_replaces_and_is_idempotent(spark, folder):
    df = rows(spark, (2024, "a/b", "R", 1, 1.0), (2024, "a/b", "Q", 2, 1.0))
    for _ in range(2):
        lake.write_partitioned(df, folder, PARTS)
    assert content(spark, folder) == [(2024, "a_b", "Q", 2), (2024, "a_b", "R", 1)]
    lake.write_partitioned(rows(spark, (2025, "c", "R", 3, 1.0)), folder, PARTS)
    assert content(spark, folder) == [(2025, "c", "R", 3)]


def test_empty_write_leaves_the_data(spark, folder):
    lake.write_partitioned(rows(spark, (2024, "a", "R", 1, 1.0)), folder, PARTS)
    lake.write_partitioned(rows(spark), folder, PARTS)
    assert len(content(spark, folder)) == 1


def test_limited_write_replaces_its_partitions_only(spark, folder):
    lake.write_partitioned(rows(spark, (2024, "a", "R", 1, 1.0), (2024, "b", "R", 1, 1.0)), folder, PARTS)
    lake.write_partitioned(rows(spark, (2024, "b", "R", 9, 1.0)), folder, PARTS, whole=False)
    assert content(spark, folder) == [(2024, "a", "R", 1), (2024, "b", "R", 9)]


def test_null_partition(spark, folder):
    lake.write_partitioned(rows(spark, (2024, None, "R", 1, 1.0)), folder, PARTS)
    assert content(spark, folder) == [(2024, None, "R", 1)]


def test_session_read(spark, folder):
    lake.write_partitioned(rows(spark, (2024, "a", "R", 1, 1.0), (2024, "a", "Q", 2, 1.0)), folder, PARTS)
    found = lake.read_session(spark, folder, SCHEMA, 2024, "a", "Q")
    assert [r.driver_number for r in found.collect()] == [2]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_year" in plan or "PartitionFilters: [isnotnull(session" in plan
    with pytest.raises(ValueError, match="no rows"):
        lake.read_session(spark, folder, SCHEMA, 2024, "a", "S")


def test_summary_and_failed_files(spark, folder):
    df = spark.range(10).withColumn("part", F.col("id") % 2)
    df.write.partitionBy("part").parquet(folder)
    assert lake.write_summary(spark, folder, ["part"]).first().partitions == 2
    spark.createDataFrame([("no table",)], "value string").coalesce(1).write.text(f"{folder}/part=9")
    spark.range(0).coalesce(1).write.parquet(f"{folder}/part=8")
    status = lake.bulk_status(spark, [folder], "id bigint")
    read, failed = lake.read_bulk(spark, [folder], "id bigint", status), lake.failed_files(status).collect()
    assert read.count() == 10 and len(failed) == 1 and "part=9" in failed[0].file_path


def test_half_read_file_fails_whole(spark, folder):
    spark.range(0, 10).coalesce(1).write.parquet(f"{folder}/a")
    wide = spark.range(50_000).select("id", F.md5(F.col("id").cast("string")).alias("x"))
    wide.coalesce(1).write.option("parquet.block.size", 200_000).parquet(f"{folder}/b")
    file = next(pathlib.Path(f"{folder}/b").glob("*.parquet"))
    data = bytearray(file.read_bytes())
    data[len(data) // 2 : len(data) // 2 + 5000] = b"\xff" * 5000
    file.write_bytes(bytes(data))
    file.with_name(f".{file.name}.crc").unlink()
    status = {r.file_path.split("/")[-2]: r.good for r in lake.bulk_status(spark, [folder], "id bigint, x string").collect()}
    assert status == {"a": True, "b": False}
    assert lake.read_bulk(spark, [folder], "id bigint, x string").count() == 10


def test_null_in_a_number_partition(spark, folder):
    lake.write_partitioned(rows(spark, (None, "a", "R", 1, 1.0), (2024, "a", "R", 2, 1.0)), folder, PARTS)
    assert content(spark, folder) == [(2024, "a", "R", 2), (None, "a", "R", 1)]


def test_write_runs_its_source_once_and_reports(spark, folder):
    ran = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    df = rows(spark, (2024, "a", "R", 1, 1.0), (2024, "b", "R", 2, 1.0))
    lake.write_partitioned(df, folder, PARTS)
    report = lake.write_partitioned(df.mapInArrow(counted, df.schema), folder, PARTS)
    assert ran.value == 2 and report.rows == 2 and report.deleted == 2 and report.errors == []


def test_ordered_write(spark, folder):
    df = spark.range(100).select((F.col("id") * 37 % 100).alias("x"), F.lit("p").alias("part"))
    lake.write_partitioned(df, folder, ["part"], order=["x"])
    files = spark.read.parquet(folder).select("x", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    read = [r.x for r in files.orderBy("f", "i").collect()]
    assert read == sorted(read)


def test_published_run_needs_its_marker(spark, folder):
    about = spark.range(1)
    lake.publish_run(spark.range(3), folder, "20250101T000000Z", about)
    assert lake.read_published(spark, folder).count() == 3
    lake._write_line(spark, "20250301T000000Z", f"{folder}/latest")
    with pytest.raises(ValueError, match="not complete"):
        lake.read_published(spark, folder)


def test_runs(spark, folder):
    lake.write_run(spark.range(2), folder, "20250101T000000Z")
    lake.write_run(spark.range(5), folder, "20250301T000000Z")
    lake.write_run(spark.range(3), folder, "20250301T000000Z")
    assert lake.read_latest(spark, folder).count() == 3
    with pytest.raises(ValueError, match="no run"):
        spark.range(1).write.parquet(f"{folder}-plain")
        lake.read_latest(spark, f"{folder}-plain")


def test_ranked_files_are_in_order(spark, folder):
    df = spark.range(100).selectExpr("2024 AS y", "100 - id AS place")
    lake.write_ranked(df, folder, ["y"], "place")
    back = spark.read.parquet(folder).select("place", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"))
    for file in {r.file for r in back.collect()}:
        places = [r.place for r in back.where(F.col("file") == file).orderBy("at").collect()]
        assert places == sorted(places)
    assert back.count() == 100


def test_csv_sample(spark, folder):
    lake.write_csv(spark.range(10), folder, rows=3)
    assert lake.read_csv(spark, folder, "id bigint").count() == 3


def test_conform_adds_and_casts(spark):
    row = conform(spark.createDataFrame([("7", "x")], "a string, b string"), {"a": "int", "b": "int", "c": "double"}).first()
    assert tuple(row) == (7, None, None)


def test_scratch_folder_follows_the_setting(spark):
    class Conf:
        def get(self, key, default=None):
            return "hdfs://shared/ckpt/" if key == "spark.checkpoint.dir" else default

    class Context:
        applicationId = "app-1"

    class Fake:
        conf, sparkContext = Conf(), Context()

    assert session.scratch_folder(Fake(), "x").startswith("hdfs://shared/ckpt/eventrank-app-1/x-")


def test_stream_takes_each_file_once(spark, folder):
    landing, target, state = (f"{folder}/{n}" for n in ("landing", "target", "state"))
    schema, keys, order = "k string, v int, at int", ["k"], ["at", "v"]

    def deliver(*values):
        spark.createDataFrame(list(values), schema).coalesce(1).write.mode("append").parquet(landing)
        ingest.ingest_new_files(
            spark, landing, schema, lambda df: ingest.newest(df, keys, order), target, state, files_per_batch=1
        )
        return {r.k: r.v for r in ingest.read_newest(spark, target, keys, order).collect()}

    assert deliver(("a", 1, 1), ("b", 1, 5)) == {"a": 1, "b": 1}
    assert deliver(("a", 2, 2), ("b", 0, 4)) == {"a": 2, "b": 1}
    assert deliver(("a", 9, 0), *[("hot", i, i) for i in range(500)]) == {"a": 2, "b": 1, "hot": 499}
    stored = spark.read.parquet(target)
    assert stored.groupBy("batch").count().count() == 3 and stored.count() == 2 + 2 + 2


def test_stream_batch_can_be_repeated(spark, folder):
    for _ in range(2):
        ingest._write_batch(spark.range(4), folder, 7, [])
    assert spark.read.parquet(folder).count() == 4


def test_merged_target_does_not_grow_with_deliveries(spark, folder):
    keys, order, files, schema = ["k"], ["t"], [], "k bigint, t int"
    for delivery in range(4):
        spark.range(40).select(F.col("id").alias("k"), F.lit(delivery).alias("t")).write.mode("append").parquet(f"{folder}/in")
        ingest.merge_new_files(spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/state", keys, order, buckets=4)
        merged = snapshots.read_merged(spark, f"{folder}/out", schema, keys, order).collect()
        assert sorted(r.k for r in merged) == list(range(40)) and {r.t for r in merged} == {delivery}
        files.append(len(lake.data_files(spark, f"{folder}/out/data")))
    # Two versions are kept.
    assert files[0] <= 4 and files[1:] == [2 * files[0]] * 3


def test_late_rows_are_kept_apart_whatever_breaks(spark, folder, monkeypatch):
    import datetime as dt

    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    schema, keys, order = "k string, at timestamp, v int", ["k"], ["at", "v"]
    paths = [f"{folder}/{n}" for n in ("in", "out", "late", "state")]

    def deliver(*values):
        spark.createDataFrame(list(values), schema).coalesce(1).write.mode("append").parquet(paths[0])

    def ingested():
        ingest.merge_on_time(spark, paths[0], schema, *paths[1:3], paths[3], keys, order, "at", "5 DAYS", groups=2)
        table = {r.k: r.v for r in snapshots.read_merged(spark, paths[1], schema, keys, order).collect()}
        return table, sorted(r.v for r in ingest.read_late(spark, paths[2], schema).collect())

    deliver(("a", day(1), 1), ("b", day(20), 2), ("c", None, 3))
    # Nothing is late in the first batch.
    assert ingested() == ({"a": 1, "b": 2, "c": 3}, [])
    deliver(("a", day(14), 4), ("a", day(15), 5), ("b", day(30), 6), ("d", None, 7))

    def broken(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "publish", broken)
        with pytest.raises(Exception, match="lost"):
            ingested()
    want = ({"a": 5, "b": 6, "c": 3, "d": 7}, [4])
    assert ingested() == want and ingested() == want


def test_scratch_is_removed(spark):
    kept = session.stored(spark.range(3), "kept")
    assert kept.count() == 3
    path = session._scratch_root(spark)
    assert pathlib.Path(path).exists()
    session.remove_scratch(spark)
    assert not pathlib.Path(path).exists()
