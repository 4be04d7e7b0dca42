"""Reading and writing tables in folders: partitioned, by run id, in bulk, as JSON or CSV.

All access goes through Spark's readers and writers, so any file system that the executors share will do.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventrank.schemas import require_columns
from eventrank.sources.session import stored

NULL_PARTITION = "__NULL__"
# Fixed value: errors that a write report tells at most.
REPORTED_ERRORS = 10
# Fixed value: the first and last bytes of a Parquet file. A file without rows is no larger than a footer.
PARQUET_MAGIC = "PAR1"
FOOTER_BYTES = 1 << 20


@dataclass
class WriteReport:
    """What a write did: rows written, files of the data before that were deleted, the first errors of deleting."""

    rows: int = 0
    deleted: int = 0
    errors: list[str] = field(default_factory=list)


def pointer_columns(path: Column) -> list[Column]:
    """Bucket, key and folder of an object path; text without scheme is taken as it is."""
    bare = F.regexp_replace(path, "^s3://", "")
    key = F.regexp_extract(bare, "^[^/]*/(.*)$", 1)
    return [
        F.substring_index(bare, "/", 1).alias("bucket"),
        key.alias("key"),
        F.regexp_replace(key, "/?[^/]*$", "").alias("folder"),
    ]


def _partition_value(name: str) -> Column:
    safe = F.replace(F.trim(F.col(name).cast("string")), F.lit("/"), F.lit("_"))
    return F.coalesce(safe, F.lit(NULL_PARTITION)).alias(name)


def _data_files(spark: SparkSession, path: str) -> tuple[object, list]:
    """The file system of ``path`` and the data files below it."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    if system.exists(root):
        files = system.listFiles(root, True)
        while files.hasNext():
            file = files.next().getPath()
            if not file.getName().startswith(("_", ".")):
                found.append(file)
    return system, found


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the data files below ``path``; none if there is no such folder."""
    return [file.toString() for file in _data_files(spark, path)[1]]


def _delete(system, files: list, report: WriteReport) -> None:
    for file in files:
        try:
            report.deleted += bool(system.delete(file, False))
        except Exception as error:  # told in the report; the new data is complete
            if len(report.errors) < REPORTED_ERRORS:
                report.errors.append(f"{file.toString()}: {error}")


def write_partitioned(
    df: DataFrame, path: str, parts: Sequence[str], whole: bool = True, order: Sequence[str] = ()
) -> WriteReport:
    """Snappy Parquet below ``col=value`` folders; the partition columns are kept in the path only.

    ``whole`` replaces the full dataset, and leaves it alone when there are no rows; otherwise only the
    partitions that occur in ``df`` are replaced. ``df`` is run once: whether it had rows is known after writing, and
    only then the files of before are deleted. Rows are rebalanced by partition: small partitions share a
    task and write one file each, a partition that holds a large share of the rows is split over several.
    ``order`` sorts the rows of all files instead, range by range.
    """
    require_columns(df, [*parts, *order])
    spark, seen = df.sparkSession, Observation()
    if order:
        # Ranges are found by sampling, which would run the source a second time.
        df = stored(df, "ordered").repartitionByRange(*order).sortWithinPartitions(*parts, *order)
    named = df.select(*[_partition_value(c) if c in parts else F.col(c) for c in df.columns])
    dealt = (named if order else named.hint("rebalance", *parts)).observe(seen, F.count(F.lit(1)).alias("rows"))
    report = WriteReport()
    if whole:
        system, before = _data_files(spark, path)
        dealt.write.partitionBy(*parts).mode("append").parquet(path)
        report.rows = seen.get["rows"]
        if report.rows:
            _delete(system, before, report)
    else:
        writer = dealt.write.partitionBy(*parts).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
        report.rows = seen.get["rows"]
    return report


def _named_partitions(spark: SparkSession, path: str, schema: str, parts: Sequence[str]) -> tuple[DataFrame, T.StructType]:
    """The dataset with its partition columns as text, since the name for NULL is no number, and the wanted schema."""
    wanted = T.StructType.fromDDL(schema)
    as_text = T.StructType([T.StructField(f.name, T.StringType() if f.name in parts else f.dataType) for f in wanted])
    return spark.read.schema(as_text).parquet(path), wanted


def _typed_partitions(df: DataFrame, wanted: T.StructType, parts: Sequence[str]) -> DataFrame:
    return df.withColumns({p: F.nullif(F.col(p), F.lit(NULL_PARTITION)).cast(wanted[p].dataType) for p in parts})


def read_partitioned(spark: SparkSession, path: str, schema: str, parts: Sequence[str]) -> DataFrame:
    """Partitioned dataset with a given schema: columns that a file lacks read as NULL."""
    df, wanted = _named_partitions(spark, path, schema, parts)
    return _typed_partitions(df, wanted, parts)


def read_session(spark: SparkSession, path: str, schema: str, event_year: int, event: str, session: str) -> DataFrame:
    """Rows of one session; only its folder is read. A session without rows is an error."""
    parts = ["event_year", "event", "session"]
    df, wanted = _named_partitions(spark, path, schema, parts)
    chosen = df.where((F.col("event_year") == str(event_year)) & (F.col("event") == event) & (F.col("session") == session))
    rows = _typed_partitions(chosen, wanted, parts)
    if rows.isEmpty():
        raise ValueError(f"no rows for event_year={event_year} event={event} session={session}")
    return rows


def write_summary(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    """Rows, files and partitions below ``path``."""
    written = spark.read.parquet(path).select("*", "_metadata.file_path")
    return written.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("file_path").alias("files"),
        F.count_distinct(F.concat_ws("/", *[F.col(p).cast("string") for p in parts])).alias("partitions"),
    )


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Paths of all files below ``paths``; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.load(list(paths)).select(F.col("path").alias("file_path"))


def normal_path(path: Column) -> Column:
    """A path without its scheme, as readers spell schemes differently."""
    return F.regexp_replace(path, "^[a-z0-9]+:/*", "/")


def _path(column: str = "file_path") -> Column:
    return normal_path(F.col(column)).alias("file_path")


def _readable(spark: SparkSession, paths: Sequence[str], schema: str) -> DataFrame:
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", True).option("recursiveFileLookup", True)
    return reader.parquet(*paths).select("*", "_metadata.file_path")


def bulk_status(spark: SparkSession, paths: Sequence[str], schema: str) -> DataFrame:
    """Each file below ``paths`` with the rows that its footer states, the rows that can be read, and ``good``.

    A file is good if both numbers agree. One whose pages break half way, or that has no footer, is not; one without rows
    is, if it ends as a Parquet file does.
    """
    # Without columns only footers are read.
    stated = _readable(spark, paths, schema).groupBy(_path()).agg(F.count(F.lit(1)).alias("stated"))
    every = _readable(spark, paths, schema)
    columns = [F.col(c) for c in every.columns if c != "file_path"]
    # With a digest of all columns, so that their pages are read to the end.
    read = every.groupBy(_path()).agg(F.count(F.lit(1)).alias("read"), F.bit_xor(F.xxhash64(*columns)).alias("digest"))
    binary = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    small = binary.load(list(paths)).where(F.col("length") <= FOOTER_BYTES)
    magic = F.lit(PARQUET_MAGIC).cast("binary")
    whole = F.expr("substring(content, -4)") == magic
    ended = small.select(_path("path"), whole.alias("ended"))
    status = list_files(spark, paths).select(_path()).join(stated, "file_path", "left").join(read, "file_path", "left")
    counted = status.join(ended, "file_path", "left").withColumns(
        {"stated": F.coalesce("stated", F.lit(0)), "read": F.coalesce("read", F.lit(0))}
    )
    some = (F.col("read") > 0) & F.col("digest").isNotNull()
    good = (F.col("stated") == F.col("read")) & (some | F.coalesce("ended", F.lit(False)))
    return counted.select("file_path", "stated", "read", good.alias("good"))


def read_bulk(spark: SparkSession, paths: Sequence[str], schema: str, status: DataFrame | None = None) -> DataFrame:
    """All Parquet files below ``paths`` in one frame; files that are not good (see ``bulk_status``) are left out whole."""
    status = bulk_status(spark, paths, schema) if status is None else status
    bad = status.where("NOT good").select(F.col("file_path").alias("bad_path"))
    rows = _readable(spark, paths, schema)
    return rows.join(bad, _path() == F.col("bad_path"), "left_anti")


def failed_files(status: DataFrame) -> DataFrame:
    return status.where("NOT good").select("file_path")


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """Output of one run below ``run_id=...``; a repeated run replaces its own rows only."""
    writer = df.withColumn("run_id", F.lit(run_id)).write.partitionBy("run_id").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def latest_run(files: DataFrame) -> DataFrame:
    """Greatest run id found in file paths. Run ids are time stamps, so the greatest is the newest."""
    run_id = F.regexp_extract("file_path", "run_id=([^/]+)/", 1)
    return files.select(run_id.alias("run_id")).where(F.col("run_id") != "").agg(F.max("run_id").alias("run_id"))


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    newest = latest_run(list_files(spark, [path])).first()["run_id"]
    if newest is None:
        raise ValueError(f"no run below {path}")
    # The run id stays text: inference would turn all-digit ids into numbers.
    return spark.read.parquet(f"{path}/run_id={newest}").withColumn("run_id", F.lit(newest))


def _write_line(spark: SparkSession, value: str, path: str) -> None:
    spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def publish_run(df: DataFrame, path: str, run_id: str, metadata: DataFrame) -> None:
    """Output of a run, then its metadata, then the marker that it is complete, and last the pointer to it."""
    spark = df.sparkSession
    write_run(df, f"{path}/data", run_id)
    metadata.write.mode("overwrite").json(f"{path}/metadata/{run_id}")
    _write_line(spark, run_id, f"{path}/complete/{run_id}")
    _write_line(spark, run_id, f"{path}/latest")


def published_run(spark: SparkSession, path: str) -> str:
    """The run that the pointer names; an error if its marker is missing."""
    run_id = spark.read.text(f"{path}/latest").first()["value"]
    _, marked = _data_files(spark, f"{path}/complete/{run_id}")
    if not marked:
        raise ValueError(f"run {run_id} below {path} is not complete")
    return run_id


def read_published(spark: SparkSession, path: str) -> DataFrame:
    run_id = published_run(spark, path)
    return spark.read.parquet(f"{path}/data/run_id={run_id}").withColumn("run_id", F.lit(run_id))


def land(df: DataFrame, path: str, event_year: int, event: str, session: str) -> str:
    """Raw rows of one session, stamped with it, below its folder; the folder is the pointer to keep."""
    folder = f"{path}/{event_year}/{event}/{session}"
    stamped = df.withColumns({"event_year": F.lit(event_year), "event": F.lit(event), "session": F.lit(session)})
    stamped.write.mode("overwrite").parquet(folder)
    return folder


def write_ranked(df: DataFrame, path: str, parts: Sequence[str], order: str) -> None:
    """Rows of each partition in the order of ``order``; a large partition continues in the next file."""
    require_columns(df, [*parts, order])
    placed = stored(df, "ranked").repartitionByRange(*parts, order).sortWithinPartitions(*parts, order)
    placed.write.partitionBy(*parts).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_json(spark: SparkSession, path: str | Sequence[str], schema: str, whole_files: bool = False) -> DataFrame:
    """JSON with a given schema; ``whole_files`` reads one document per file instead of one per line."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).option("multiLine", whole_files).json(paths)


def read_json_lenient(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines without those that cannot be parsed."""
    marked = spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    return marked.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str, rows: int | None = None) -> None:
    """CSV with header; ``rows`` writes the first rows only, as a sample for people to look at."""
    (df if rows is None else df.limit(rows)).write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
