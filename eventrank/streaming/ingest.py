"""Incremental ingest: only files that have not been seen, each exactly once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrank.sources import snapshots
from eventrank.sources.session import stored


def _write_batch(df: DataFrame, path: str, batch: int, parts: Sequence[str]) -> None:
    """Rows of one micro-batch in folders of their own: a batch that is run again replaces just itself."""
    columns = ["batch", *parts]
    writer = df.withColumn("batch", F.lit(batch)).hint("rebalance", *columns).write.partitionBy(*columns)
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    schema: str,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    parts: Sequence[str] = (),
    files_per_batch: int = 1000,
) -> None:
    """Bring everything that has landed since the last call through ``transform`` into ``target``, then stop.

    ``transform`` gets one micro-batch as an ordinary DataFrame. Which files are done is kept in ``checkpoint``.
    """
    arrived = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    query = (
        arrived.writeStream.foreachBatch(lambda df, batch: _write_batch(transform(df), target, batch, parts))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of each key; combined before the shuffle, so a key with very many rows is no burden.

    As a ``transform`` it leaves one row per key and batch; applied once more when reading, one row per key.
    """
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("row"))
    return last.select("row.*")


def merge_new_files(
    spark: SparkSession,
    landing: str,
    schema: str,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: int = 16,
    files_per_batch: int = 1000,
) -> None:
    """Brings everything that has landed since the last call into ``target``, a table with keys (``sources.snapshots``).

    A micro-batch adds its rows to the groups of its keys and becomes visible as one version; one that is run again after
    a failure changes nothing that is read.
    """
    arrived = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    query = (
        arrived.writeStream.foreachBatch(lambda df, _: snapshots.merge(df, target, keys, order, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _split_batch(df: DataFrame, batch: int, late: str, at: str, delay: str, merged: Callable[[DataFrame], object]) -> None:
    """One micro-batch: what is older than the watermark of the batches before goes to ``late``, the rest into the target.

    The watermark is the greatest time of all earlier batches less ``delay``; each batch leaves its greatest time in a
    folder of its own. Run again, a batch finds the same watermark and replaces what it left.
    """
    spark, marks = df.sparkSession, f"{late}/marks"
    rows = stored(df, "batch")
    high = rows.agg(F.max(at).alias("high")).withColumn("batch", F.lit(batch))
    high.write.partitionBy("batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(marks)
    kind = df.schema[at].dataType.simpleString()
    before = spark.read.schema(f"high {kind}, batch bigint").parquet(marks).where(F.col("batch") < batch)
    mark = before.agg((F.max("high") - F.expr(f"INTERVAL {delay}")).alias("mark")).first()["mark"]
    is_late = F.lit(False) if mark is None else F.coalesce(F.col(at) < F.lit(mark).cast(kind), F.lit(False))
    _write_batch(rows.where(is_late), f"{late}/rows", batch, [])
    merged(rows.where(~is_late))


def merge_on_time(
    spark: SparkSession,
    landing: str,
    schema: str,
    target: str,
    late: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    at: str,
    delay: str,
    groups: int = 16,
    files_per_batch: int = 1000,
) -> None:
    """``merge_new_files`` for rows with a time ``at``: those more than ``delay`` (as in "10 DAYS") behind are kept apart.

    A delivery that was interrupted goes on where it was and changes nothing twice. Rows without a time are never late.
    What is remembered between batches is one time per batch.
    """
    arrived = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    merged = lambda rows: snapshots.merge(rows, target, keys, order, groups)
    query = (
        arrived.writeStream.foreachBatch(lambda df, batch: _split_batch(df, batch, late, at, delay, merged))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_late(spark: SparkSession, late: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch bigint").parquet(f"{late}/rows").drop("batch")


def read_newest(spark: SparkSession, target: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return newest(spark.read.parquet(target).drop("batch"), keys, order)
