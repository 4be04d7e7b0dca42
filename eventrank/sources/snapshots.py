"""Tables that change as a whole: a commit writes new files, lists them, and only then becomes the current version.

A table is a folder. ``data/lot=...`` holds the rows; a lot is written by one commit and never touched again. A version,
a small file with a number in ``versions``, names the list (``lists/...``) of the lots that are live with it. Readers
resolve the greatest version once and see exactly its lots, whatever is written meanwhile; a writer that breaks off
leaves lots that no list names (``sweep`` removes them). Two writers cannot publish the same number: the later one fails.

Tables with keys deal rows to groups by a hash of their key columns. A batch adds small lots to the groups that its keys
fall into, and rewrites a group only when what has been added to it outgrows a share of it. ``by`` places rows by the
leading key columns, so that all rows of one of them can be looked up in one group.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventrank.schemas import require_columns
from eventrank.sources.session import stored

KEPT_VERSIONS = 2
GROUPS = 64
# A group is rewritten when the rows added to it are more than this share of the rows it was last written with.
RATIO = 0.25
BASE, ADDED = "base", "added"
_LIST = "lot string, grp int, kind string, rows bigint, live boolean"


class Conflict(Exception):
    """Somebody else has published the version that this commit was about to."""


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder, none if it does not exist."""
    _, system, root = _file_system(spark, path)
    return [s.getPath().getName() for s in system.listStatus(root)] if system.exists(root) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, in ascending order; retention keeps them few."""
    return sorted(int(name) for name in _children(spark, f"{path}/versions") if name.isdigit())


def current_version(spark: SparkSession, path: str) -> int | None:
    known = versions(spark, path)
    return known[-1] if known else None


def _named_list(spark: SparkSession, path: str, version: int) -> str:
    jvm, system, file = _file_system(spark, f"{path}/versions/{version}")
    stream = system.open(file)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def live_lots(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The lots of a version (the current one): ``lot``, ``grp``, ``kind``, ``rows``."""
    version = current_version(spark, path) if version is None else version
    if version is None or version not in versions(spark, path):
        raise ValueError(f"no version {'' if version is None else version} of {path}")
    return spark.read.schema(_LIST).parquet(f"{path}/lists/{_named_list(spark, path, version)}")


def publish(spark: SparkSession, path: str, lots: DataFrame, base: int | None) -> int:
    """Makes ``lots`` the version after ``base``; raises ``Conflict`` if there is one already."""
    name, number = uuid.uuid4().hex, (base or 0) + 1
    lots.select("lot", "grp", "kind", "rows", F.lit(True).alias("live")).write.parquet(f"{path}/lists/{name}")
    jvm, system, target = _file_system(spark, f"{path}/versions/{number}")
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}/drafts/{name}")
    system.mkdirs(target.getParent())
    out = system.create(draft, True)
    out.write(bytearray(name.encode()))
    out.close()
    # Moving a file to a name that exists is refused, so a version appears whole and once.
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri())
    never_replace = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(context.makeQualified(draft), context.makeQualified(target), never_replace)
    except Exception as error:
        if system.exists(target):
            raise Conflict(f"version {number} of {path} exists") from error
        raise
    return number


def _write_lots(rows: DataFrame, path: str, parts: Sequence[str]) -> None:
    """``rows`` below the folders of their ``lot``; small lots share a task, a large one is split over several files."""
    rows.hint("rebalance", "lot", *parts).write.partitionBy("lot", *parts).mode("append").parquet(f"{path}/data")


def _written(spark: SparkSession, path: str, commit: str) -> DataFrame:
    """The lots of one commit with their rows, from the footers of their files."""
    lots = spark.read.schema("lot string").parquet(f"{path}/data").where(F.col("lot").startswith(commit))
    named = F.split("lot", "-")
    counted = lots.groupBy("lot").agg(F.count(F.lit(1)).alias("rows"))
    return counted.select("lot", named[1].cast("int").alias("grp"), named[2].alias("kind"), "rows")


def _data(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(T.StructType([*wanted.fields, T.StructField("lot", T.StringType())])).parquet(f"{path}/data")


def write_snapshot(df: DataFrame, path: str, parts: Sequence[str] = (), keep: int = KEPT_VERSIONS) -> int | None:
    """Replaces the whole table by ``df`` and returns the version; without rows the table stays as it is (None).

    ``df`` is run once. Until the version is published readers see the one before, and after that the new one; the files of
    older versions go when ``keep`` newer ones exist, not while they may still be read.
    """
    require_columns(df, list(parts))
    spark, base, commit = df.sparkSession, current_version(df.sparkSession, path), uuid.uuid4().hex
    _write_lots(df.withColumn("lot", F.lit(f"{commit}-0-{BASE}")), path, parts)
    lots = stored(_written(spark, path, commit), "lots")
    if lots.isEmpty():
        return None
    number = publish(spark, path, lots, base)
    expire(spark, path, keep)
    return number


def read_snapshot(spark: SparkSession, path: str, schema: str, version: int | None = None) -> DataFrame:
    """Rows of a version of a table without keys. ``schema`` names partition columns, too."""
    lots = [row["lot"] for row in live_lots(spark, path, version).select("lot").collect()]
    # A snapshot is written as one lot: its folder is the only one that is listed.
    wanted = T.StructType.fromDDL(schema)
    rows = spark.read.schema(wanted).option("basePath", f"{path}/data").parquet(*[f"{path}/data/lot={lot}" for lot in lots])
    return rows.select(*wanted.names)


def expire(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> int:
    """Removes all but the ``keep`` newest versions and the lots that only they name; returns the number of lots.

    What a commit under way has written is in no version and stays. The names of the lots to remove come from an
    anti-join; the driver removes one folder each.
    """
    known = versions(spark, path)
    old, kept = known[:-keep], known[-keep:]
    if not old:
        return 0
    retired, used = (_lists(spark, path, v).select("lot").distinct() for v in (old, kept))
    dead = [row["lot"] for row in retired.join(used, "lot", "left_anti").collect()]
    names = {version: _named_list(spark, path, version) for version in old}
    for version in old:
        _remove(spark, f"{path}/versions/{version}")
    for name in [f"data/lot={lot}" for lot in dead] + [f"lists/{name}" for name in names.values()]:
        _remove(spark, f"{path}/{name}")
    return len(dead)


def sweep(spark: SparkSession, path: str) -> int:
    """Removes lots that no version names, which commits broken off have left; only while nobody writes to the table."""
    used = _lists(spark, path, versions(spark, path)).select("lot").distinct()
    there = [(name.removeprefix("lot="),) for name in _children(spark, f"{path}/data") if name.startswith("lot=")]
    lost = [row["lot"] for row in spark.createDataFrame(there, "lot string").join(used, "lot", "left_anti").collect()]
    for lot in lost:
        _remove(spark, f"{path}/data/lot={lot}")
    return len(lost)


def _lists(spark: SparkSession, path: str, numbers: Sequence[int]) -> DataFrame:
    return spark.read.schema(_LIST).parquet(*[f"{path}/lists/{_named_list(spark, path, v)}" for v in numbers])


def _remove(spark: SparkSession, path: str) -> None:
    _, system, target = _file_system(spark, path)
    system.delete(target, True)


# Tables with keys


def _last(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of each key, combined before the shuffle."""
    last = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("row"))
    return last.select("row.*")


def _group(by: Sequence[str], groups: int):
    return F.pmod(F.xxhash64(*by), F.lit(groups)).cast("int")


def merge(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    groups: int = GROUPS,
    by: Sequence[str] = (),
    ratio: float = RATIO,
    keep: int = KEPT_VERSIONS,
) -> int | None:
    """Brings ``df`` into the table, of which every key's last row by ``order`` stays; returns the version.

    Only groups that a key of ``df`` falls into get new lots: a small one with their new rows, or, if those outgrow
    ``ratio``, one with all rows of the group. Merging the same rows again changes nothing that is read. A null key is a
    key. ``groups`` and ``by`` are those of the first merge ever after.
    """
    require_columns(df, [*keys, *order])
    spark, base = df.sparkSession, current_version(df.sparkSession, path)
    placed = list(by) or list(keys)
    fresh = stored(_last(df, keys, order).withColumn("grp", _group(placed, groups)), "batch")
    arrived = fresh.groupBy("grp").agg(F.count(F.lit(1)).alias("arrived"))
    commit = uuid.uuid4().hex
    if base is None:
        plan = stored(arrived.select("grp", F.lit(True).alias("rewrite")), "plan")
        before = None
    else:
        before = live_lots(spark, path, base)
        is_base = F.col("kind") == BASE
        sizes = before.groupBy("grp").agg(F.sum(F.when(is_base, F.col("rows"))).alias("base"), F.sum(F.when(~is_base, F.col("rows"))).alias("added"))
        total = F.coalesce("added", F.lit(0)) + F.col("arrived")
        rewrite = F.coalesce(total > ratio * F.col("base"), F.lit(True))
        plan = stored(arrived.join(sizes, "grp", "left").select("grp", rewrite.alias("rewrite")), "plan")
    touched, again = plan.agg(F.count(F.lit(1)), F.count_if("rewrite")).first()
    if not touched:
        return base
    rows = fresh.join(plan, "grp")
    rewritten = plan.where("rewrite")
    if before is not None and again:
        old = _rows(spark, path, df.schema, before.join(rewritten, "grp", "left_semi"))
        whole = old.withColumn("grp", _group(placed, groups)).withColumn("rewrite", F.lit(True)).select(rows.columns)
        rows = rows.where("NOT rewrite").unionByName(_last(rows.where("rewrite").unionByName(whole), keys, order))
    kind = F.when(F.col("rewrite"), F.lit(BASE)).otherwise(F.lit(ADDED))
    lot = F.concat(F.lit(commit), F.lit("-"), F.col("grp").cast("string"), F.lit("-"), kind)
    _write_lots(rows.select(*df.columns, lot.alias("lot")), path, [])
    lots = _written(spark, path, commit)
    if before is not None:
        lots = lots.unionByName(before.join(rewritten, "grp", "left_anti").select("lot", "grp", "kind", "rows"))
    number = publish(spark, path, lots, base)
    if keep:
        expire(spark, path, keep)
    return number


def _rows(spark: SparkSession, path: str, schema: str | T.StructType, lots: DataFrame) -> DataFrame:
    """Rows of some lots. The lots are a partition column, so Spark prunes the folders by the other side of the join."""
    live = lots.where("live").select(F.col("lot").alias("of"))
    return _data(spark, path, schema).join(live, F.col("lot") == F.col("of")).drop("of", "lot")


def read_merged(
    spark: SparkSession, path: str, schema: str | T.StructType, keys: Sequence[str], order: Sequence[str], version: int | None = None
) -> DataFrame:
    """The last row of every key. Groups that nothing was added to since they were written are read as they are."""
    return _merged(spark, path, schema, keys, order, live_lots(spark, path, version))


def _merged(spark, path, schema, keys, order, lots: DataFrame) -> DataFrame:
    several = lots.where(F.col("kind") == ADDED).select("grp").distinct()
    plain = _rows(spark, path, schema, lots.join(several, "grp", "left_anti"))
    return plain.unionByName(_last(_rows(spark, path, schema, lots.join(several, "grp", "left_semi")), keys, order))


def lookup(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    keys: Sequence[str],
    order: Sequence[str],
    wanted: DataFrame,
    groups: int = GROUPS,
) -> DataFrame:
    """Rows whose placing columns are among ``wanted``, which has just these; only their groups are read."""
    near = wanted.select(_group(wanted.columns, groups).alias("grp")).distinct()
    found = _merged(spark, path, schema, keys, order, live_lots(spark, path).join(near, "grp", "left_semi"))
    asked = wanted.distinct()
    same = [found[c].eqNullSafe(asked[c]) for c in asked.columns]
    return found.join(asked, reduce(lambda a, b: a & b, same), "left_semi")
