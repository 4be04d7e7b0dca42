"""Files of one table whose column types have changed between deliveries, and files that were checked before.

Files that have the wanted types are read in one scan. Of the others each column is tried in the types that the reader
knows, on the executors; files with the same types are then read in one scan of their own, and all scans are united by
name. The names of files that do not have the wanted types reach the driver, where Spark lists all of them anyway.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventrank.sources import snapshots
from eventrank.sources.lake import NULL_PARTITION, bulk_status, normal_path, read_bulk
from eventrank.sources.session import stored

# Types that a column is tried in, after the wanted one.
TRIED = ["bigint", "double", "boolean", "date", "timestamp", "timestamp_ntz", "string"]
# Numbers from the narrowest to the widest; each holds those before it.
NUMBERS = ["tinyint", "smallint", "int", "bigint", "float", "double"]
MOMENTS = ["date", "timestamp_ntz", "timestamp"]


def wider(a: str, b: str) -> str:
    """The narrowest type that holds the values of both; text holds everything."""
    for family in (NUMBERS, MOMENTS):
        if a in family and b in family:
            kind = max(a, b, key=family.index)
            # A float has fewer digits than a long number.
            return "double" if kind == "float" and {"int", "bigint"} & {a, b} else kind
    return a if a == b else "string"


def _tried(spark: SparkSession, files: Sequence[str], column: str, kind: str, place: int) -> DataFrame:
    """Rows of each file that can be read with the column in one type."""
    rows = spark.read.schema(T.StructType([T.StructField(column, T.DataType.fromDDL(kind))])).option("ignoreCorruptFiles", True)
    read = rows.parquet(*files).select(normal_path(F.col("_metadata.file_path")).alias("file_path"), F.xxhash64(F.col(f"`{column}`")).alias("h"))
    counted = read.groupBy("file_path").agg(F.count(F.lit(1)).alias("read"), F.bit_xor("h").alias("digest"))
    return counted.select("file_path", F.lit(column).alias("column"), F.lit(place).alias("place"), F.lit(kind).alias("kind"), "read", "digest")


def file_types(spark: SparkSession, files: Sequence[str], schema: str) -> DataFrame:
    """``file_path`` and ``types`` (one for each column of ``schema``, in its order) of files that can be read whole.

    A column takes the first type in which all rows that the footer states can be read: the wanted one, then those of
    ``TRIED``. A column that a file lacks has the wanted type. Files with a column that no type reads are left out.
    """
    wanted = T.StructType.fromDDL(schema)
    stated = spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(*files)
    stated = stated.groupBy(normal_path(F.col("_metadata.file_path")).alias("file_path")).agg(F.count(F.lit(1)).alias("stated"))
    tries = []
    for number, field in enumerate(wanted):
        own = field.dataType.simpleString()
        for place, kind in enumerate([own, *[t for t in TRIED if t != own]]):
            tries.append(_tried(spark, files, field.name, kind, place).withColumn("number", F.lit(number)))
    found = reduce(DataFrame.unionByName, tries).join(stated, "file_path").where("read = stated AND digest IS NOT NULL")
    chosen = found.groupBy("file_path", "number").agg(F.min_by("kind", "place").alias("kind"))
    typed = chosen.groupBy("file_path").agg(F.sort_array(F.collect_list(F.struct("number", "kind"))).alias("kinds"))
    return typed.where(F.size("kinds") == len(wanted)).select("file_path", F.col("kinds.kind").alias("types"))


def _odd_files(spark: SparkSession, paths: Sequence[str], status: DataFrame) -> dict[str, str]:
    """Paths of files that are not good, by their normal form."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listed = reader.load(list(paths)).select("path", normal_path(F.col("path")).alias("file_path"))
    return {r["file_path"]: r["path"] for r in listed.join(status.where("NOT good"), "file_path", "left_semi").collect()}


def _part(name: str, kind: str) -> Column:
    """A partition column from the path of a file; the name for NULL stands for none."""
    value = F.url_decode(F.regexp_extract("file_path", f"/{name}=([^/]*)/", 1))
    return F.when(~value.isin(NULL_PARTITION, "__HIVE_DEFAULT_PARTITION__", ""), value).try_cast(kind).alias(name)


def read_drifting(
    spark: SparkSession,
    paths: Sequence[str],
    schema: str,
    widen: bool = False,
    status: DataFrame | None = None,
    parts: str = "",
) -> DataFrame:
    """All files below ``paths`` whatever types their columns have, with the columns of ``schema`` and those of ``parts``,
    which are read from the names of folders (``col=value``).

    Values come in the wanted types; text that is none of them, and numbers too large for them, become NULL. With
    ``widen`` a column gets the narrowest type that holds the values of all files instead, so that no value is lost.
    Files that cannot be read whole in any types are left out, as in ``read_bulk``.
    """
    wanted = T.StructType.fromDDL(schema)
    status = stored(bulk_status(spark, paths, schema), "status") if status is None else status
    odd = _odd_files(spark, paths, status)
    groups: dict[tuple[str, ...], list[str]] = {}
    if odd:
        for row in file_types(spark, list(odd.values()), schema).collect():
            groups.setdefault(tuple(row["types"]), []).append(odd[row["file_path"]])
    final = [f.dataType.simpleString() for f in wanted]
    if widen:
        for types in groups:
            final = [wider(a, b) for a, b in zip(final, types)]

    folders = T.StructType.fromDDL(parts) if parts else []

    def typed(rows: DataFrame, types: Sequence[str]) -> DataFrame:
        columns = [_cast(F.col(f"`{f.name}`"), a, b).alias(f.name) for f, a, b in zip(wanted, types, final)]
        return rows.select(*columns, *[_part(f.name, f.dataType.simpleString()) for f in folders])

    scans = [typed(read_bulk(spark, paths, schema, status), [f.dataType.simpleString() for f in wanted])]
    for types, files in sorted(groups.items()):
        as_found = T.StructType([T.StructField(f.name, T.DataType.fromDDL(t)) for f, t in zip(wanted, types)])
        scans.append(typed(spark.read.schema(as_found).parquet(*sorted(files)).select("*", "_metadata.file_path"), types))
    return reduce(DataFrame.unionByName, scans)


def _cast(column: Column, kind: str, wanted: str) -> Column:
    """Numbers with a fraction become whole ones only if they are; everything else by ``try_cast``."""
    if kind == "double" and wanted in ("tinyint", "smallint", "int", "bigint"):
        column = F.when(column == F.floor(column), column)
    return column if kind == wanted else column.try_cast(wanted)


_STATE = "path string, length bigint, modified timestamp, file_path string, stated bigint, read bigint, good boolean"


def checked_files(spark: SparkSession, paths: Sequence[str], schema: str, state: str) -> DataFrame:
    """The status of all files below ``paths`` (see ``bulk_status``), of which only new or changed ones are read.

    What is known of a file (its path, length and time of change) is kept in the table ``state``, which becomes the new
    one only when all files are checked. ``known`` tells that the verdict is that of an earlier call. Files that are gone are
    forgotten.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listed = reader.load(list(paths)).select("path", "length", F.col("modificationTime").alias("modified"))
    # Listed once: a file that is delivered meanwhile is left to the next call.
    listed = stored(listed.withColumn("file_path", normal_path(F.col("path"))), "listed")
    if snapshots.current_version(spark, state) is None:
        before = spark.createDataFrame([], _STATE)
    else:
        before = snapshots.read_snapshot(spark, state, _STATE)
    same = ["path", "length", "modified"]
    known = listed.join(before.drop("file_path"), same).withColumn("known", F.lit(True))
    fresh = listed.join(before, same, "left_anti")
    names = [row["path"] for row in fresh.select("path").collect()]
    every = known
    if names:
        status = bulk_status(spark, names, schema)
        every = known.unionByName(fresh.join(status, "file_path").withColumn("known", F.lit(False)))
    every = stored(every, "checked")
    if names or before.count() != every.count():
        snapshots.write_snapshot(every.drop("known"), state)
    return every.select("file_path", "stated", "read", "good", "known")
