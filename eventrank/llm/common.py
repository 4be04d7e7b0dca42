"""Reading tables, and slicing Arrow columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrank.sources.session import ship

# Bytes of text that one step of a vectorised operator works on; a longer single text is a step of its own.
SLICE_BYTES = 1 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; only Spark opens the path."""
    ship(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` and the named columns only, so that other columns can have any name."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), *more)


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id's digits leaves 2 when divided by 4. A null id is never learnt."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(True))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its texts; a null is empty."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    blob = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    if column.null_count:
        nulls = np.asarray(column.is_null())
        if (np.diff(ends)[nulls] > 0).any():
            return text_bytes(column.fill_null(""))
    return blob, ends


def slices(ends: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes, or of one row."""
    at, n = 0, len(ends) - 1
    while at < n:
        to = int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to
        at = to


def parts(batches, column: int = 1, limit: int = SLICE_BYTES):
    """For each slice of each Arrow batch: the slice, its text bytes and their offsets."""
    for batch in batches:
        blob, ends = text_bytes(batch.column(column))
        for a, b in slices(ends, limit):
            yield batch.slice(a, b - a), blob[ends[a] : ends[b]], ends[a : b + 1] - ends[a]
