"""Vector codes by product quantisation in whole numbers, its searches shortened by LAESA pivots.

Vectors are cut into parts, each position with a codebook of its own. The distances of every part to a few fixed pivots
are computed once and stored. In each round the entries' distances to the same pivots give, by the triangle inequality,
lower bounds for all distances between parts and entries: entries are visited in the order of their bounds, and those
whose bound is beyond the best distance found are never evaluated. Evaluations are exact integer arithmetic.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrank.llm.common import ship
from eventrank.sources.session import stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
PIVOTS = 8
SCALE = 1024
# Rows of one step, and entries that are visited before the remaining bounds are looked at.
STEP_ROWS = 2048
WAVE = 8
# Pivot distances are stored as 32-bit numbers; bounds give way by more than their rounding.
_SLACK = 1e-6
_LONG = (1 << 63) - 1


def finite(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components."""
    inside = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, inside), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a list column as rows of doubles, with zeros behind shorter ones."""
    lengths = np.asarray(column.value_lengths())
    values = np.asarray(column.flatten()).astype(np.float64)
    if (lengths == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def largest_component(width: int) -> int:
    """Components up to this one keep squared distances of ``width`` components within a long."""
    return math.isqrt((1 << 62) // max(width, 1)) // 2


def whole(vectors: np.ndarray) -> np.ndarray:
    limit = largest_component(vectors.shape[1])
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * vectors), -limit, limit).astype(np.int64)


@dataclass
class Codebook:
    """``entries[part][entry]`` and the fixed ``pivots[part][pivot]``, both whole numbers."""

    entries: np.ndarray
    pivots: np.ndarray

    def pivot_distances(self, rows: np.ndarray) -> np.ndarray:
        """Distance of each row's parts to the pivots: row, part, pivot."""
        return np.stack([_distances(rows[:, k], self.pivots[k]) for k in range(len(self.pivots))], axis=1)


def _distances(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    out = np.empty((len(rows), len(others)))
    for j, other in enumerate(others):
        out[:, j] = ((rows - other) ** 2).sum(axis=1)
    return np.sqrt(out)


def start_of(rows: np.ndarray, pivots: int = PIVOTS) -> Codebook:
    """The codebook whose entries are the given rows (row, part, component), and pivots far from one another among them."""
    entries = np.ascontiguousarray(rows.transpose(1, 0, 2))
    chosen = []
    for part in entries:
        far = np.full(len(part), np.inf)
        at, places = 0, []
        while len(places) < min(pivots, len(part)) and far[at] > 0:
            places.append(at)
            far = np.minimum(far, ((part - part[at]) ** 2).sum(axis=1).astype(np.float64))
            at = int(far.argmax())
        # All parts have equally many pivots; a repeated one changes no bound.
        chosen.append(part[(places * pivots)[: min(pivots, len(part))]])
    return Codebook(entries, np.stack(chosen))


def nearest_entries(rows: np.ndarray, far: np.ndarray, entries: np.ndarray, entry_far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of each row's nearest entry, of equally near ones the first; and exact evaluations made."""
    n, size = len(rows), len(entries)
    low = np.zeros((n, size), np.float32)
    for p in range(far.shape[1]):
        a, b = far[:, p, None], entry_far[None, :, p].astype(np.float32)
        np.maximum(low, np.abs(a - b) - np.float32(_SLACK) * (a + b), out=low)
    wave = min(WAVE, size)
    first = np.argpartition(low, wave - 1, axis=1)[:, :wave] if wave < size else np.tile(np.arange(size), (n, 1))
    exact = ((rows[:, None, :] - entries[first]) ** 2).sum(axis=2)
    best = exact.min(axis=1)
    index = np.where(exact == best[:, None], first, size).min(axis=1)
    open_ = low <= np.sqrt(best.astype(np.float64))[:, None] * (1 + _SLACK)
    np.put_along_axis(open_, first, False, axis=1)
    row, entry = np.nonzero(open_)
    if len(row):
        exact = ((rows[row] - entries[entry]) ** 2).sum(axis=1)
        start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        least = np.minimum.reduceat(exact, start)
        at = np.minimum.reduceat(np.where(exact == np.repeat(least, np.diff([*start, len(row)])), entry, size), start)
        which = row[start]
        better = (least < best[which]) | ((least == best[which]) & (at < index[which]))
        best[which[better]], index[which[better]] = least[better], at[better]
    return index, best, n * wave + len(row)


def assigned(rows: np.ndarray, far: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """Entry index and squared distance of each row's parts."""
    entry_far = [_distances(book.entries[k], book.pivots[k]) for k in range(rows.shape[1])]
    index = np.empty(rows.shape[:2], np.int64)
    error = np.empty(rows.shape[:2], np.int64)
    for a in range(0, len(rows), STEP_ROWS):
        for k in range(rows.shape[1]):
            s = slice(a, a + STEP_ROWS)
            index[s, k], error[s, k], _ = nearest_entries(rows[s, k], far[s, k], book.entries[k], entry_far[k])
    return index, error


def _decoded(batch: pa.RecordBatch, shape: tuple[int, int], pivots: int) -> tuple[np.ndarray, np.ndarray]:
    """The stored whole numbers and pivot distances of a batch."""
    rows = np.frombuffer(b"".join(batch.column("whole").to_pylist()), np.int32).reshape(-1, *shape)
    far = np.frombuffer(b"".join(batch.column("far").to_pylist()), np.float32).reshape(-1, shape[0], pivots)
    return rows.astype(np.int64), far


def _prepared(rows: DataFrame, book: Codebook, shape: tuple[int, int]) -> DataFrame:
    """Each vector as whole numbers with its distances to the pivots, computed once for all rounds."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = whole(matrix(batch.column("embedding"), shape[0] * shape[1])).reshape(-1, *shape)
            far = book.pivot_distances(x).astype(np.float32)
            x = x.astype(np.int32)
            columns = [pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in far], pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), *columns], names=["vec_id", "label", "whole", "far"]
            )

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id bigint, label {kind}, whole binary, far binary")


def _improved(data: DataFrame, book: Codebook, shape: tuple[int, int]) -> Codebook:
    """One round: every part goes to its nearest entry, every entry to the middle of its parts; unused entries stay.

    A task sends sums and counts of the entries it has met; what reaches the driver has the size of the codebook.
    """
    parts, size, width = book.entries.shape
    sent = data.sparkSession.sparkContext.broadcast(book)

    def run(batches):
        sums, counts = np.zeros((parts * size, width), np.int64), np.zeros(parts * size, np.int64)
        for batch in batches:
            if len(batch):
                rows, far = _decoded(batch, shape, sent.value.pivots.shape[1])
                index, _ = assigned(rows, far, sent.value)
                for k in range(parts):
                    order = np.argsort(index[:, k], kind="stable")
                    used, start = np.unique(index[order, k], return_index=True)
                    sums[k * size + used] += np.add.reduceat(rows[order, k], start, axis=0)
                    counts[k * size + used] += np.diff([*start, len(order)])
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met), pa.array(counts[met]), pa.array(list(sums[met]), pa.list_(pa.int64()))], names=["slot", "n", "sums"]
        )

    found = data.mapInArrow(run, "slot bigint, n bigint, sums array<bigint>").select("slot", "n", F.posexplode("sums").alias("at", "x"))
    total = found.groupBy("slot", "at").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(20,0)")).alias("x"))
    entries = book.entries.reshape(-1, width).copy()
    for r in total.collect():
        entries[r["slot"], r["at"]] = int(r["x"]) // r["n"]
    sent.unpersist()
    return Codebook(entries.reshape(book.entries.shape), book.pivots)


def compressed(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS
) -> tuple[DataFrame, Codebook | None]:
    """``vec_id``, ``label``, ``codes`` (one entry number for each part) and ``error`` of every kept row, and the codebook.

    ``vectors`` has ``vec_id``, ``embedding`` and ``label``; other columns are left out. Rows whose vector is null or holds
    a null, NaN or infinite component are dropped, repeated rows are rows of their own. Components become
    floor(1024 x), at most as large as ``largest_component`` allows (131,072 of 64), beyond which they count as
    that. Vectors shorter than the longest, or whose length is no multiple of ``parts``, are continued by zeros. The
    codebooks start from the rows of the least ids (null last, ties by vector); an empty table has none.
    """
    ship(vectors.sparkSession)
    kind = vectors.schema["embedding"].dataType.simpleString()
    vector = F.col("embedding").cast(kind if kind in ("array<float>", "array<double>") else "array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("embedding"), "label").where(finite(F.col("embedding")))
    longest = rows.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return rows.select("vec_id", "label", F.array().cast("array<bigint>").alias("codes"), F.lit(0).cast("bigint").alias("error")), None
    shape = (parts, max(-(-longest // parts), 1))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").toArrow()
    book = start_of(whole(matrix(first.column(0).combine_chunks(), shape[0] * shape[1])).reshape(-1, *shape), pivots)
    data = stored(_prepared(rows, book, shape), "vectors")
    for _ in range(rounds):
        book = _improved(data, book, shape)
    sent = vectors.sparkSession.sparkContext.broadcast(book)

    def run(batches):
        for batch in batches:
            if len(batch):
                index, error = assigned(*_decoded(batch, shape, sent.value.pivots.shape[1]), sent.value)
                out = [batch.column("vec_id"), batch.column("label"), pa.array(list(index), pa.list_(pa.int64())), pa.array(error.sum(axis=1))]
                yield pa.RecordBatch.from_arrays(out, names=["vec_id", "label", "codes", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    return data.mapInArrow(run, f"vec_id bigint, label {kind}, codes array<bigint>, error bigint"), book


def digest(book: Codebook) -> str:
    """SHA-256 of all entries' components in the order of part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, book.entries.ravel().tolist())).encode()).hexdigest()


def report(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every kept row.

    Sums beyond a long are given as the largest long. Null labels are one label.
    """
    found, book = compressed(vectors)
    if book is None:
        return found.select(
            "vec_id", F.lit("").alias("code"), "error", F.lit(0).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256")
        )
    found = stored(found, "codes")
    # The sums are stored, so that few of them are broadcast and the rows of a common label can be split in a join of many.
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("bigint")
    sums = stored(found.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")), "sums")
    code = F.array_join(F.transform("codes", lambda x: F.lpad(F.lower(F.hex(x)), 2, "0")), "")
    rows = found.join(sums, F.col("label").eqNullSafe(F.col("of")), "left")
    return rows.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest(book)).alias("codebooks_sha256"))
