"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are dealt to cells by their nearest centre. What remains of a vector beyond its centre is turned by a random
rotation and kept as one sign bit per dimension, packed, with two scalars: its length and the cosine between it and its
code. From these and a query turned alike, with components of a few bits, bit counts give an estimate of the inner product
and a bound of its error. A query's distances to vectors near it are computed first; then only vectors whose estimated
distance, less the bound, is within what was found are compared exactly.

Codes lie in blocks of one cell and queries in blocks per cell, so that a step works on two bounded blocks. A cell whose
radius shows that it holds nothing near enough is not visited at all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventrank.llm.common import ship
from eventrank.llm.vectorcode import finite
from eventrank.sources.session import stored

# Centres are fitted on so many vectors at most, chosen by a hash of their ids.
SAMPLE = 20_000
CELLS = 128
FIT_STEPS = 8
# Vectors and queries of a block; blocks of one cell that are searched by one task.
BLOCK = 4096
QUERY_BLOCK = 512
GROUP = 16
# Bits of a turned query's components.
QUERY_BITS = 6
# Standard deviations of an estimate by which a vector is given the benefit of the doubt.
DEVIATIONS = 4.0
# Vectors of the nearest cells that are estimated, and compared, to learn how far the neighbours are at most.
SEEN, COMPARED = 4096, 64
SEED = 7


@dataclass
class Cells:
    """Centres by number of dimensions. Cell 0 of any dimension is the origin; a dimension without a sample has no other."""

    centres: dict[int, np.ndarray]

    def of(self, width: int) -> np.ndarray:
        return self.centres.get(width, np.zeros((1, width)))

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        centres = self.of(vectors.shape[1])
        if len(centres) == 1:
            return np.zeros(len(vectors), np.int64)
        # The origin is for dimensions without a sample.
        return ((centres[1:] ** 2).sum(axis=1) - 2 * vectors @ centres[1:].T).argmin(axis=1) + 1


_rotations: dict[int, np.ndarray] = {}


def rotation(width: int) -> np.ndarray:
    """A random rotation, the same on all machines."""
    if width not in _rotations:
        q, r = np.linalg.qr(np.random.default_rng(SEED + width).standard_normal((width, width)))
        _rotations[width] = q * np.sign(np.diag(r))
    return _rotations[width]


def encoded(rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, length, and cosine to the code, of what vectors have beyond their centre."""
    width = rest.shape[1]
    turned = rest @ rotation(width).T
    bits = turned > 0
    length = np.sqrt((rest**2).sum(axis=1))
    with np.errstate(invalid="ignore", divide="ignore"):
        cosine = np.abs(turned).sum(axis=1) / (length * np.sqrt(width))
    packed = np.zeros((len(rest), -(-width // 64) * 8), np.uint8)
    packed[:, : -(-width // 8)] = np.packbits(bits, axis=1)
    return packed.view(np.uint64), length, np.where(length > 0, cosine, 1.0)


def bounds(codes: np.ndarray, length: np.ndarray, cosine: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated squared distances of one query (less its centre) to coded vectors, and how much less they may be."""
    width = len(query)
    own = np.sqrt((query**2).sum())
    if own == 0:
        return length**2, np.zeros(len(length))
    turned = rotation(width) @ (query / own)
    low = turned.min()
    step = max(turned.max() - low, 1e-12) / ((1 << QUERY_BITS) - 1)
    level = np.rint((turned - low) / step).astype(np.int64)
    # Sum over the set bits of the levels, one plane of bits after the other.
    total = np.zeros(len(codes), np.int64)
    for j in range(QUERY_BITS):
        plane = np.zeros(codes.shape[1] * 8, np.uint8)
        plane[: -(-width // 8)] = np.packbits(((level >> j) & 1).astype(bool))
        total += np.bitwise_count(codes & plane.view(np.uint64)).sum(axis=1, dtype=np.int64) << j
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    rounded = low + step * level
    along = (2 * (low * ones + step * total) - rounded.sum()) / np.sqrt(width)
    # Rounding the query costs at most the length of what was rounded off, the code's random direction the rest.
    off = np.sqrt(((turned - rounded) ** 2).sum())
    spread = np.sqrt(np.maximum(1 - cosine**2, 0) / max(width - 1, 1))
    error = np.where(cosine < 1 - 1e-12, (off + DEVIATIONS * spread) / cosine, off)
    return length**2 + own**2 - 2 * length * own * along / cosine, 2 * length * own * error


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed in the order of the components."""
    total = np.zeros(len(vectors))
    for j in range(vectors.shape[1]):
        total += (vectors[:, j] - query[j]) ** 2
    return np.sqrt(total)


def usable(vectors: DataFrame, key: str) -> DataFrame:
    """``key`` and ``embedding`` of rows that have an id and a finite vector other than zero."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    vector = F.col("embedding").cast(kind if kind in ("array<float>", "array<double>") else "array<double>")
    rows = vectors.select(F.col(key).cast("bigint").alias(key), vector.alias("embedding"))
    return rows.where(F.col(key).isNotNull() & finite(F.col("embedding")) & F.exists("embedding", lambda x: x != 0))


def _by_width(column: pa.Array):
    """For each number of dimensions: the places of its vectors, and the vectors as rows of doubles."""
    lengths = np.asarray(column.value_lengths())
    for width in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == width)
        yield at, np.asarray(column.take(pa.array(at)).flatten()).astype(np.float64).reshape(len(at), width)


def fit(rows: DataFrame, n: int, cells: int = CELLS) -> Cells:
    """Centres of a bounded sample by a few steps of Lloyd's method."""
    share = F.xxhash64("vec_id", F.lit(SEED)).cast("double") / 2.0**64 + 0.5
    sample = rows.where(share < F.lit(2.0 * SAMPLE / max(n, 1))).orderBy(share, "vec_id", "embedding").limit(SAMPLE)
    column = sample.select("embedding").toArrow().column(0).combine_chunks()
    centres = {}
    for _, x in _by_width(column):
        k = max(1, min(cells, len(x) // 32))
        c = x[np.random.default_rng(SEED).permutation(len(x))[:k]]
        for _ in range(FIT_STEPS):
            at = ((c**2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
            count = np.bincount(at, minlength=k)
            total = np.zeros_like(c)
            np.add.at(total, at, x)
            c = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], c)
        centres[x.shape[1]] = np.concatenate([np.zeros((1, x.shape[1])), c])
    return Cells(centres)


_CODED = "vec_id bigint, embedding array<{0}>, width int, cell int, code binary, length double, cosine double"


def _coded(rows: DataFrame, cells: Cells) -> DataFrame:
    def run(batches):
        for batch in batches:
            for at, x in _by_width(batch.column("embedding")):
                cell = cells.nearest(x)
                code, length, cosine = encoded(x - cells.of(x.shape[1])[cell])
                own = batch.take(pa.array(at))
                more = [
                    pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(cell.astype(np.int32)),
                    pa.array([c.tobytes() for c in code], pa.binary()), pa.array(length), pa.array(cosine),
                ]
                names = ["vec_id", "embedding", "width", "cell", "code", "length", "cosine"]
                yield pa.RecordBatch.from_arrays([*own.columns, *more], names=names)

    kind = rows.schema["embedding"].dataType.elementType.simpleString()
    return rows.select("vec_id", "embedding").mapInArrow(run, _CODED.format(kind))


def _unpacked(block: pa.Array, width: int) -> tuple[np.ndarray, ...]:
    """Ids, vectors, codes, lengths and cosines of one block."""
    ids, vectors, codes, length, cosine = (block.field(c) for c in ("vec_id", "embedding", "code", "length", "cosine"))
    codes = np.frombuffer(b"".join(codes.to_pylist()), np.uint64).reshape(len(block), -(-width // 64))
    x = np.asarray(vectors.flatten()).reshape(len(block), width)
    return np.asarray(ids), x, codes, np.asarray(length), np.asarray(cosine)


def _searched(pairs: DataFrame, cells: Cells, k: int, compared: int | None) -> DataFrame:
    """For each pair of a block of codes and one of queries: the ``k`` nearest of each query, in the order of their ids.

    With ``compared`` only so many vectors with the least estimates are compared; else all those that can be within the
    query's ``limit``.
    """

    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                width, cell = batch.column("width")[i].as_py(), batch.column("cell")[i].as_py()
                ids, x, codes, length, cosine = _unpacked(batch.column("vectors")[i].values, width)
                asked = batch.column("queries")[i].values
                centre = cells.of(width)[cell]
                out = [], [], []
                points = np.asarray(asked.field("embedding").flatten()).astype(np.float64).reshape(-1, width)
                for node, limit, q in zip(asked.field("node").to_pylist(), asked.field("limit").to_pylist(), points):
                    about, doubt = bounds(codes, length, cosine, q - centre)
                    if compared is None:
                        # A little more, for rounding.
                        at = np.flatnonzero(about - doubt <= limit**2 * (1 + 1e-9) + 1e-9 * (1 + (q**2).sum()))
                    else:
                        at = np.argpartition(about, compared)[:compared] if compared < len(about) else np.arange(len(about))
                    if not len(at):
                        continue
                    found = distances(x[at].astype(np.float64), q)
                    best = np.lexsort((ids[at], found))[:k]
                    best = best[found[best] <= limit]
                    out[0].append(np.full(len(best), node))
                    out[1].append(ids[at][best])
                    out[2].append(found[best])
                columns = [np.concatenate(c) if c else np.zeros(0) for c in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(np.int64)), pa.array(columns[2].astype(np.float64))],
                    names=["node", "vec_id", "score"],
                )

    return pairs.select("width", "cell", "vectors", "queries").mapInArrow(run, "node bigint, vec_id bigint, score double")


def _pairs(blocks: DataFrame, asked: DataFrame, sizes: dict, n_queries: int) -> DataFrame:
    """Blocks of codes with blocks of the queries that visit their cell; a large cell's blocks are dealt to several groups."""
    groups = F.create_map(*[F.lit(x) for (w, c), (n, _) in sizes.items() for x in (f"{w},{c}", -(-_blocks(n) // GROUP))])
    dealt = F.pmod(F.xxhash64("node"), F.lit(max(1, -(-n_queries // QUERY_BLOCK)))).alias("part")
    queries = asked.groupBy("width", "cell", dealt).agg(F.collect_list(F.struct("node", "embedding", "limit")).alias("queries"))
    last = groups[F.concat_ws(",", "width", "cell")] - 1
    queries = queries.withColumn("group", F.explode(F.sequence(F.lit(0), last))).drop("part")
    return blocks.join(queries, ["width", "cell", "group"])


def _blocks(n: int) -> int:
    return max(1, -(-n // BLOCK))


def _visits(queries: DataFrame, cells: Cells, sizes: dict, near: bool) -> DataFrame:
    """The cells that a query has to visit: the nearest ones until enough vectors are seen, or all that may be within its limit."""
    table: dict[int, list] = {}
    for (width, cell), (n, radius) in sizes.items():
        table.setdefault(width, []).append((cell, n, radius))

    def run(batches):
        for batch in batches:
            for at, x in _by_width(batch.column("embedding")):
                own = table.get(x.shape[1], [])
                if not own:
                    continue
                cell, n, radius = (np.array(c) for c in zip(*own))
                centres = cells.of(x.shape[1])[cell]
                far = np.sqrt(np.maximum(((x[:, None, :] - centres) ** 2).sum(axis=2), 0)) if len(x) * len(cell) < 1 << 14 else np.stack(
                    [np.sqrt(((x - c) ** 2).sum(axis=1)) for c in centres], axis=1
                )
                limit = np.asarray(batch.column("limit").take(pa.array(at)))
                if near:
                    order = far.argsort(axis=1, kind="stable")
                    before = np.cumsum(n[order], axis=1) - n[order]
                    visit = np.zeros(far.shape, bool)
                    np.put_along_axis(visit, order, before < SEEN, axis=1)
                else:
                    visit = far - radius * (1 + 1e-9) <= limit[:, None] * (1 + 1e-9) + 1e-9
                row, place = np.nonzero(visit)
                asked = batch.take(pa.array(at[row]))
                more = [pa.array(np.full(len(row), x.shape[1], np.int32)), pa.array(cell[place].astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*asked.columns, *more], names=[*asked.schema.names, "width", "cell"])

    kind = queries.schema["embedding"].dataType.simpleString()
    return queries.select("node", "embedding", "limit").mapInArrow(
        run, f"node bigint, embedding {kind}, limit double, width int, cell int"
    )


def _first(rows: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") <= n).drop("place")


def nearest(vectors: DataFrame, queries: Column, k: int = 10, cells: int = CELLS) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (Euclidean distance) of the ``k`` nearest rows of each query.

    ``vectors`` has ``vec_id`` and ``embedding``; ``queries``, a condition on the id, tells which rows are queries. A query's own id is no
    candidate. Rows without an id take no part, nor do vectors that are null or zero or hold a null, NaN or infinite
    component; vectors of different length are not compared. Repeated rows (equal id and vector) are one. Equal distances
    are ordered by id. Other columns are left out; without queries or candidates there is no row.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors, "vec_id")
    # Of equal vectors no more than k can be among the nearest, besides the query itself; their least ids are.
    kept = _first(rows.groupBy("embedding", "vec_id").agg(F.lit(1).alias("one")), ["embedding"], ["vec_id"], k + 1)
    kept = stored(kept.select("vec_id", "embedding"), "vectors")
    n = kept.count()
    found = fit(kept, n, cells)
    coded = stored(_coded(kept, found), "codes")
    stats = coded.groupBy("width", "cell").agg(F.count("*").alias("n"), F.max("length").alias("radius")).collect()
    sizes = {(r["width"], r["cell"]): (r["n"], r["radius"]) for r in stats}

    wanted = rows.where(queries).select(F.col("vec_id").alias("query_id"), "embedding")
    asked = wanted.groupBy("embedding").agg(F.lit(float("inf")).alias("limit"))
    asked = stored(asked.withColumn("node", F.monotonically_increasing_id()), "queries")
    n_queries = asked.count()
    if not n_queries or not sizes:
        return wanted.limit(0).select("query_id", F.lit(1).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0.0).alias("score"))

    count = F.create_map(*[F.lit(x) for (w, c), (m, _) in sizes.items() for x in (f"{w},{c}", _blocks(m))])
    block = F.pmod(F.xxhash64("vec_id", "code"), count[F.concat_ws(",", "width", "cell")]).cast("int")
    fields = F.struct("vec_id", "embedding", "code", "length", "cosine")
    blocks = coded.withColumn("block", block).groupBy("width", "cell", "block").agg(F.collect_list(fields).alias("vectors"))
    blocks = stored(blocks.withColumn("group", F.floor(F.col("block") / GROUP).cast("int")), "blocks")

    # A distance that k + 1 vectors are within is a limit for the nearest ones.
    close = _searched(_pairs(blocks, _visits(asked, found, sizes, True), sizes, n_queries), found, k + 1, COMPARED)
    limits = _first(close, ["node"], ["score", "vec_id"], k + 1).groupBy("node").agg(F.count("*").alias("n"), F.max("score").alias("score"))
    limits = limits.where(F.col("n") > k).select("node", "score")
    bounded = asked.join(limits, "node", "left").select("node", "embedding", F.coalesce("score", "limit").alias("limit"))
    bounded = stored(bounded, "limits")
    every = _searched(_pairs(blocks, _visits(bounded, found, sizes, False), sizes, n_queries), found, k + 1, None)
    best = _first(every, ["node"], ["score", "vec_id"], k + 1)
    lists = best.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("best"))
    lists = stored(asked.select("node", "embedding").join(lists, "node").select("embedding", "best"), "best")

    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = wanted.distinct().join(lists, "embedding").select("query_id", F.posexplode(others).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score")


def report(vectors: DataFrame) -> DataFrame:
    """The ten nearest rows of every row whose id is divisible by 100."""
    return nearest(vectors, F.col("vec_id") % 100 == 0)
