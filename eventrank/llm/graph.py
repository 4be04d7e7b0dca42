"""Connected components of undirected links by alternating stars, a distributed union-find."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrank.llm.common import ship
from eventrank.sources.session import stored

# Edges that a task unites at once; more edges of a partition are united in further blocks.
BLOCK_EDGES = 1_000_000


def united(edges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union-find over some edges: each node that is not the least of its group, with the least one."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in list(parent) if root(x) != x]


def _contracted(links: DataFrame) -> DataFrame:
    """The links of each partition replaced by stars of the same components."""

    def run(batches):
        held: list[tuple[int, int]] = []
        for batch in batches:
            held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            if len(held) > BLOCK_EDGES:
                yield star(held)
                held = []
        yield star(held)

    def star(held):
        pairs = united(held)
        return pa.RecordBatch.from_pydict({"a": [x for x, _ in pairs], "b": [x for _, x in pairs]}, schema)

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    return links.mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all nodes of the links (``a``, ``b``) but the roots.

    Each round replaces links by shorter ones to lesser nodes, until all links end at roots; the number of rounds grows
    with the logarithm of the number of nodes. Only two numbers of a round reach the driver.
    """
    ship(links.sparkSession)
    edges = stored(_contracted(links.where("a <> b")), "links")
    state = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("least"))
        # Large star: what is greater than a node moves to the least neighbour of that node.
        large = edges.join(least, F.col("b") == F.col("u")).select("a", F.col("least").alias("b")).distinct()
        # Small star: a node and its lesser neighbours move to the least of them.
        lower = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(lower, "a").select(
            F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e")
        )
        edges = stored(small.select("e.a", "e.b").where("a <> b").distinct(), "links")
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(found)
