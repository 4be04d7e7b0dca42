"""Near duplicates by SuperMinHash signatures, banding, verification on full sets and union-find grouping.

Texts with equal sets of shingles are one class from the start, so that copies cost one row each. Classes that agree in a
band share a bucket. A bucket is not expanded into pairs:

1. each class is compared with one other, the centre of a bucket, chosen by the number of buckets they share, and found
   links are united;
2. buckets of one component are done. Classes of the other buckets are compared exactly: similar sets must share one of
   their rarest shingles, near enough to the front of both; only pairs of different components that do are verified.
   A shingle that a whole group has in common is not rare there, so it does not pair the group's members.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrank.llm.common import documents, parts, ship
from eventrank.llm.graph import components
from eventrank.llm.minhash import SHINGLE, SLOTS, Sets, band_keys, signatures
from eventrank.sources.session import stored

PERCENT = 85
# Of pairs that are just similar enough, at most this share may have no band in common.
MISSED = 1e-5


def rows_of_band(percent: int, slots: int = SLOTS, missed: float = MISSED) -> int:
    """The largest number of rows for which bands miss at most the given share."""
    able = [r for r in range(1, slots) if (1 - (percent / 100) ** r) ** ((slots - 1) // r) <= missed]
    return max(able, default=1)


def sketches(docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """For each row its text's key, set size, two digests of the set, and band keys (none for an empty set)."""
    ship(docs.sparkSession)
    rows = rows_of_band(percent)

    def run(batches):
        for batch, blob, ends in parts(batches):
            sets = Sets(blob, ends, shingle)
            some = np.flatnonzero(sets.size)
            bands = band_keys(signatures(sets)[some], rows).view(np.int64)
            place = np.zeros(len(batch) + 1, np.int32)
            place[1:] = np.cumsum(np.where(sets.size > 0, bands.shape[1], 0))
            k1, k2 = sets.digests()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sets.size.astype(np.int64)),
                    pa.array(k1.view(np.int64)),
                    pa.array(k2.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(place), pa.array(bands.ravel())),
                ],
                names=["doc_id", "text_key", "n", "k1", "k2", "bands"],
            )

    schema = "doc_id bigint, text_key bigint, n bigint, k1 bigint, k2 bigint, bands array<bigint>"
    return documents(docs, F.xxhash64(F.col("text").cast("string")).alias("text_key")).mapInArrow(run, schema)


def _sets(docs: DataFrame, needed: DataFrame, shingle: int) -> DataFrame:
    """The shingles of the needed classes, from the text of their first document."""

    def run(batches):
        for batch, blob, ends in parts(batches):
            sets = Sets(blob, ends, shingle)
            keys = pa.ListArray.from_arrays(pa.array(sets.first.astype(np.int32)), pa.array(sets.key.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), keys], names=["node", "keys"])

    rows = documents(docs, F.xxhash64(F.col("text").cast("string")).alias("text_key"))
    same = (F.col("doc_id").eqNullSafe(F.col("head.doc_id"))) & (F.col("text_key") == F.col("head.text_key"))
    texts = rows.join(needed.select("node", "head"), same).select("node", "text")
    return texts.mapInArrow(run, "node bigint, keys array<bigint>").dropDuplicates(["node"])


def _similar(a: Column, b: Column, percent: int) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return 100 * shared >= percent * (F.size(a) + F.size(b) - shared)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    one = sets.select(F.col("node").alias("a"), F.col("keys").alias("keys_a"))
    two = sets.select(F.col("node").alias("b"), F.col("keys").alias("keys_b"))
    return pairs.join(one, "a").join(two, "b").where(_similar(F.col("keys_a"), F.col("keys_b"), percent)).select("a", "b")


def _first_links(members: DataFrame) -> DataFrame:
    """Each class with the centre of the buckets that it shares most of; one pair for a class at most.

    The centre of a bucket is its member with most neighbours in all buckets: of a group of changed copies it is one
    that was changed least, which most of the others are similar to.
    """
    degrees = members.groupBy("node").agg(F.sum("size").alias("degree"))
    central = F.max_by("node", F.struct("degree", -F.col("node"))).alias("pivot")
    pivots = members.join(degrees, "node").groupBy("key").agg(central)
    shared = members.join(pivots, "key").where("node <> pivot").groupBy("node", "pivot").agg(F.count("*").alias("n"))
    best = shared.groupBy("node").agg(F.max_by("pivot", F.struct("n", -F.col("pivot"))).alias("pivot"))
    return best.select(F.col("node").alias("a"), F.col("pivot").alias("b"))


def _further_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components that can be similar, by prefixes of their rarest shingles.

    ``sets`` has ``node``, ``component``, ``keys``. Similar sets of n and m shingles share at least
    percent / (100 + percent) * (n + m), so if their shingles stand in one order, the first one in common leaves enough
    of both behind it.
    """
    tokens = sets.select("node", "component", F.size("keys").alias("n"), F.explode("keys").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("df"), F.min("component").alias("low"), F.max("component").alias("high"))
    # A shingle of one class is rarer than all others and matches nothing: it only moves the others back. The counts are
    # stored, so that both sides of the join are dealt out for it and a very common shingle's rows can be split.
    counts = stored(counts.where("df > 1"), "counts")
    ranked = tokens.join(counts, "token").groupBy("node", "component", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "token", (F.col("low") < F.col("high")).alias("mixed")))).alias("ranked")
    )
    length = F.expr(f"size(ranked) + 1 - CAST(({percent} * n + 99) DIV 100 AS int)")
    front = ranked.withColumn("length", length).where("length > 0").select(
        "node", "component", "n", F.posexplode(F.slice("ranked", 1, F.greatest("length", F.lit(1)))), F.size("ranked").alias("m")
    )
    # Shingles behind this one, in the whole order.
    front = front.select("node", "component", "n", "col.token", (F.col("m") - F.col("pos") - 1).alias("behind")).where("col.mixed")
    usual = front.groupBy("token", "component").agg(F.count("*").alias("size"))
    usual = usual.groupBy("token").agg(F.max_by("component", F.struct("size", "component")).alias("usual"), F.count("*").alias("kinds"))
    front = stored(front.join(usual.where("kinds > 1"), "token"), "front")
    # Whether two rows can be similar depends on their sizes and places only. A family of texts has few of those however
    # many members it has, so they are compared first, and members of kinds that cannot be similar never meet.
    kinds = front.groupBy("token", "n", "behind").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    kinds = stored(kinds, "kinds")
    one, two = kinds.alias("a"), kinds.alias("b")
    possible = 1 + F.least("a.behind", "b.behind")
    able = (
        (F.col("a.token") == F.col("b.token"))
        & ((100 + percent) * possible >= percent * (F.col("a.n") + F.col("b.n")))
        & ((F.col("a.low") != F.col("b.low")) | (F.col("a.low") != F.col("a.high")) | (F.col("b.low") != F.col("b.high")))
    )
    met = stored(one.join(two, able).select("a.token", "a.n", "a.behind", F.col("b.n").alias("n2"), F.col("b.behind").alias("behind2")), "met")
    a = front.where("component <> usual").join(met, ["token", "n", "behind"]).select("token", "n2", "behind2", "node", "component", "usual")
    b = front.select("token", F.col("n").alias("n2"), F.col("behind").alias("behind2"), F.col("node").alias("node2"), F.col("component").alias("component2"))
    apart = (F.col("component") != F.col("component2")) & ((F.col("component2") == F.col("usual")) | (F.col("node") < F.col("node2")))
    pairs = a.join(b, ["token", "n2", "behind2"]).where(apart).select(F.col("node").alias("x"), F.col("node2").alias("y"))
    return pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def groups(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """Each row's ``doc_id``, ``text_key``, ``n_shingles``, ``component_id`` and ``kept``.

    Texts are lower-cased (A-Z) and cut into words at white space. Rows are linked if the sizes of intersection and union
    of their shingle sets are at least as ``percent`` to 100. A text of fewer words than a shingle is one shingle; a null
    or blank text has none and is linked with nothing. Repeated rows have one id and are kept or dropped together.
    A null id is larger than all others: its row is kept only if no row of its component has an id.
    """
    rows = stored(sketches(docs, percent, shingle), "sketches")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key")).alias("head")
    classes = rows.where("n > 0").groupBy("n", "k1", "k2").agg(head, F.first("bands").alias("bands"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    banded = classes.select("node", F.explode("bands").alias("key"))
    buckets = stored(banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    members = stored(banded.join(buckets, "key"), "members")
    needed = classes.join(members.select("node").distinct(), "node", "left_semi")
    sets = stored(_sets(docs, needed, shingle), "sets")

    links = stored(_verified(_first_links(members), sets, percent), "links")
    first = components(links)
    placed = members.join(first, "node", "left").select("key", "node", F.coalesce("root", "node").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    open_nodes = placed.join(mixed.select("key"), "key", "left_semi").groupBy("node").agg(F.first("component").alias("component"))
    pairs = _further_pairs(stored(open_nodes.join(sets, "node"), "open"), percent)
    more = stored(_verified(pairs, sets, percent), "links")
    last = components(links.union(more))

    rooted = classes.join(last, "node", "left").select("n", "k1", "k2", "head.doc_id", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labelled = rooted.join(least, "root").select("n", "k1", "k2", "component_id")
    out = rows.drop("bands").join(labelled, ["n", "k1", "k2"], "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_key", F.col("n").alias("n_shingles"), own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def report(docs: DataFrame) -> DataFrame:
    return groups(docs).drop("text_key")


def deduplicated(docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The rows of ``docs``, with all their columns, of one document of each group; of repeated rows one stays."""
    found = stored(groups(docs, percent, shingle), "groups")
    dropped = found.where("NOT kept").select("doc_id", "text_key").distinct()
    text_key = F.xxhash64(docs["text"].cast("string"))
    same = docs["doc_id"].cast("bigint").eqNullSafe(dropped["doc_id"]) & (text_key == dropped["text_key"])
    kept = docs.join(dropped, same, "left_anti")
    if found.count() > found.select("doc_id", "text_key").distinct().count():
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept
