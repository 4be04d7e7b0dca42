"""Benchmark decontamination by a prefix-filtered set join.

Elements are word shingles, ordered by rarity: the number of documents that hold them. A document can only contain a
window if it contains the window's rarest shingle, so the necessary prefix of a window is one shingle. Positions of these
prefix shingles give candidate places; places that would begin before or end after the text are dropped, and the rest is
verified word by word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrank.llm.common import documents, parts, ship
from eventrank.llm.words import ALNUM, U, Words, joined
from eventrank.sources.session import stored

WINDOW = 13
SHINGLE = 3
# A document is contaminated if its words are at most this many times those that are hit.
SHARE = 20
# Windows of one block; a larger benchmark is searched in several blocks, one after the other.
BLOCK_WINDOWS = 100_000
FILTER_BITS = 20

SCHEMA = "row bigint, doc_id bigint, text_key bigint, n_words bigint, hits array<struct<start:int,end:int>>, items array<string>"


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item, words) windows; words are 64-bit hashes. An item of fewer words is one window, without words none."""

    def run(batches):
        for batch, blob, ends in parts(batches):
            words = Words(blob, ends, ALNUM)
            items, rows = batch.column(0).to_pylist(), {"item": [], "words": []}
            for d, item in enumerate(items):
                keys = words.key[words.first[d] : words.first[d + 1]].view(np.int64)
                for at in range(max(len(keys) - window, 0) + 1 if len(keys) else 0):
                    rows["item"].append(item)
                    rows["words"].append(keys[at : at + window])
                    if len(rows["item"]) == 10_000:
                        yield pa.RecordBatch.from_pydict(rows, schema)
                        rows = {"item": [], "words": []}
            yield pa.RecordBatch.from_pydict(rows, schema)

    schema = pa.schema([("item", pa.string()), ("words", pa.list_(pa.int64()))])
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string"))
    items = items.where("item IS NOT NULL AND text IS NOT NULL")
    return items.mapInArrow(run, "item string, words array<bigint>").distinct()


class Block:
    """The windows of one block as arrays; sent to all tasks, its size is bounded by ``BLOCK_WINDOWS``."""

    def __init__(self, rows: pa.Table):
        names = sorted(set(rows["item"].to_pylist()))
        code = {x: i for i, x in enumerate(names)}
        held: dict[tuple, list[int]] = {}
        for item, words in zip(rows["item"].to_pylist(), rows["words"].to_pylist()):
            held.setdefault(tuple(words), []).append(code[item])
        windows = sorted(held)
        self.names = names
        self.length = np.array([len(w) for w in windows], np.int64)
        self.width = int(self.length.max()) if windows else 0
        self.words = np.zeros((len(windows), self.width), U)
        for i, w in enumerate(windows):
            self.words[i, : len(w)] = np.array(w, np.int64).view(U)
        self.items = [held[w] for w in windows]
        self.sizes = sorted({min(SHINGLE, n) for n in self.length.tolist()})

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, offset and hash of all shingles of the windows that have to be found by shingles of k words."""
        rows = np.flatnonzero(np.minimum(self.length, SHINGLE) == k)
        window, offset, key = [], [], []
        for o in range(self.width - k + 1):
            has = rows[self.length[rows] >= o + k]
            window.append(has)
            offset.append(np.full(len(has), o))
            key.append(joined([self.words[has, o + j] for j in range(k)]))
        return np.concatenate(window), np.concatenate(offset), np.concatenate(key)


class Lookup:
    """Sorted keys behind a bit table, which lets few absent keys through to the search."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.bits = np.zeros(1 << FILTER_BITS, bool)
        self.bits[(self.keys >> U(64 - FILTER_BITS)).astype(np.int64)] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``keys`` of those that are held, and their numbers."""
        at = np.flatnonzero(self.bits[(keys >> U(64 - FILTER_BITS)).astype(np.int64)])
        number = np.searchsorted(self.keys, keys[at])
        number[number == len(self.keys)] = 0
        same = self.keys[number] == keys[at] if len(self.keys) else np.zeros(len(at), bool)
        return at[same], number[same]


def document_frequencies(docs: DataFrame, lookups: dict[int, Lookup]) -> dict[int, np.ndarray]:
    """For each shingle of the block the number of documents that hold it; the result is as large as the block."""
    sent = docs.sparkSession.sparkContext.broadcast(lookups)

    def run(batches):
        totals = {k: np.zeros(len(x.keys), np.int64) for k, x in sent.value.items()}
        for _, blob, ends in parts(batches):
            words = Words(blob, ends, ALNUM)
            for k, lookup in sent.value.items():
                at, keys = words.shingles(k)
                found, number = lookup.find(keys)
                pairs = np.unique(words.doc[at[found]] * len(lookup.keys) + number)
                totals[k] += np.bincount(pairs % max(len(lookup.keys), 1), minlength=len(lookup.keys))
        for k, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict(
                {"k": np.full(len(some), k, np.int32), "number": some, "n": total[some]}, schema
            )

    schema = pa.schema([("k", pa.int32()), ("number", pa.int64()), ("n", pa.int64())])
    counts = docs.mapInArrow(run, "k int, number bigint, n bigint").groupBy("k", "number").agg(F.sum("n").alias("n"))
    out = {k: np.zeros(len(x.keys), np.int64) for k, x in lookups.items()}
    table = counts.toArrow()
    for k, number, n in zip(*(table[c].to_pylist() for c in ("k", "number", "n"))):
        out[k][number] = n
    return out


class Prefixes:
    """For each size of shingles the prefix shingles and the places in windows that they stand for."""

    def __init__(self, block: Block, lookups: dict[int, Lookup], frequencies: dict[int, np.ndarray]):
        self.block, self.by_size = block, {}
        for k, lookup in lookups.items():
            window, offset, key = block.shingles(k)
            number = np.searchsorted(lookup.keys, key)
            order = np.lexsort((offset, number, frequencies[k][number], window))
            rarest = order[np.flatnonzero(np.diff(window[order], prepend=-1))]
            # A document that holds the window holds this shingle, so a frequency of 0 rules the window out.
            rarest = rarest[frequencies[k][number[rarest]] > 0]
            prefix = Lookup(lookup.keys[number[rarest]])
            place = np.searchsorted(prefix.keys, key[rarest])
            rarest = rarest[np.argsort(place, kind="stable")]
            ends = np.concatenate(([0], np.cumsum(np.bincount(place, minlength=len(prefix.keys)))))
            self.by_size[k] = prefix, ends, window[rarest], offset[rarest]

    def matches(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Start position and window of every occurrence."""
        block, found = self.block, []
        for k, (prefix, ends, window, offset) in self.by_size.items():
            at, keys = words.shingles(k)
            hit, number = prefix.find(keys)
            size = ends[number + 1] - ends[number]
            place = np.repeat(ends[number] - np.cumsum(size) + size, size) + np.arange(size.sum())
            w = window[place]
            position = np.repeat(at[hit], size)
            start, doc = position - offset[place], words.doc[position]
            fits = (start >= words.first[doc]) & (start + block.length[w] <= words.first[doc + 1])
            start, w = start[fits], w[fits]
            for j in range(block.width):
                longer = block.length[w] > j
                place = np.where(longer, start + j, 0)
                same = ~longer | (words.key[place] == block.words[w, j]) if len(w) else np.zeros(0, bool)
                start, w = start[same], w[same]
            found.append((start, w))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _occurrences(docs: DataFrame, prefixes: Prefixes) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(prefixes)

    def run(batches):
        block = sent.value.block
        for batch, blob, ends in parts(batches):
            words = Words(blob, ends, ALNUM)
            start, window = sent.value.matches(words)
            step = np.zeros(len(words.key) + 1, np.int64)
            np.add.at(step, start, 1)
            np.add.at(step, start + block.length[window], -1)
            covered = np.cumsum(step[:-1]) > 0
            previous = np.zeros(len(covered), bool)
            previous[1:] = covered[:-1] & (words.doc[1:] == words.doc[:-1])
            begins = np.flatnonzero(covered & ~previous)
            following = np.zeros(len(covered), bool)
            following[:-1] = covered[1:] & (words.doc[1:] == words.doc[:-1])
            stops = np.flatnonzero(covered & ~following) + 1
            n = len(batch)
            hits, items = [[] for _ in range(n)], [set() for _ in range(n)]
            for a, b in zip(begins.tolist(), stops.tolist()):
                d = int(words.doc[a])
                hits[d].append({"start": a - int(words.first[d]), "end": b - int(words.first[d])})
            pairs = np.unique(words.doc[start] * max(len(block.items), 1) + window)
            for pair in pairs.tolist():
                items[pair // len(block.items)].update(block.items[pair % len(block.items)])
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch.column(3),
                    "doc_id": batch.column(0),
                    "text_key": batch.column(2),
                    "n_words": words.count,
                    "hits": hits,
                    "items": [[block.names[i] for i in sorted(x)] for x in items],
                },
                schema,
            )

    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema(
        [(c, pa.int64()) for c in ("row", "doc_id", "text_key", "n_words")] + [("hits", span), ("items", pa.list_(pa.string()))]
    )
    return docs.mapInArrow(run, SCHEMA)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """For each row ``doc_id``, ``text_key``, ``n_words``, ``hits`` (disjoint word ranges) and ``items`` (found item ids).

    A null or empty text has no words, hits or items; a null id stays null; repeated rows give repeated results; items
    without id, text or words have no windows; other columns are left out. An empty benchmark finds nothing.
    """
    ship(docs.sparkSession)
    windows = stored(benchmark_windows(benchmark, window), "windows")
    n = windows.count()
    blocks = max(1, -(-n // block_windows))
    # Documents keep a row number while several blocks are searched; with one block each row is seen once.
    text_key = F.xxhash64(F.col("text").cast("string")).alias("text_key")
    rows = documents(docs, text_key).withColumn("row", F.monotonically_increasing_id())
    if blocks > 1:
        rows = stored(rows, "decontaminate")
    found = []
    for b in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == b) if blocks > 1 else windows
        block = Block(part.toArrow())
        lookups = {k: Lookup(block.shingles(k)[2]) for k in block.sizes}
        frequencies = document_frequencies(rows, lookups) if lookups else {}
        found.append(_occurrences(rows, Prefixes(block, lookups, frequencies)))
    if blocks == 1:
        return found[0].drop("row")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    merged = every.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("text_key").alias("text_key"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    return merged.select("doc_id", "text_key", "n_words", _united("hits").alias("hits"), "items")


def _united(name: str):
    """Sorted ranges without overlaps."""
    return F.expr(
        f"aggregate({name}, cast(array() as array<struct<start:int,end:int>>), (out, x) -> CASE"
        " WHEN size(out) > 0 AND x.start <= element_at(out, -1).end THEN concat(slice(out, 1, size(out) - 1), array("
        "named_struct('start', element_at(out, -1).start, 'end', greatest(element_at(out, -1).end, x.end))))"
        " ELSE concat(out, array(x)) END)"
    )


def _judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda total, x: total + (x["end"] - x["start"]).cast("bigint"))
    rows = contamination(docs, benchmark).withColumn("n_hit", n_hit)
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contamination by document: a document is contaminated if at least a twentieth of its words is hit."""
    return _judged(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        "contaminated",
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not contaminated.

    Texts without words, null ones too, never are; repeated rows go or stay together. A null id is an id like any other.
    Without items nothing goes.
    """
    gone = stored(_judged(docs, benchmark).where("contaminated").select("doc_id", "text_key").distinct(), "contaminated")
    text_key = F.xxhash64(docs["text"].cast("string"))
    same = docs["doc_id"].cast("bigint").eqNullSafe(gone["doc_id"]) & (text_key == gone["text_key"])
    return docs.join(gone, same, "left_anti")
