"""Substring deduplication by hashing units of lines.

Lines are cut into sentences, so that a passage is found wherever in a line it was put. Units are normalised (lower case
A-Z, white space collapsed) and grouped by digest over all documents; the earliest occurrence is kept. Later occurrences
that follow each other form a passage; a passage of at least ``MIN_WORDS`` words is removed. Original offsets are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrank.llm.common import documents, parts, ship
from eventrank.llm.words import STEP, U, VISIBLE, Words, mixed
from eventrank.sources.session import stored

MIN_WORDS = 25
# Stands for a null id: its rows come last.
LAST_ID = (1 << 63) - 1
_ENDS_SENTENCE = np.isin(np.arange(256), list(b".!?"))
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80
_SALTS = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _sequence_hashes(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each range of words, from sums of powers; the order of words counts."""
    out = []
    for salt in _SALTS:
        n = len(key) + 1
        power = np.full(n, salt, U)
        inverse = np.full(n, pow(salt, -1, 1 << 64), U)
        power[0] = inverse[0] = 1
        power, inverse = np.cumprod(power, dtype=U), np.cumprod(inverse, dtype=U)
        sums = np.concatenate([np.zeros(1, U), np.cumsum(mixed(key ^ U(salt)) * power[:-1], dtype=U)])
        out.append(mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U) * STEP))
    return out


def units_of(blob: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Units with a word: text, number in the text, start and end in code points, words, two digests."""
    words = Words(blob, ends, VISIBLE)
    after_mark = np.zeros(len(blob), bool)
    after_mark[1:] = _ENDS_SENTENCE[blob[:-1]]
    after_mark[ends[:-1][ends[:-1] < len(blob)]] = False
    cut = (blob == 10) | ((blob == 32) & after_mark)
    unit_of_byte = np.cumsum(cut)
    # A unit never reaches over the border of a text: the text's number is part of what tells units apart.
    unit = unit_of_byte[words.start] if len(words.start) else np.zeros(0, np.int64)
    new = np.ones(len(unit), bool)
    new[1:] = (unit[1:] != unit[:-1]) | (words.doc[1:] != words.doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first, len(unit))[1:]
    doc = words.doc[first]
    points = np.concatenate([[0], np.cumsum(_FIRST_BYTE[blob])])
    base = points[ends[doc]]
    number = np.arange(len(first)) - np.searchsorted(doc, np.arange(len(ends) - 1))[doc]
    d1, d2 = _sequence_hashes(words.key, first, last)
    return {
        "doc": doc,
        "unit": number,
        "start": points[words.start[first]] - base,
        "end": points[words.end[last - 1]] - base,
        "n_words": last - first,
        "d1": d1.view(np.int64),
        "d2": d2.view(np.int64),
    }


def units(docs: DataFrame) -> DataFrame:
    """One row for each unit: ``doc_id`` (not null), ``text_key``, ``unit``, ``start``, ``end``, ``n_words``, ``d1``, ``d2``."""
    ship(docs.sparkSession)

    def run(batches):
        for batch, blob, ends in parts(batches):
            found = units_of(blob, ends)
            doc = pa.array(found.pop("doc"))
            arrays = [batch.column(0).take(doc), batch.column(2).take(doc)]
            arrays += [pa.array(x.astype(np.int64)) for x in found.values()]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_key", *found])

    rows = documents(docs, F.xxhash64(F.col("text").cast("string")).alias("text_key"))
    rows = rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(LAST_ID)))
    columns = "doc_id text_key unit start end n_words d1 d2".split()
    return rows.mapInArrow(run, ", ".join(f"{c} bigint" for c in columns))


def passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Passages to remove: ``doc_id``, ``text_key``, ``start`` and ``end`` (code points), ``n_units``, ``n_words``,
    ``first_doc_id`` (where the passage's first unit stands earliest).

    Units are ranked by document id, hash of the text, and place; a null id ranks last and comes back as null. Rows of
    equal id and text are one document. A null or blank text has no unit. Other columns are left out.
    """
    found = units(docs)
    place = F.struct("doc_id", "text_key", "start")
    first = found.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    # Stored, so that both sides of the join are dealt out for it and a very common unit's rows can be split.
    first = stored(first.where("first <> last").drop("last"), "first")
    later = found.join(first, ["d1", "d2"]).where(place != F.col("first")).drop("d1", "d2")
    # Units that follow each other have numbers that grow with their rank; repeated rows share a rank.
    rank = F.expr("dense_rank() OVER (PARTITION BY doc_id, text_key ORDER BY unit)")
    islands = later.withColumn("island", F.col("unit") - rank).dropDuplicates(["doc_id", "text_key", "unit", "island"])
    runs = islands.groupBy("doc_id", "text_key", "island").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.count("*").alias("n_units"),
        F.sum("n_words").alias("n_words"),
        F.min_by("first.doc_id", "unit").alias("first_doc_id"),
    )
    known = [F.nullif(c, F.lit(LAST_ID)).alias(c) for c in ("doc_id", "first_doc_id")]
    runs = runs.where(F.col("n_words") >= min_words)
    return runs.select(known[0], "text_key", "start", "end", "n_units", "n_words", known[1])


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with all columns; ``text`` without removed passages, and ``kept``: the ranges of the original text
    (code points, end exclusive) that it consists of. Input columns called ``kept`` are replaced. A null text stays null;
    one that is all repetition becomes empty; repeated rows (equal id and text) have the same result."""
    gone = stored(passages(docs, min_words), "passages").groupBy("doc_id", "text_key")
    gone = gone.agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("gone"))
    text = docs["text"].cast("string")
    same = docs["doc_id"].cast("bigint").eqNullSafe(gone["doc_id"]) & (F.xxhash64(text) == gone["text_key"])
    # Between removed ranges; the first begins at 0 and the last ends with the text.
    n = F.size(gone["gone"])
    between = F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.struct(
            F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.get(gone["gone"], i - 1)["end"]).alias("start"),
            F.when(i == n, F.length(text).cast("bigint")).otherwise(F.get(gone["gone"], i)["start"]).alias("end"),
        ),
    )
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.length(text).cast("bigint").alias("end")))
    kept = F.filter(F.when(gone["gone"].isNull(), whole).otherwise(between), lambda r: r["start"] < r["end"])
    joined = F.array_join(F.transform(kept, lambda r: F.substring(text, r["start"].cast("int") + 1, (r["end"] - r["start"]).cast("int"))), "")
    columns = [
        F.when(gone["gone"].isNull(), text).otherwise(joined).alias(c) if c == "text" else docs[c] for c in docs.columns if c != "kept"
    ]
    return docs.join(gone, same, "left").select(*columns, kept.alias("kept"))


def report(docs: DataFrame) -> DataFrame:
    return passages(docs).drop("text_key")
