"""Line deduplication by winnowing over line hashes, in DataFrame functions only.

Every ``GRAM`` consecutive lines have a hash. Of each ``WINDOW`` consecutive hashes the least is a fingerprint (of equal
ones the last), so a repeated run of ``GRAM + WINDOW - 1`` lines always has one in common with its earlier occurrence.
Shorter runs of ``LONG_WORDS`` words and more are fingerprints, too, so that a long passage is found on however few lines.
A fingerprint that occurred before, in an earlier document or above in the same text, fixes two places; the match is
extended both ways as long as lines are equal, and the later run is deleted. What is deleted stands earlier still, so of
every line one occurrence stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventrank.sources.session import stored

GRAM = 2
WINDOW = 2
# A repeated run of so many words is always found, be it a single line.
LONG_WORDS = 50
# Lines that a match is compared with on either side at first, and by how much that grows where all were equal.
REACH = 2
FURTHER = 8
# Columns on the way that no column of a document is likely to be called.
_SPLIT, _STAY = "_lines_of_the_text", "_lines_that_stay"
# Stands for a null id: its rows come last.
LAST_ID = (1 << 63) - 1


def _key(text: Column) -> Column:
    """The first 60 bits of the text's MD5 digest."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _text_key(text: Column) -> Column:
    return F.xxhash64(text)


def _n_words(line: Column) -> Column:
    return F.regexp_count(line, F.lit("[^\\x20\\x09-\\x0D]+"))


def line_table(docs: DataFrame, counted: bool = True) -> DataFrame:
    """``doc``, ``text_key`` and the visible lines (``at`` line number, ``key``, ``words`` if counted) of each distinct row."""
    text = F.col("text").cast("string")
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("at"), F.btrim(x, F.lit(" \t\r")).alias("line")))
    lines = F.transform(
        F.filter(lines, lambda x: x["line"] != ""),
        lambda x: F.struct(x["at"], _key(x["line"]).alias("key"), (_n_words(x["line"]) if counted else F.lit(0)).alias("words")),
    )
    rows = docs.where("text IS NOT NULL").select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("doc"), _text_key(text).alias("text_key"), lines.alias("lines")
    )
    return rows.groupBy("doc", "text_key").agg(F.first("lines").alias("lines"))


def _gram_key(at: Column, gram: int) -> Column:
    """The hash of the ``gram`` lines from place ``at`` on."""
    return _key(F.concat_ws(",", *[F.get("lines", at + j)["key"].cast("string") for j in range(gram)]))


def _long_grams(gram: int, words: int) -> Column:
    """Hashes and places of all runs of ``gram`` lines that have at least ``words`` words."""
    total = lambda i: sum((F.get("lines", i + j)["words"] for j in range(1, gram)), F.get("lines", i)["words"])
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.size("lines") - gram, F.lit(0))), lambda i: total(i) >= words)
    return F.transform(places, lambda i: F.struct(_gram_key(i, gram).alias("print"), (-i).alias("back")))


def fingerprints(lines: DataFrame, gram: int = GRAM, window: int = WINDOW, words: int | None = LONG_WORDS) -> DataFrame:
    """``doc``, ``text_key``, ``pos``, ``print`` and ``before``: the last place of the same print above, if there is one.

    Without ``words`` there are winnowed prints only.
    """
    n = F.size("lines")
    hashes = F.transform(F.sequence(F.lit(0), n - gram), lambda i: _gram_key(i, gram))
    rows = lines.select("doc", "text_key", "lines", F.when(n >= gram, hashes).alias("hashes"))
    windows = F.sequence(F.lit(0), F.greatest(F.size("hashes") - window, F.lit(0)))
    least = F.transform(
        windows,
        lambda i: F.array_min(
            F.transform(F.slice("hashes", i + 1, window), lambda x, j: F.struct(x.alias("print"), (-(i + j)).alias("back")))
        ),
    )
    none = F.array().cast("array<struct<print:bigint,back:int>>")
    chosen = [F.when(F.col("hashes").isNotNull(), least).otherwise(none)]
    if words is not None:
        # Runs of more lines have a winnowed print.
        chosen += [_long_grams(k, words) for k in range(1, gram + window - 1)]
    rows = rows.select("doc", "text_key", F.sort_array(F.concat(*chosen)).alias("sorted"))
    once = F.filter("sorted", lambda x, i: (i == 0) | (F.get("sorted", i - 1) != x))
    rows = rows.select("doc", "text_key", once.alias("chosen"))
    # In ascending order of print and descending order of place, the next one is the same print's last place above.
    above = F.transform(
        "chosen",
        lambda x, i: F.struct(
            x["print"].alias("print"),
            (-x["back"]).alias("pos"),
            F.when(F.get("chosen", i + 1)["print"] == x["print"], -F.get("chosen", i + 1)["back"]).alias("before"),
        ),
    )
    return rows.select("doc", "text_key", F.inline(above))


def matches(prints: DataFrame) -> DataFrame:
    """Places (``doc``, ``text_key``, ``pos``) and the earlier places that they repeat, ``shift`` lines apart."""
    own = prints.where("before IS NOT NULL").select(
        "doc", "text_key", "pos", F.col("doc").alias("doc0"), F.col("text_key").alias("key0"), (F.col("pos") - F.col("before")).alias("shift")
    )
    fresh = prints.where("before IS NULL")
    first = fresh.groupBy("print").agg(F.min(F.struct("doc", "text_key", "pos")).alias("first"), F.count("*").alias("n"))
    # Stored, so that both sides of the join are dealt out for it and the rows of a very common print can be split.
    first = stored(first.where("n > 1").select("print", "first"), "first")
    later = fresh.join(first, "print").where("(doc, text_key) <> (first.doc, first.text_key)")
    return own.unionByName(
        later.select(
            "doc", "text_key", "pos", F.col("first.doc").alias("doc0"), F.col("first.text_key").alias("key0"),
            (F.col("pos") - F.col("first.pos")).alias("shift"),
        )
    )


_DIAGONAL = ["doc", "text_key", "doc0", "key0", "shift"]


def _united(segments: DataFrame) -> DataFrame:
    """Segments of lines ``a`` to ``z`` that overlap or adjoin on a diagonal become one. An end stays open if no segment
    that ends there knows that it is one."""
    along = Window.partitionBy(*_DIAGONAL).orderBy("a", "z")
    before = F.max("z").over(along.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (before.isNull() | (F.col("a") > before + 1)).cast("int")
    numbered = segments.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(along))
    first, last = F.min(F.struct("a", "left_open")), F.max(F.struct("z", "right_done"))
    rows = numbered.groupBy(*_DIAGONAL, "island").agg(first.alias("first"), last.alias("last"))
    return rows.select(*_DIAGONAL, "first.*", "last.*")


def _extended(segments: DataFrame, each: DataFrame, reach: int) -> DataFrame:
    """Open ends moved on by up to ``reach`` lines that are equal at both places; ends that meet a difference are done."""
    sides = F.array(
        F.when(F.col("left_open"), F.struct(F.col("a").alias("edge"), F.lit(-1).alias("step"))),
        F.when(~F.col("right_done"), F.struct(F.col("z").alias("edge"), F.lit(1).alias("step"))),
    )
    ends = segments.select(*_DIAGONAL, "a", "z", F.explode(F.array_compact(sides)).alias("end"))
    ahead = ends.select(*_DIAGONAL, "a", "z", "end.*", F.explode(F.sequence(F.lit(0), F.lit(reach))).alias("far"))
    ahead = ahead.withColumn("pos", F.col("edge") + F.col("step") * F.col("far")).withColumn("pos0", F.col("pos") - F.col("shift"))
    own = each.select("doc", "text_key", "pos", "key")
    earlier = each.select(F.col("doc").alias("doc0"), F.col("text_key").alias("key0"), F.col("pos").alias("pos0"), F.col("key").alias("line0"))
    equal = ahead.join(own, ["doc", "text_key", "pos"]).join(earlier, ["doc0", "key0", "pos0"]).where("key = line0")
    # The edge itself is equal; the lines that follow without a gap are those whose distance is their place.
    run = F.size(F.filter(F.array_sort(F.collect_list("far")), lambda x, i: x == i)) - 1
    moved = equal.groupBy(*_DIAGONAL, "a", "z", "step").agg(run.alias("run"))
    by_side = moved.groupBy(*_DIAGONAL, "a", "z").agg(
        F.max(F.when(F.col("step") < 0, F.col("run"))).alias("left"), F.max(F.when(F.col("step") > 0, F.col("run"))).alias("right")
    )
    new_a, new_z = F.col("a") - F.coalesce("left", F.lit(0)), F.col("z") + F.coalesce("right", F.lit(0))
    return by_side.select(
        *_DIAGONAL, new_a.alias("a"), new_z.alias("z"), F.coalesce(F.col("left") == reach, F.lit(False)).alias("left_open"),
        F.coalesce(F.col("right") < reach, F.lit(True)).alias("right_done"),
    )


def repeated_runs(lines: DataFrame, gram: int = GRAM, window: int = WINDOW, words: int | None = LONG_WORDS) -> DataFrame:
    """Runs of line numbers (``start`` to ``end``, inclusive) of each row that repeat earlier lines.

    Matches grow outwards from their places by lines that are equal at both: a few at first, then ever more where all of
    them were, until every end has met a difference. What grows together on a diagonal (two texts, so many lines apart)
    is one run, so the work is that of the matches and of the runs they are in.
    """
    found = stored(matches(fingerprints(lines, gram, window, words)), "matches")
    each = lines.select("doc", "text_key", F.posexplode("lines").alias("pos", "line"))
    each = stored(each.select("doc", "text_key", "pos", "line.at", "line.key"), "each")
    segments = found.select(*_DIAGONAL, F.col("pos").alias("a"), F.col("pos").alias("z")).distinct()
    segments = segments.withColumns({"left_open": F.lit(True), "right_done": F.lit(False)})
    reach, done = REACH, []
    while True:
        segments = stored(_united(_extended(segments, each, reach)), "segments")
        is_open = F.col("left_open") | ~F.col("right_done")
        done.append(segments.where(~is_open))
        segments = segments.where(is_open)
        if segments.isEmpty():
            break
        reach *= FURTHER
    places = reduce(DataFrame.unionByName, done).select("doc", "text_key", "a", "z").distinct()
    at = each.select("doc", "text_key", F.col("pos").alias("p"), "at")
    ends = places.select("*", F.explode(F.array("a", "z")).alias("p")).join(at, ["doc", "text_key", "p"])
    runs = ends.groupBy("doc", "text_key", "a", "z").agg(F.min("at").alias("start"), F.max("at").alias("end"))
    return runs.select("doc", "text_key", "start", "end")


def deduplicated(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, words: int | None = LONG_WORDS) -> DataFrame:
    """``docs`` with all columns; ``text`` without repeated runs, ``n_lines`` and ``removed`` (runs of line numbers).

    Lines end at \\n and are compared without surrounding blanks; blank lines have no hash and go if they stand inside a
    deleted run. Documents are ordered by id, then by a hash of the text; a null id comes last. Repeated rows (equal id
    and text) are one document and have the same result. A null text stays null, with no line; an empty one has one. Input
    columns called ``n_lines`` or ``removed`` are replaced. Repeated runs of ``gram + window - 1`` lines, and those of
    ``words`` words on fewer lines, are always found; others may be.
    """
    lines = stored(line_table(docs, words is not None), "lines")
    runs = repeated_runs(lines, gram, window, words).groupBy("doc", "text_key")
    runs = runs.agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed"))
    text = docs["text"].cast("string")
    rows = docs.drop("n_lines", "removed")
    same = (F.coalesce(docs["doc_id"].cast("bigint"), F.lit(LAST_ID)) == runs["doc"]) & (_text_key(text) == runs["text_key"])
    # Line numbers that stay, by a set of those that go: the work is that of the lines and of the runs.
    split = F.split(text, "\n")
    gone = F.flatten(F.transform(runs["removed"], lambda r: F.sequence(r["start"], r["end"])))
    stay = F.when(runs["removed"].isNotNull(), F.array_except(F.sequence(F.lit(0), F.size(split) - 1), gone))
    none = F.array().cast("array<struct<start:int,end:int>>")
    out = docs.join(runs, same, "left").select(
        *[docs[c] for c in rows.columns], F.when(text.isNull(), 0).otherwise(F.size(split)).alias("n_lines"),
        F.coalesce(runs["removed"], none).alias("removed"), F.when(stay.isNotNull(), split).alias(_SPLIT), stay.alias(_STAY),
    )
    kept = F.array_join(F.transform(_STAY, lambda i: F.get(_SPLIT, i)), "\n")
    return out.withColumn("text", F.coalesce(kept, F.col("text").cast("string"))).drop(_SPLIT, _STAY)


def report(docs: DataFrame) -> DataFrame:
    """Kept text, number of lines, and removed runs (first-last line, comma-joined) of every document."""
    run = lambda r: F.concat_ws("-", r["start"].cast("string"), r["end"].cast("string"))
    rows = deduplicated(docs.select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", F.array_join(F.transform("removed", run), ",").alias("removed"), "text")
