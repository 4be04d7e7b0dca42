"""Spelling variants by a trie of letter-group counts.

Letters are dealt to groups of about equal use. A word's counts by group are its path in a trie. One inserted, deleted or
replaced letter raises one count by one at most and lowers one at most, so a depth-first search that may spend one surplus
and one deficit meets every word that is one edit away; the words of its leaves are compared letter by letter.

The upper levels of the trie (length and the first two groups) deal words to parts. A word visits the parts that its budget
reaches. Parts are cut into blocks of bounded size; a step searches the trie of one block for all words of another.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrank.llm.common import documents, ship
from eventrank.sources.session import stored

LEAST_LENGTH = 6
LEAST_COUNT = 5
# A form is so many times as frequent as the word.
MORE = 5
# One letter of a run is deleted where this number divides its hash.
DELETED = 199
GROUPS = 14
# Words of a block of the trie, and of a block of visitors.
BLOCK = 20_000
# A node of so few words is a leaf.
LEAF = 12
# Letters that a comparison of words holds at once.
STEP_LETTERS = 1 << 22

# Lengths and first two counts that one edit leads to, relative to those of a word: nothing, a letter more, a letter less,
# one replaced. The third group stands for all others.
_PLACES = [(1, 0), (0, 1), (0, 0)]
REACHED = sorted(
    {(0, 0, 0)}
    | {(s, s * a, s * b) for a, b in _PLACES for s in (1, -1)}
    | {(0, a - c, b - d) for a, b in _PLACES for c, d in _PLACES}
)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``: runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased, of whole texts, counted.

    Where ``DELETED`` divides the crc32 of ``doc_id:run`` the run's letter at crc32 % length is deleted. Words of fewer
    than ``LEAST_LENGTH`` letters or ``LEAST_COUNT`` occurrences are left out. A null id deletes nothing.
    """
    runs = F.regexp_extract_all(
        F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}"), 0
    )
    rows = documents(docs).select("doc_id", F.explode(runs).alias("run"))
    h = F.crc32(F.encode(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")), "UTF-8"))
    at = (F.col("h") % F.length("run")).cast("int")
    changed = F.concat(F.left("run", at), F.expr("substring(run, CAST(h % length(run) AS int) + 2)"))
    words = rows.withColumn("h", h).select(F.when(F.col("h") % DELETED == 0, changed).otherwise(F.col("run")).alias("word"))
    words = words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return words.where(F.col("n") >= LEAST_COUNT)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> list[str]:
    """The letters of all words, dealt to groups of about equal use; there are no more of them than letters."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''")
    counts = letters.groupBy("letter").agg(F.count("*").alias("n")).collect()
    out, used = [""] * groups, [0] * groups
    for r in sorted(counts, key=lambda r: (-r["n"], r["letter"])):
        k = used.index(min(used))
        out[k] += r["letter"]
        used[k] += r["n"]
    return out


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, and their lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32), lengths


class Letters:
    """Group of each letter."""

    def __init__(self, groups: list[str]):
        self.n = len(groups)
        self.table = np.zeros(0x110000, np.uint8)
        for k, letters in enumerate(groups):
            self.table[[ord(c) for c in letters]] = k

    def counts(self, words: list[str]) -> np.ndarray:
        points, lengths = _points(words)
        owner = np.repeat(np.arange(len(words)), lengths)
        return np.bincount(owner * self.n + self.table[points], minlength=len(words) * self.n).reshape(len(words), self.n)


def padded(words: list[str], width: int) -> np.ndarray:
    points, lengths = _points(words)
    out = np.zeros((len(words), width), np.uint32)
    out[np.arange(width) < lengths[:, None]] = points
    return out


def one_edit(a: np.ndarray, b: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Rows of letters that differ by exactly one letter; ``longer`` (-1, 0, 1) is by how much a's word is longer than b's.

    Words are padded on the right by zeros to one letter more than b's length.
    """
    same = a == b
    found = (longer == 0) & ((~same).sum(axis=1) == 1)
    # The longer word without the letter at the first difference is the shorter one.
    start = np.where(same.all(axis=1), a.shape[1], same.argmin(axis=1))
    behind = np.arange(a.shape[1] - 1) >= start[:, None]
    for sign, x, y in ((1, a, b), (-1, b, a)):
        of = np.flatnonzero(longer == sign)
        found[of] = (~behind[of] | (x[of][:, 1:] == y[of][:, :-1])).all(axis=1)
    return found


class Trie:
    """Words in the order of their counts; a node is a range of words that agree in the first counts."""

    def __init__(self, words: list[str], n: np.ndarray, letters: Letters):
        counts = letters.counts(words)
        order = np.lexsort(counts.T[::-1])
        self.words = [words[i] for i in order]
        self.counts, self.n = counts[order], n[order]
        self.length = len(words[0])
        # Words in the order of the wanted form: most frequent first, then by code points.
        by = sorted(range(len(words)), key=lambda i: (-int(self.n[i]), self.words[i]))
        self.place = np.empty(len(words), np.int64)
        self.place[by] = np.arange(len(words))
        self.by = by
        self.letters = padded(self.words, self.length + 1)

    def candidates(self, counts: np.ndarray):
        """Pairs (visitor, word) whose counts differ by one surplus and one deficit at most, leaf by leaf."""
        groups = counts.shape[1]
        stack = [(0, len(self.words), 0, np.arange(len(counts)), np.zeros(len(counts), bool), np.zeros(len(counts), bool))]
        while stack:
            lo, hi, level, who, surplus, deficit = stack.pop()
            if hi - lo <= LEAF or level == groups:
                more = self.counts[None, lo:hi, level:] - counts[who, None, level:]
                fits = (np.maximum(more, 0).sum(axis=2) + surplus[:, None] <= 1) & (np.maximum(-more, 0).sum(axis=2) + deficit[:, None] <= 1)
                i, j = np.nonzero(fits)
                if len(i):
                    yield who[i], j + lo
                continue
            column = self.counts[lo:hi, level]
            edges = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), hi - lo]
            for a, b in zip(edges, edges[1:]):
                more = column[a] - counts[who, level]
                go = (more == 0) | ((more == 1) & ~surplus) | ((more == -1) & ~deficit)
                if go.any():
                    stack.append((lo + a, lo + b, level + 1, who[go], surplus[go] | (more[go] == 1), deficit[go] | (more[go] == -1)))

    def near(self, visitors: list[str], letters: Letters) -> tuple[np.ndarray, np.ndarray]:
        """For each visitor: number of words one edit away, and the first of them in the order of the wanted form (or none)."""
        own = padded(visitors, self.length + 1)
        longer = np.array([len(v) for v in visitors]) - self.length
        found = np.zeros(len(visitors), np.int64)
        first = np.full(len(visitors), len(self.words), np.int64)
        step = max(1, STEP_LETTERS // (self.length + 1))
        for who, word in self.candidates(letters.counts(visitors)):
            for a in range(0, len(who), step):
                i, j = who[a : a + step], word[a : a + step]
                ok = one_edit(own[i], self.letters[j], longer[i])
                i, j = i[ok], j[ok]
                found += np.bincount(i, minlength=len(visitors))
                np.minimum.at(first, i, self.place[j])
        return found, first


_PART = ["length", "c0", "c1"]


def near_words(words: DataFrame, block: int = BLOCK, groups: int = GROUPS) -> DataFrame:
    """``word``, ``n_near`` (words one edit away, at least one) and ``best`` (``back`` = -n, ``word``): the most frequent of
    them, of equally frequent ones the first by code points. ``words`` has distinct ``word`` with ``n``."""
    spark = words.sparkSession
    ship(spark)
    dealt = letter_groups(words, groups)
    of = lambda letters: F.length("word") - F.length(F.translate("word", letters, "")) if letters else F.lit(0)
    keyed = words.select("word", "n", F.length("word").alias("length"), of(dealt[0]).alias("c0"), of(dealt[1]).alias("c1"))
    keyed = stored(keyed, "words")
    # Words of each part, and visits to it.
    sizes = keyed.groupBy(*_PART).agg(F.count("*").alias("size"))
    reached = F.explode(F.array(*[F.struct(*[(F.col(c) + F.lit(d)).alias(c) for c, d in zip(_PART, delta)]) for delta in REACHED]))
    visits = sizes.select("size", reached.alias("to")).groupBy(*[F.col(f"to.{c}").alias(c) for c in _PART]).agg(F.sum("size").alias("visits"))
    count = lambda n: F.ceil(F.col(n) / block).cast("int")
    parts = stored(sizes.join(visits, _PART).select(*_PART, count("size").alias("blocks"), count("visits").alias("rounds")), "parts")

    dealt_to = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    tries = keyed.join(parts, _PART).groupBy(*_PART, dealt_to("blocks").alias("block"))
    tries = tries.agg(F.collect_list("word").alias("words"), F.collect_list("n").alias("counts"))
    visitors = keyed.select("word", reached.alias("to")).select("word", "to.*").join(parts, _PART)
    visitors = visitors.groupBy(*_PART, "blocks", dealt_to("rounds").alias("round")).agg(F.collect_list("word").alias("visitors"))
    visitors = visitors.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = tries.join(visitors.drop("blocks", "round"), [*_PART, "block"]).select(*_PART, "block", "words", "counts", "visitors")

    def run(batches):
        letters, trie, of_trie = Letters(dealt), None, None
        for batch in batches:
            for row in range(len(batch)):
                key = tuple(batch.column(c)[row].as_py() for c in range(4))
                if key != of_trie:
                    of_trie, trie = key, Trie(batch.column(4)[row].as_py(), np.asarray(batch.column(5)[row].values), letters)
                asked = batch.column(6)[row].as_py()
                found, first = trie.near(asked, letters)
                some = np.flatnonzero(found).tolist()
                best = [trie.by[first[i]] for i in some]
                yield pa.RecordBatch.from_pydict(
                    {
                        "word": pa.array([asked[i] for i in some], pa.string()),
                        "n_near": pa.array(found[some]),
                        "back": pa.array(-trie.n[best].astype(np.int64)),
                        "near": pa.array([trie.words[i] for i in best], pa.string()),
                    }
                )

    found = pairs.mapInArrow(run, "word string, n_near bigint, back bigint, near string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("back", F.col("near").alias("word"))).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the end of the chain of forms (``word``, ``form``). A form is more frequent by a factor, so
    chains have no cycles and are short; every round doubles the steps taken."""
    ends = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(ends.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "forms")
        ends = step.drop("next")
        if step.where("next IS NOT NULL").isEmpty():
            return ends


def variants(words: DataFrame, more: int = MORE, block: int = BLOCK) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of distinct words (``word``, ``n``).

    Words are near if they differ by one inserted, deleted or replaced code point. The form is the most frequent near
    word (ties: the first by code points) if it is ``more`` times as frequent, else null; the root is where forms lead to.
    """
    near = near_words(words, block)
    rows = words.join(near, "word", "left")
    fits = -F.col("best.back") >= more * F.col("n")
    rows = rows.select(
        "word", F.when(fits, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(fits, -F.col("best.back")).alias("form_n"),
    )
    rows = stored(rows, "variants")
    ends = roots(rows.where("form IS NOT NULL"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame) -> DataFrame:
    """Spelling variants of the words of all documents.

    Null texts have no words; an empty table has no row; repeated rows are counted each; other columns are left out.
    """
    return variants(stored(word_counts(docs), "vocabulary"))
