"""Quality rules: fixed limits, and robust multivariate outliers by language and source.

A minimum-covariance-determinant estimate is made for each language and source: starting from medians and median
deviations, each concentration step keeps the share ``SUPPORT`` of rows that are nearest by Mahalanobis distance and
takes their mean and covariance. The steps are sums over all rows; statistics are whole thousandths, so that sums are
exact in any order. Rows of small groups are pooled by language; the rest is judged by an estimate from all rows.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrank.llm.common import documents, parts, ship
from eventrank.llm.words import VISIBLE, Words, joined, range_hashes, ranges
from eventrank.sources.session import stored

MIN_WORDS = 50
# At most this share of words, in hundredths, may stand in repeated windows of three.
MAX_REPEATED = 50
SUPPORT = 0.6
STEPS = 6
# Rows of a group that has an estimate of its own.
MIN_ROWS = 200
QUANTILE = 0.999999
UNIT = 1000
# Rows of a group meet its estimate in so many parts.
SALTS = 64
# Statistics, and the least deviation of each that counts as one unit of distance. Clean texts have no symbols or
# repetition at all, so their covariance alone would be singular.
STATISTICS = {
    "word_length": 0.5,
    "symbols": 0.04,
    "repeated": 0.12,
    "duplicate_lines": 0.2,
    "capitals": 0.08,
    "marks": 0.08,
}
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_CAPITALS = np.isin(np.arange(256), range(65, 91))
_MARKS = np.isin(np.arange(256), list(b".,;:!?"))
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _sums(mask: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[ends[1:]] - total[ends[:-1]]


def measured(blob: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Base counts of whole texts, and the statistics in thousandths."""
    n = len(ends) - 1
    words = Words(blob, ends, VISIBLE, lower=False)
    visible = VISIBLE[blob]
    start, end = ranges(blob != 10, ends)
    seen = np.concatenate([[0], np.cumsum(visible)])
    told = seen[end] > seen[start]
    start, end = start[told], end[told]
    doc = np.searchsorted(ends, start, side="right") - 1
    lines = np.bincount(doc, minlength=n)
    key = joined([doc.astype(np.uint64), range_hashes(blob, start, end)])
    distinct = np.bincount(doc[np.unique(key, return_index=True)[1]], minlength=n)

    at, shingle = words.shingles(3)
    _, which, times = np.unique(
        joined([words.doc[at].astype(np.uint64), shingle]), return_inverse=True, return_counts=True
    )
    again = at[times[which] > 1]
    covered = np.zeros(len(words.key), bool)
    for j in range(3):
        covered[again + j] = True

    out = {
        "n_words": words.count,
        "word_chars": _sums(visible & _FIRST_BYTE[blob], ends),
        "n_symbols": _sums(_SYMBOLS[blob], ends),
        "n_dup_lines": lines - distinct,
        "n_repeat_words": np.bincount(words.doc, weights=covered, minlength=n).astype(np.int64),
    }
    characters = np.maximum(out["word_chars"], 1)
    shares = {
        "word_length": np.minimum(out["word_chars"] / np.maximum(out["n_words"], 1), 30),
        "symbols": np.sqrt(out["n_symbols"] / characters),
        "repeated": np.sqrt(out["n_repeat_words"] / np.maximum(out["n_words"], 1)),
        "duplicate_lines": np.sqrt(out["n_dup_lines"] / np.maximum(lines, 1)),
        "capitals": np.sqrt(_sums(_CAPITALS[blob], ends) / characters),
        "marks": np.sqrt(_sums(_MARKS[blob], ends) / characters),
    }
    return out | {name: np.rint(UNIT * shares[name]).astype(np.int64) for name in STATISTICS}


def measurements(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``source`` and what is measured, for every row; a null text is empty."""
    ship(docs.sparkSession)

    def run(batches):
        for batch, blob, ends in parts(batches):
            found = {name: pa.array(x.astype(np.int64)) for name, x in measured(blob, ends).items()}
            arrays = [batch.column(0), batch.column(2), batch.column(3), *found.values()]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang", "source", *found])

    columns = ", ".join(f"{name} bigint" for name in [*BASE, *STATISTICS])
    rows = documents(docs, *[F.col(c).cast("string").alias(c) for c in ("lang", "source")])
    return rows.mapInArrow(run, f"doc_id bigint, lang string, source string, {columns}")


def _grouped(rows: DataFrame) -> DataFrame:
    """The group whose estimate each row is judged by: language and source, language, or all rows for the ``rest``."""
    counts = rows.groupBy(F.col("lang").alias("lang_"), F.col("source").alias("source_")).agg(F.count("*").alias("n"))
    pooled = counts.where(F.col("n") < MIN_ROWS).groupBy(F.col("lang_").alias("pool_lang")).agg(F.sum("n").alias("pool"))
    kind = F.when(F.col("n") >= MIN_ROWS, 2).when(F.col("pool") >= MIN_ROWS, 1).otherwise(0)
    kinds = counts.join(pooled, F.expr("lang_ <=> pool_lang"), "left").select("lang_", "source_", kind.alias("kind"))
    group = F.struct(
        "kind", F.when(F.col("kind") > 0, F.col("lang")).alias("lang"), F.when(F.col("kind") == 2, F.col("source")).alias("source")
    )
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    kinds = _salted(kinds).withColumnRenamed("salt", "salt_")
    found = dealt.join(kinds, F.expr("lang <=> lang_ AND source <=> source_ AND salt = salt_")).drop("salt_")
    return found.withColumn("group", F.xxhash64(group)).withColumn("rest", F.col("kind") == 0).drop("lang_", "source_", "kind")


def _pools(passed: DataFrame) -> DataFrame:
    """The rows that each group's estimate is made from: its own, and all there are for the rest, if there is one."""
    rest = passed.where("rest").select("group").first()
    if rest is None:
        return passed
    return passed.where("NOT rest").unionByName(passed.withColumn("group", F.lit(rest["group"])))


def _salted(table: DataFrame) -> DataFrame:
    """One copy of each row of a table of groups for each part that the group's rows are dealt over."""
    return table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _start(rows: DataFrame) -> DataFrame:
    """Medians, and inverse squared median deviations on the diagonal. Statistics have few distinct values."""
    names = list(STATISTICS)
    middle = rows.groupBy("group").agg(*[F.median(c).alias(f"m_{c}") for c in names])
    near = rows.join(_salted(middle), ["group", "salt"]).groupBy("group", *[f"m_{c}" for c in names])
    spread = near.agg(F.count("*").alias("n"), *[F.median(F.abs(F.col(c) - F.col(f"m_{c}"))).alias(f"s_{c}") for c in names])
    inverse = []
    for a, i in enumerate(names):
        width = F.greatest(1.4826 * F.col(f"s_{i}"), F.lit(UNIT * STATISTICS[i]))
        inverse += [1 / (width * width) if a == b else F.lit(0.0) for b in range(len(names))]
    return spread.select("group", "n", F.array(*[f"m_{c}" for c in names]).alias("mean"), F.array(*inverse).alias("inverse"))


def _distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance of each row from its group, and its bin on a logarithmic scale."""
    names = list(STATISTICS)
    away = [F.col(c) - F.get("mean", F.lit(i)) for i, c in enumerate(names)]
    terms = [
        (1 if i == j else 2) * F.get("inverse", F.lit(i * len(names) + j)) * F.col(f"away_{i}") * F.col(f"away_{j}")
        for i in range(len(names))
        for j in range(i, len(names))
    ]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    joined_rows = rows.join(_salted(estimates), ["group", "salt"]).select("*", *[x.alias(f"away_{i}") for i, x in enumerate(away)])
    distance = joined_rows.withColumn("distance", total).drop(*[f"away_{i}" for i in range(len(names))])
    return distance.withColumn("bin", F.floor(64 * F.log2(F.greatest("distance", F.lit(0.0)) + F.lit(2.0**-10))).cast("int"))


def _quantile_bins(placed: DataFrame, share: float) -> DataFrame:
    """The least bin of each group up to which at least the share of its rows lies."""
    counts = placed.groupBy("group", "n", "bin").agg(F.count("*").alias("rows"))
    upto = counts.withColumn("upto", F.expr("sum(rows) OVER (PARTITION BY group ORDER BY bin)"))
    return upto.where(F.col("upto") >= share * F.col("n")).groupBy("group").agg(F.min("bin").alias("cut"))


def _concentrated(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step."""
    names = list(STATISTICS)
    placed = _distance(rows, estimates)
    near = placed.join(_salted(_quantile_bins(placed, SUPPORT)), ["group", "salt"]).where("bin <= cut")
    sums = near.groupBy("group", "n").agg(
        F.count("*").alias("kept"),
        *[F.sum(c).alias(f"s_{i}") for i, c in enumerate(names)],
        *[F.sum(F.col(a) * F.col(b)).alias(f"s_{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j],
    )
    return sums.mapInArrow(_inverted, "group bigint, n bigint, mean array<double>, inverse array<double>")


def _inverted(batches):
    names = list(STATISTICS)
    p = len(names)
    least = np.array([UNIT * x for x in STATISTICS.values()]) ** 2
    for batch in batches:
        out = {"group": [], "n": [], "mean": [], "inverse": []}
        for row in batch.to_pylist():
            mean = [row[f"s_{i}"] / row["kept"] for i in range(p)]
            cov = np.zeros((p, p))
            for i in range(p):
                for j in range(i, p):
                    # Whole numbers until the last division: no digits cancel.
                    moment = row["kept"] * row[f"s_{i}_{j}"] - row[f"s_{i}"] * row[f"s_{j}"]
                    cov[i, j] = cov[j, i] = moment / row["kept"] ** 2
            out["group"].append(row["group"])
            out["n"].append(row["n"])
            out["mean"].append(mean)
            out["inverse"].append(np.linalg.inv(cov + np.diag(least)).ravel().tolist())
        yield pa.RecordBatch.from_pydict(out, schema=_ESTIMATES)


_ESTIMATES = pa.schema([("group", pa.int64()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("inverse", pa.list_(pa.float64()))])


def chi_square(p: int, q: float) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty)."""
    return p * (1 - 2 / (9 * p) + NormalDist().inv_cdf(q) * (2 / (9 * p)) ** 0.5) ** 3


def judged(docs: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """For every row the base counts, ``base_failed``, ``distance`` (null if they failed) and ``kept``.

    A null or empty text has no words and fails; a null language or source is a group like others; repeated rows are
    judged alike and count each; other columns are left out. Rows that fail the base rules are no part of the
    estimates. Rows whose language has fewer than ``MIN_ROWS`` outside of larger groups are judged by all rows that pass,
    however few those are.
    """
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rows = stored(measurements(docs).withColumn("base_failed", base_failed), "measurements")
    passed = stored(_grouped(rows.where("NOT base_failed")), "grouped")
    pools = _pools(passed)
    estimates = stored(_start(pools), "estimates")
    for _ in range(STEPS):
        estimates = stored(_concentrated(pools, estimates), "estimates")
    p = len(STATISTICS)
    middle = _quantile_bins(_distance(pools, estimates), 0.5)
    # The nearest part is narrower than the whole; the median distance tells by how much.
    wide = F.greatest(F.pow(F.lit(2.0), (F.col("cut") + 1) / 64) / chi_square(p, 0.5), F.lit(1.0))
    limits = middle.select("group", (wide * chi_square(p, quantile)).alias("limit"))
    told = _distance(passed, estimates).join(_salted(limits), ["group", "salt"]).withColumn("kept", F.col("distance") <= F.col("limit"))
    columns = ["doc_id", "lang", "source", *BASE, "base_failed", "distance", "kept"]
    failed = rows.where("base_failed").withColumn("distance", F.lit(None).cast("double")).withColumn("kept", F.lit(False))
    return told.select(*columns).unionByName(failed.select(*columns))


def report(docs: DataFrame) -> DataFrame:
    return judged(docs).select("doc_id", *BASE, "base_failed", "kept")
