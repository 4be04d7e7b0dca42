"""Secret scanning with a random forest that removes false positives, in DataFrame functions and MLlib only.

Every long run of key characters with a digit is a finding. Its features are length, character transitions, coverage by
words of the corpus, the path it comes from and the neighbouring words. The forest learns from labelled findings.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrank.sources.session import stored

MIN_LENGTH = 12
FINDING = f"[A-Za-z0-9_+/=-]{{{MIN_LENGTH},}}"
# Characters before and after a finding that are looked at.
CONTEXT = 60
# Distinct findings of each label that the forest learns from, the first by a hash.
SAMPLE = 20_000
TREES = 40
DEPTH = 6
SEED = 7
IS_SECRET = 0.5
# A word of the corpus occurs in at least so many documents.
KNOWN_WORD = 3
# Forms of keys that well-known services give out, and names under which secrets are written down.
SERVICE_KEYS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35})$"
NAMED = r"(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth|bearer)[a-z_]*[\"']?[ \t]*(:=|=>|[:=])?[ \t]*[\"'`]?$"
_NAME = r"(?i)(token|secret|passw|pwd|api|key|credential|auth|bearer)"
_TRANSITIONS = {
    "letter_digit": "[A-Za-z](?=[0-9])",
    "digit_letter": "[0-9](?=[A-Za-z])",
    "lower_upper": "[a-z](?=[A-Z])",
    "upper_lower": "[A-Z](?=[a-z])",
    "to_other": "[A-Za-z0-9](?=[^A-Za-z0-9])",
    "vowel_pair": "(?i)[aeiou](?=[^aeiou0-9_+/=-])",
}
FEATURES = [
    "length", "digits", "uppers", "lowers", "others", "distinct", "hex", *_TRANSITIONS, "covered", "quoted", "assigned",
    "named", "word_before", "word_after", "path_depth", "path_test", "path_kind",
]


def findings(docs: DataFrame) -> DataFrame:
    """Every finding with its place (code points, end exclusive), what stands around it, and its path."""
    text = F.col("text").cast("string")
    has = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.col("source").cast("string").alias("path"))
    has = has.where(F.col("text").rlike(FINDING))
    has = has.withColumn("found", F.regexp_extract_all("text", F.lit(FINDING), F.lit(0)))
    has = has.withColumn("gaps", F.split("text", FINDING, -1))
    sizes = F.transform("found", lambda x, i: F.length(x) + F.length(F.get("gaps", i + 1)))
    zero = F.struct(F.array(F.length(F.get("gaps", F.lit(0)))).alias("starts"), F.length(F.get("gaps", F.lit(0))).alias("at"))
    starts = F.aggregate(
        sizes,
        zero,
        lambda acc, size: F.struct(F.concat(acc["starts"], F.array(acc["at"] + size)).alias("starts"), (acc["at"] + size).alias("at")),
        lambda acc: acc["starts"],
    )
    has = has.withColumn("starts", starts)
    each = F.transform(
        "found",
        lambda x, i: F.struct(
            F.get("starts", i).alias("start"),
            x.alias("secret"),
            F.right(F.get("gaps", i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get("gaps", i + 1), F.lit(CONTEXT)).alias("after"),
        ),
    )
    rows = has.select("doc_id", "path", F.inline(F.filter(each, lambda x: x["secret"].rlike("[0-9]"))))
    return rows.withColumn("end", F.col("start") + F.length("secret"))


def _covered(found: DataFrame, docs: DataFrame) -> DataFrame:
    """``covered``: the share of a finding's characters in runs of letters that are words of the corpus."""
    runs = F.regexp_extract_all(F.lower("secret"), F.lit("[a-z]{3,}"), F.lit(0))
    parts = found.select("secret").distinct().select("secret", F.explode(runs).alias("word"))
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower(F.col("text").cast("string")), "[^a-z]+"))).alias("word"))
    # Counted before anything is joined: a task passes on each of its words once, however often it occurs.
    known = words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= KNOWN_WORD)
    known = known.join(parts.select("word").distinct(), "word", "left_semi")
    cover = parts.join(known.select("word"), "word").groupBy("secret").agg(F.sum(F.length("word")).alias("letters"))
    return found.join(cover, "secret", "left").withColumn("covered", F.coalesce(F.col("letters") / F.length("secret"), F.lit(0.0))).drop("letters")


def _bucket(word: Column, n: int = 16) -> Column:
    """A word as one of ``n`` numbers; 0 is no word."""
    return F.when(word == "", 0).otherwise(1 + F.pmod(F.xxhash64(F.lower(word)), F.lit(n - 1)))


def with_features(found: DataFrame, docs: DataFrame) -> DataFrame:
    secret, size = F.col("secret"), F.length("secret")
    count = lambda pattern: F.regexp_count(secret, F.lit(pattern))
    columns = {
        "length": size,
        "digits": count("[0-9]") / size,
        "uppers": count("[A-Z]") / size,
        "lowers": count("[a-z]") / size,
        "others": count("[^A-Za-z0-9]") / size,
        "distinct": F.size(F.array_distinct(F.split(secret, ""))) / size,
        "hex": secret.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        **{name: count(pattern) / size for name, pattern in _TRANSITIONS.items()},
        "quoted": F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]"),
        "assigned": F.col("before").rlike("(=|:)[ \t]*[\"'`]?$"),
        "named": F.col("before").rlike(f"{_NAME}[^ \t]*[ \t]*[=:]?[ \t]*[\"'`]?$"),
        "word_before": _bucket(F.regexp_extract("before", "([A-Za-z]+)[^A-Za-z]*$", 1)),
        "word_after": _bucket(F.regexp_extract("after", "^[^A-Za-z]*([A-Za-z]+)", 1)),
        "path_depth": F.regexp_count(F.coalesce("path", F.lit("")), F.lit("[/\\\\]")),
        "path_test": F.coalesce(F.col("path").rlike("(?i)test|example|sample|doc|fixture|mock"), F.lit(False)),
        "path_kind": _bucket(F.coalesce(F.regexp_extract("path", "\\.([A-Za-z0-9]+)$", 1), F.lit(""))),
    }
    rows = _covered(found, docs)
    return rows.select("*", *[x.cast("double").alias(name) for name, x in columns.items()])


def weak_labels(found: DataFrame) -> DataFrame:
    """Labels for want of reviewed ones: a known service's key, or a value that a name of secrets is given, is one."""
    rule = F.col("secret").rlike(SERVICE_KEYS) | (F.col("before").rlike(NAMED) & ~F.col("secret").rlike("^[0-9]+$"))
    return found.withColumn("label", rule.cast("double"))


def _sample(learnt: DataFrame) -> DataFrame:
    """Up to ``SAMPLE`` findings of each label, so that a rare one is there; copies in the same context are one."""
    context = ["secret", "before", "after"]
    distinct = learnt.groupBy("label", *context).agg(F.min(F.struct(*FEATURES)).alias("x"))
    order = [F.xxhash64(*context), *context]
    of = lambda label: distinct.where(F.col("label") == label).orderBy(*order).limit(SAMPLE)
    return of(0.0).unionByName(of(1.0)).select("label", "x.*").coalesce(1)


def scanned(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Every finding with the forest's ``score`` and ``is_secret``.

    ``labels`` (``secret``, ``label`` 0 or 1) are reviewed findings; without them, or where they do not know a finding,
    the rules of ``weak_labels`` label what is learnt from. If all labels are equal, that label is every finding's. A null
    or empty text has no finding; null ids and paths are allowed; repeated rows are scanned each; other columns are left
    out.
    """
    found = stored(weak_labels(with_features(stored(findings(docs), "findings"), docs)), "findings")
    learnt = found
    if labels is not None:
        known = labels.groupBy("secret").agg(F.max(F.col("label").cast("double")).alias("reviewed"))
        learnt = found.join(known, "secret", "left").withColumn("label", F.coalesce("reviewed", "label"))
    sample = stored(_sample(learnt), "labelled")
    kinds = sorted(r["label"] for r in sample.groupBy("label").count().collect())
    if len(kinds) < 2:
        scored = found.withColumn("score", F.lit(kinds[0] if kinds else 0.0))
    else:
        forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
        model = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(sample)
        scored = model.transform(found).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "path", "start", "end", "secret", "score", (F.col("score") >= IS_SECRET).alias("is_secret"))


def report(docs: DataFrame) -> DataFrame:
    return scanned(docs)
