"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its potential depends on features of the line and of both neighbouring lines, and on the label
of the line before. Forward-backward marginals of "good", weighted by line length, are the score of a document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrank.llm.common import documents, held_out, ship, slices, text_bytes
from eventrank.llm.words import LOWER, VISIBLE, Words, joined, range_hashes, ranges

# Labelled documents of either class that are learnt from; they are the first by a hash of their id.
SAMPLE = 1200
# Longer texts are not learnt from; all texts are scored whole.
SAMPLE_BYTES = 1 << 16
ACCEPTED = 0.7
# Score of a text without any line, and of every text if there is nothing to learn from.
UNKNOWN = 0.5

_CLASSES = {
    "upper": list(range(65, 91)),
    "letter": list(range(65, 91)) + list(range(97, 123)),
    "digit": list(range(48, 58)),
    "symbol": list(b"#*$%&|<>@~^=_{}[]\\/+"),
    "mark": list(b".,;:?'\"()-"),
    "shout": list(b"!"),
    "other": list(range(192, 256)),
    "character": [b for b in range(33, 256) if not 128 <= b < 192],
}
_TABLES = {name: np.isin(np.arange(256), members).astype(np.float32) for name, members in _CLASSES.items()}
OWN = 13


@dataclass
class Lines:
    """Features of the lines of some texts; ``first[d]:first[d + 1]`` are those of text d."""

    features: np.ndarray
    weight: np.ndarray
    first: np.ndarray


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def line_features(blob: np.ndarray, ends: np.ndarray) -> Lines:
    """Lines with a visible character; blank lines have no label."""
    start, end = ranges(blob != 10, ends)
    words = Words(blob, ends, VISIBLE)
    line_of = np.searchsorted(start, words.start, side="right") - 1
    n_words = np.bincount(line_of, minlength=len(start))
    seen = n_words > 0
    start, end, n_words = start[seen], end[seen], n_words[seen]
    line_of = (np.cumsum(seen) - 1)[line_of]
    first = np.searchsorted(start, ends)
    n = len(start)
    if n == 0:
        return Lines(np.zeros((0, 3 * OWN + 3), np.float32), np.zeros(0, np.float32), first)

    count = {name: np.add.reduceat(table[blob], start) for name, table in _TABLES.items()}
    same_line = line_of[1:] == line_of[:-1]
    stutter = np.bincount(line_of[1:][same_line & (words.key[1:] == words.key[:-1])], minlength=n)
    firsts = np.unique(joined([line_of.astype(np.uint64), words.key]), return_index=True)[1]
    distinct = np.bincount(line_of[firsts], minlength=n)
    at, shingle = words.shingles(3)
    _, where, times = np.unique(joined([words.doc[at].astype(np.uint64), shingle]), return_inverse=True, return_counts=True)
    repeated = np.bincount(line_of[at], weights=times[where] > 1, minlength=n)
    shingled = np.bincount(line_of[at], minlength=n)
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(first))
    key = joined([doc.astype(np.uint64), range_hashes(LOWER[blob], start, end)])
    again = np.ones(n)
    again[np.unique(key, return_index=True)[1]] = 0

    characters = count["character"]
    own = np.stack(
        [
            _share(count["upper"], count["letter"]),
            _share(count["digit"], characters),
            np.minimum(5 * _share(count["symbol"], characters), 1),
            _share(count["mark"], characters),
            np.minimum(5 * _share(count["shout"], characters), 1),
            _share(count["other"], characters),
            np.minimum(_share(characters, n_words) / 10, 3),
            _share(distinct, n_words),
            _share(stutter, n_words),
            _share(repeated, shingled),
            again,
            np.log1p(n_words) / 5,
            (_TABLES["mark"][blob[end - 1]] + _TABLES["shout"][blob[end - 1]]) > 0,
        ],
        axis=1,
    ).astype(np.float32)
    position = np.arange(n) - first[doc]
    has_before, has_after = position > 0, position < np.diff(first)[doc] - 1
    before, after = np.roll(own, 1, axis=0) * has_before[:, None], np.roll(own, -1, axis=0) * has_after[:, None]
    edges = np.stack([np.ones(n), has_before, has_after], axis=1).astype(np.float32)
    return Lines(np.concatenate([own, before, after, edges], axis=1), characters, first)


def _step(odds: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Log-odds of the next label, from those of the label before and the transition scores t[before, next]."""
    return np.logaddexp(t[0, 1], odds + t[1, 1]) - np.logaddexp(t[0, 0], odds + t[1, 0])


def messages(emission: np.ndarray, first: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward log-odds, with the line's own potential, and backward log-odds, without it, of all lines."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    active = np.searchsorted(-size[order], -np.arange(size.max(initial=0)), side="left")
    forward, backward = emission.copy(), np.zeros_like(emission)
    for step in range(1, len(active)):
        at = first[order[: active[step]]] + step
        forward[at] += _step(forward[at - 1], t)
    for step in range(1, len(active)):
        at = first[order[: active[step]] + 1] - 1 - step
        backward[at] = _step(backward[at + 1] + emission[at + 1], t.T)
    return forward, backward


@dataclass
class LineModel:
    weights: np.ndarray
    transition: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def emission(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.weights

    def score(self, lines: Lines) -> np.ndarray:
        """Length-weighted mean of the marginals of "good", by document."""
        if not len(lines.features):
            return np.full(len(lines.first) - 1, UNKNOWN)
        forward, backward = messages(self.emission(lines.features), lines.first, self.transition)
        good = 1 / (1 + np.exp(-np.clip(forward + backward, -50, 50)))
        doc = np.repeat(np.arange(len(lines.first) - 1), np.diff(lines.first))
        total = np.bincount(doc, lines.weight, len(lines.first) - 1)
        part = np.bincount(doc, lines.weight * good, len(lines.first) - 1)
        return np.clip(np.where(total > 0, part / np.maximum(total, 1), UNKNOWN), 0, 1)


def fit(lines: Lines, label: np.ndarray, steps: int = 200, rate: float = 0.1, decay: float = 1e-3) -> LineModel:
    """Maximum likelihood of all lines of a document having its label; documents of both classes weigh the same in sum."""
    x = lines.features
    mean, scale = x.mean(0), x.std(0) + 1e-3
    mean[-3], scale[-3] = 0, 1
    x = ((x - mean) / scale).astype(np.float64)
    size, first = np.diff(lines.first), lines.first
    doc = np.repeat(np.arange(len(size)), size)
    y = label[doc].astype(np.float64)
    share = 1 / np.maximum(size * np.bincount(label, minlength=2)[label], 1)
    weight = share[doc]
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    model = LineModel(np.zeros(x.shape[1]), np.zeros((2, 2)), mean, scale)
    state = [np.zeros(x.shape[1] + 4) for _ in range(2)]
    for step in range(1, steps + 1):
        emission = x @ model.weights
        forward, backward = messages(emission, first, model.transition)
        good = 1 / (1 + np.exp(-np.clip(forward + backward, -50, 50)))
        slope = x.T @ (weight * (y - good)) - decay * model.weights
        left, right = forward[pair], emission[pair + 1] + backward[pair + 1]
        joint = np.stack([model.transition[a, b] + a * left + b * right for a in (0, 1) for b in (0, 1)], axis=1)
        joint = np.exp(joint - joint.max(1, keepdims=True))
        joint /= joint.sum(1, keepdims=True)
        observed = np.stack([(y[pair] == a) & (y[pair + 1] == b) for a in (0, 1) for b in (0, 1)], axis=1)
        turn = (weight[pair, None] * (observed - joint)).sum(0) - decay * model.transition.ravel()
        gradient = np.concatenate([slope, turn])
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.999 * state[1] + 0.001 * gradient**2
        move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        model.weights = model.weights + move[:-4]
        model.transition = model.transition + move[-4:].reshape(2, 2)
    return model


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LineModel | None:
    """The model of a bounded sample of labelled documents that are not held out; None without both classes.

    Labels that are null, other than 0 and 1, contradictory or of unknown documents do not count.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    known = known.agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most")
    known = known.where(~held_out(F.col("doc_id")))
    label_of = {}
    for quality in (0, 1):
        first = known.where(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        label_of |= {r["doc_id"]: quality for r in first.select("doc_id").collect()}
    texts = documents(docs).where(F.col("doc_id").isin(list(label_of))) if label_of else documents(docs).limit(0)
    texts = texts.where((F.octet_length("text") > 0) & (F.octet_length("text") <= SAMPLE_BYTES)).dropDuplicates(["doc_id"])
    table = texts.toArrow().sort_by("doc_id").combine_chunks()
    label = np.array([label_of[d] for d in table["doc_id"].to_pylist()], np.int64)
    if len(set(label.tolist())) < 2:
        return None
    lines = line_features(*text_bytes(table["text"].chunk(0)))
    return fit(lines, label)


def scorer(docs: DataFrame, model: LineModel | None):
    """A column function that scores whole texts from 0 to 1; null, empty and blank texts score ``UNKNOWN``."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(text: pa.Array) -> pa.Array:
        if sent.value is None:
            return pa.array(np.full(len(text), UNKNOWN))
        blob, ends = text_bytes(text)
        out = [np.zeros(0)]
        for a, b in slices(ends):
            out.append(sent.value.score(line_features(blob[ends[a] : ends[b]], ends[a : b + 1] - ends[a])))
        return pa.array(np.concatenate(out))

    # Told to be nondeterministic, so that a filter on the score does not compute it a second time.
    return F.arrow_udf(score, "double").asNondeterministic()


def predicted(score: Column) -> Column:
    return (score >= ACCEPTED).cast("int")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction of every row; repeated rows score alike, a null id counts as held out."""
    score = scorer(docs, learn(docs, labels))
    rows = documents(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return rows.withColumn("predicted", predicted(F.col("score")))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose predicted label is 1.

    Null, empty and blank texts score 0.5, as every text does if nothing could be learnt, and are not accepted. Repeated
    rows and texts of equal score are judged alike, each by itself. An empty table stays empty.
    """
    score = scorer(docs, learn(docs, labels))
    return docs.where(score(F.col("text").cast("string")) >= ACCEPTED)
