"""Gradients of losses over the rows of events, and scores of trees, on whole columns inside a task.

Rows of an event lie next to each other; ``ends`` holds the n + 1 places at which events begin and the last one ends.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

# Pairs that are compared at once; an event with more is a step of its own.
PAIRS = 1 << 20


def pairwise_pulls(label: np.ndarray, score: np.ndarray, ends: np.ndarray, pairs: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the pairwise loss: each row against all rows of its event with another label."""
    sizes = np.diff(ends)
    upto = np.concatenate([[0], np.cumsum(sizes * sizes)])
    gradient, curvature = np.zeros(len(label)), np.zeros(len(label))
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + pairs, side="right")) - 1)
        low, high = ends[at], ends[to]
        size = np.repeat(sizes[at:to], sizes[at:to])
        own = np.repeat(np.arange(high - low), size)
        place = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
        other = np.repeat(np.repeat(ends[at:to] - low, sizes[at:to]), size) + place
        y, s = label[low:high], score[low:high]
        side = np.sign(y[other] - y[own])
        with np.errstate(over="ignore"):
            p = 1 / (1 + np.exp(side * (s[other] - s[own])))
        gradient[low:high] = np.bincount(own, side * p, high - low)
        curvature[low:high] = np.bincount(own, np.abs(side) * p * (1 - p), high - low)
        at = to
    return gradient, curvature


def squared_pulls(label: np.ndarray, score: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for half the squared error, which looks at each row by itself."""
    return score - label, np.ones(len(label))


def leaf_values(node, columns: Sequence[np.ndarray]):
    """What a tree says of each row. A node is a number, or feature, threshold and the nodes below and above it."""
    if not isinstance(node, tuple):
        return node
    feature, threshold, below, above = node
    return np.where(columns[feature] <= threshold, leaf_values(below, columns), leaf_values(above, columns))


def scores(trees: Sequence, step: float, codes: Sequence[np.ndarray], rows: int) -> np.ndarray:
    """The sum of what ``trees`` say of each row, so that no scores have to be stored."""
    score = np.zeros(rows)
    for tree in trees:
        score += step * leaf_values(tree, codes)
    return score


def pulled_batches(batches: Iterable[pa.RecordBatch], trees: Sequence, step: float, pulls) -> Iterator[pa.RecordBatch]:
    """One row for each row of the events: ``gradient``, ``curvature``, and the columns after the first.

    The first column is the label, the second one luck, the others codes of features; each holds a list per event.
    """
    for batch in batches:
        offsets = batch.column(0).offsets.to_numpy().astype(np.int64)
        ends, columns = offsets - offsets[0], [c.flatten() for c in batch.columns]
        label, _, *codes = [c.to_numpy(zero_copy_only=False) for c in columns]
        found = [pa.array(x) for x in pulls(label, scores(trees, step, codes, len(label)), ends)]
        yield pa.RecordBatch.from_arrays([*found, *columns[1:]], names=["gradient", "curvature", *batch.schema.names[1:]])


def squared_batches(batches: Iterable[pa.RecordBatch], trees: Sequence, step: float) -> Iterator[pa.RecordBatch]:
    """``gradient`` and ``curvature`` of half the squared error, summed over the rows that have equal codes.

    The first column is the number of these rows, the second one the sum of their labels, the others the codes.
    """
    for batch in batches:
        rows, labels, *codes = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        gradient = rows * scores(trees, step, codes, len(rows)) - labels
        found = [pa.array(gradient), pa.array(rows.astype(float))]
        yield pa.RecordBatch.from_arrays([*found, *batch.columns[2:]], names=["gradient", "curvature", *batch.schema.names[2:]])
