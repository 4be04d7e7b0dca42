"""SuperMinHash signatures of shingle sets."""

from __future__ import annotations

import numpy as np

from eventrank.llm.words import STEP, U, VISIBLE, Words, joined, mixed

SHINGLE = 3
# Slots of a signature, a prime number; bands of rows use all but the last.
SLOTS = 257
ROWS = 8
BANDS = (SLOTS - 1) // ROWS
_EMPTY = U(0xFFFFFFFFFFFFFFFF)


class Sets:
    """Distinct shingles of some texts. ``first[d]:first[d + 1]`` are those of text d, in ascending order."""

    def __init__(self, blob: np.ndarray, ends: np.ndarray, shingle: int = SHINGLE):
        words = Words(blob, ends, VISIBLE)
        at, key = words.shingles(shingle)
        doc = words.doc[at]
        # A text of fewer words is one shingle of all its words; joined() keeps different lengths apart.
        for k in range(1, shingle):
            short = np.flatnonzero(words.count == k)
            start = words.first[short]
            doc = np.concatenate([doc, short])
            key = np.concatenate([key, joined([words.key[start + j] for j in range(k)])])
        order = np.lexsort((key, doc))
        doc, key = doc[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
        self.doc, self.key = doc[new], key[new]
        self.first = np.searchsorted(self.doc, np.arange(len(ends)))
        self.size = np.diff(self.first)

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit digests of each set."""
        out = []
        for salt in (U(0x5851F42D4C957F2D), U(0x2545F4914F6CDD1D)):
            sums = np.concatenate([np.zeros(1, U), np.cumsum(mixed(self.key ^ salt), dtype=U)])
            out.append(mixed(sums[self.first[1:]] - sums[self.first[:-1]] + self.size.astype(U)))
        return out[0], out[1]


def signatures(sets: Sets, slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` values for each text; two sets agree in a slot with the probability of their similarity.

    In round j every element offers j and a random fraction to one slot, which it never offers to again: its slots are
    an arithmetic progression modulo the prime ``slots``, so an element's ranks are a permutation. A slot keeps the least
    value. Offers of a later round are larger, so a text whose slots are all filled is done.
    """
    n = len(sets.size)
    out = np.full(n * slots, _EMPTY, U)
    doc, key = sets.doc, sets.key
    stride = (mixed(key ^ U(0x9FB21C651E98DF25)) % U(slots - 1)).astype(np.int64) + 1
    slot = (mixed(key ^ U(0xD1342543DE82EF95)) % U(slots)).astype(np.int64)
    for j in range(slots):
        value = (mixed(key + U((j * int(STEP)) & 0xFFFFFFFFFFFFFFFF)) >> U(16)) | (U(j) << U(48))
        np.minimum.at(out, doc * slots + slot, value)
        if j + 1 == slots:
            break
        alive = (out.reshape(n, slots) == _EMPTY).any(axis=1)[doc]
        if not alive.any():
            break
        doc, key, stride, slot = doc[alive], key[alive], stride[alive], slot[alive]
        slot = (slot + stride) % slots
    return out.reshape(n, slots)


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash for each text and band of ``rows`` slots."""
    bands = signature.shape[1] // rows
    keys = [
        joined([signature[:, b * rows + r] for r in range(rows)] + [np.full(len(signature), b, U)]) for b in range(bands)
    ]
    return np.stack(keys, axis=1) if len(signature) else np.zeros((0, bands), U)


def short_slots(signature: np.ndarray) -> np.ndarray:
    """Slots cut to 16 bits, to estimate similarities from."""
    return (mixed(signature) >> U(48)).astype(np.uint16)
