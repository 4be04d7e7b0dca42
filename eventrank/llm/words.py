"""Words of whole texts as arrays: positions and 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import numpy as np

U = np.uint64
STEP = U(0x9E3779B97F4A7C15)
CHUNK = 1 << 18
_MULTIPLIER = 0xD6E8FEB86659FD93


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_MULTIPLIER, -1, 1 << 64)
    out = []
    for base in (_MULTIPLIER, inverse):
        factors = np.full(n, base, U)
        factors[0] = 1
        out.append(np.cumprod(factors, dtype=U))
    return out[0], out[1]


_POWER, _INVERSE = _powers(CHUNK + 1)
_BYTE = mixed(np.arange(1, 257, dtype=U) * STEP)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
# Words between white space, and words of letters, digits and all that is not ASCII.
VISIBLE = ~SPACES
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def range_hashes(blob: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each byte range; the ranges ascend and do not overlap. Memory is that of ``CHUNK`` bytes or one range."""
    out = np.empty(len(start), U)
    i, n = 0, len(start)
    while i < n:
        j = max(i + 1, int(np.searchsorted(end, start[i] + CHUNK, side="right")))
        base = int(start[i])
        seg = blob[base : int(end[j - 1])]
        power, inverse = (_POWER, _INVERSE) if len(seg) <= CHUNK else _powers(len(seg) + 1)
        sums = np.zeros(len(seg) + 1, U)
        np.cumsum(_BYTE[seg] * power[: len(seg)], out=sums[1:])
        s, e = start[i:j] - base, end[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(U) * STEP
        i = j
    return mixed(out)


def ranges(mask: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at the given positions."""
    edge = np.zeros(len(mask) + 1, bool)
    edge[cuts] = True
    before = np.zeros(len(mask), bool)
    before[1:] = mask[:-1]
    before &= ~edge[:-1]
    start = np.flatnonzero(mask & ~before)
    after = np.zeros(len(mask), bool)
    after[:-1] = mask[1:]
    after &= ~edge[1:]
    return start, np.flatnonzero(mask & ~after) + 1


class Words:
    """The words of some texts. ``first[d]:first[d + 1]`` are the words of text d, ``doc`` the text of each word."""

    def __init__(self, blob: np.ndarray, ends: np.ndarray, is_word: np.ndarray, lower: bool = True):
        self.blob = LOWER[blob] if lower else blob
        self.ends = ends
        self.start, self.end = ranges(is_word[self.blob], ends)
        self.first = np.searchsorted(self.start, ends)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(ends) - 1), self.count)
        self.key = range_hashes(self.blob, self.start, self.end)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Start positions of all k-word shingles within a text, and their hashes."""
        n = len(self.key) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return at, joined([self.key[j : j + n][at] for j in range(k)])


def joined(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of equally long columns of hashes; their order counts."""
    out = np.full(len(columns[0]), len(columns), U)
    for column in columns:
        out = mixed(out * STEP + column)
    return out
