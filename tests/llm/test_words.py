"""Word arrays against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa

from eventrank.llm.common import slices, text_bytes
from eventrank.llm.minhash import SLOTS, Sets, band_keys, signatures
from eventrank.llm.words import ALNUM, VISIBLE, Words
from tests.llm.data import odd_rows, prose

TEXTS = [row[1] for row in odd_rows()] + [prose(s, 50) for s in range(5)]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_words_are_those_of_the_patterns():
    blob, ends = text_bytes(pa.array(TEXTS))
    for mask, pattern in ((VISIBLE, "[^\x20\x09-\x0d]+"), (ALNUM, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")):
        found = Words(blob, ends, mask)
        for d, text in enumerate(TEXTS):
            want = re.findall(pattern, lower(text or ""))
            a, b = found.first[d], found.first[d + 1]
            got = [bytes(found.blob[s:e]).decode() for s, e in zip(found.start[a:b], found.end[a:b])]
            assert got == want
            assert len(set(found.key[a:b].tolist())) == len(set(want))


def test_hashes_do_not_depend_on_place_or_slice():
    column = pa.array(TEXTS)
    blob, ends = text_bytes(column)
    whole = Words(blob, ends, VISIBLE).key.tolist()
    parts = []
    for a, b in slices(ends, 1000):
        some, to = text_bytes(column.slice(a, b - a))
        parts += Words(some, to, VISIBLE).key.tolist()
    assert whole == parts


def test_sets_are_distinct_shingles():
    blob, ends = text_bytes(pa.array(TEXTS))
    sets = Sets(blob, ends, 3)
    for d, text in enumerate(TEXTS):
        w = re.findall("[^\x20\x09-\x0d]+", lower(text or ""))
        want = {tuple(w[i : i + 3]) for i in range(max(len(w) - 2, 1))} if w else set()
        assert sets.size[d] == len(want)


def test_signatures_estimate_similarity():
    r = random.Random(5)
    pool = [f"w{i}" for i in range(4000)]
    texts = []
    for k in range(60):
        shared, own = 10 + 5 * k, 60
        base = r.sample(pool, shared + 2 * own)
        texts += [" ".join(base[: shared + own]), " ".join(base[:shared] + base[shared + own :])]
    blob, ends = text_bytes(pa.array(texts))
    sets = Sets(blob, ends, 3)
    found = signatures(sets)
    errors = []
    for k in range(60):
        a, b = (set(sets.key[sets.first[d] : sets.first[d + 1]].tolist()) for d in (2 * k, 2 * k + 1))
        true = len(a & b) / len(a | b)
        errors.append((found[2 * k] == found[2 * k + 1]).mean() - true)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.04
    assert (found < np.uint64(SLOTS << 48)).all()
    assert len(set(band_keys(found).ravel().tolist())) > 1000
