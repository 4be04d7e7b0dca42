"""Operators on vectors and spelling: against brute force, and on odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventrank.llm import annsearch, spelling, vectorcode
from tests.llm import data

VECTORS = "vec_id long, embedding array<double>, label int, node int, cell int, code string, error int, rank int, score string, limit int"


def vectors(spark, rows):
    """Vectors of (id, components, label), with columns whose names clash."""
    return spark.createDataFrame([(i, v, k, 1, 1, "z", 1, 1, "z", 1) for i, v, k in rows], VECTORS)


def clustered(n, width=16, seed=3):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((6, width))
    return [(i, (centres[i % 6] + 0.3 * r.standard_normal(width)).tolist(), i % 3 or None) for i in range(n)]


def odd_vectors(width=16):
    """Nulls in any place, zero and other lengths, equal vectors, repeated rows and ids, a missing id."""
    base = clustered(260, width)
    nan, inf = float("nan"), float("inf")
    odd = [
        (300, None, 1), (400, [], 1), (500, [None] + [1.0] * (width - 1), 1), (600, [nan] + [1.0] * (width - 1), None),
        (700, [inf] * width, 2), (800, [0.0] * width, 2), (None, base[0][1], 1), (900, [1.0, 2.0], None), (901, [1.0, 2.5], None),
        (100, base[100][1], 1), (1000, base[5][1], 9), (1001, base[5][1], 9),
    ]
    return base + odd + [(2000 + i, base[7][1], 4) for i in range(40)]


# Nearest neighbours


def nearest_by_force(rows, k=10):
    kept = {(i, tuple(v)) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, a in kept:
        if q % 100 == 0:
            found = []
            for i, b in kept:
                if i != q and len(a) == len(b):
                    total = 0.0
                    for x, y in zip(a, b):
                        total += (x - y) ** 2
                    found.append((math.sqrt(total), i))
            out[q] = sorted(found)[:k]
    return out


@pytest.mark.parametrize("cells,block", [(8, 4096), (8, 16), (1, 64)])
def test_nearest_equal_brute_force(spark, monkeypatch, cells, block):
    monkeypatch.setattr(annsearch, "BLOCK", block)
    monkeypatch.setattr(annsearch, "SEEN", 2 * block)
    rows = odd_vectors()
    found = {}
    for r in annsearch.nearest(vectors(spark, rows), F.col("vec_id") % 100 == 0, cells=cells).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    want = nearest_by_force(rows)
    assert {q: [(s, i) for _, s, i in sorted(x)] for q, x in found.items()} == {q: x for q, x in want.items() if x}
    assert all([p for p, _, _ in sorted(x)] == list(range(1, len(x) + 1)) for x in found.values())


def test_recall_of_unstructured_vectors(spark):
    r = np.random.default_rng(1)
    rows = [(i, v, 0) for i, v in enumerate(r.standard_normal((3000, 48)).tolist())]
    want = nearest_by_force(rows)
    found = {(x.query_id, x.vec_id) for x in annsearch.report(vectors(spark, rows)).collect()}
    assert sum((q, i) in found for q, x in want.items() for _, i in x) >= 0.99 * 10 * len(want)


def test_bounds_hold_and_spare_comparisons():
    r = np.random.default_rng(2)
    x, q = r.standard_normal((4000, 64)), r.standard_normal(64)
    about, doubt = annsearch.bounds(*annsearch.encoded(x), q)
    exact = ((x - q) ** 2).sum(axis=1)
    assert (np.abs(about - exact) <= doubt).mean() > 0.999
    assert np.corrcoef(about, exact)[0, 1] > 0.7
    limit = np.sort(exact)[10]
    assert (about - doubt <= limit).mean() < 0.6


def test_nearest_of_nothing(spark):
    assert annsearch.report(vectors(spark, [])).collect() == []
    assert annsearch.report(vectors(spark, [(1, [1.0, 2.0], 1)])).collect() == []
    assert annsearch.report(vectors(spark, [(100, [1.0, 2.0], 1)])).collect() == []
    assert annsearch.report(vectors(spark, [(100, [1.0, 2.0], 1), (3, [1.0, 3.0], 1)])).first().asDict() == {
        "query_id": 100, "rank": 1, "vec_id": 3, "score": 1.0,
    }


# Vector codes


def codes_by_force(rows, parts=4, entries=256, rounds=4):
    kept = [(i, v, k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(1024 * x) for x in v] + [0] * (parts * width - len(v)) for _, v, _ in kept]
    cut = [[z[p * width : (p + 1) * width] for p in range(parts)] for z in whole]
    books = [[list(z[p]) for z in cut[:entries]] for p in range(parts)]

    def nearest(z, book):
        return min((sum((a - b) ** 2 for a, b in zip(z, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for z in cut:
                groups.setdefault(nearest(z[p], books[p])[1], []).append(z[p])
            for j, members in groups.items():
                books[p][j] = [sum(c) // len(members) for c in zip(*members)]
    out = []
    for (i, _, k), z in zip(kept, cut):
        found = [nearest(z[p], books[p]) for p in range(parts)]
        out.append([i, k, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found)])
    totals = Counter()
    for _, k, _, d in out:
        totals[k] += d
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i is None, i or 0), c, d, totals[k], sha) for i, k, c, d in out)


@pytest.mark.parametrize("rows", [odd_vectors()[:80], odd_vectors(), [(3, [0.5], 1), (3, [0.5], 1)]])
def test_codes_equal_brute_force(spark, rows):
    found = vectorcode.report(vectors(spark, rows)).collect()
    got = sorted(((r.vec_id is None, r.vec_id or 0), r.code, r.error, r.label_error, r.codebooks_sha256) for r in found)
    assert got == codes_by_force(rows)


def test_pivots_spare_evaluations_and_keep_ties():
    r = np.random.default_rng(5)
    x = r.integers(-40, 40, (3000, 1, 8)) + 900 * r.integers(0, 5, (3000, 1, 1))
    book = vectorcode.start_of(x[:256])
    book.entries[0, 17] = book.entries[0, 3]
    far = book.pivot_distances(x)[:, 0]
    entry_far = vectorcode._distances(book.entries[0], book.pivots[0])
    index, best, made = vectorcode.nearest_entries(x[:, 0], far, book.entries[0], entry_far)
    exact = ((x - book.entries[0][None]) ** 2).sum(axis=2)
    assert (index == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert 17 not in index and made < 0.5 * exact.size


def test_codes_of_nothing_and_of_large_components(spark):
    assert vectorcode.report(vectors(spark, [(1, None, 1)])).collect() == []
    rows = vectorcode.report(vectors(spark, [(1, [1e300, -1e300, 0.0, 1.0], 1), (2, [0.0] * 4, None)])).collect()
    assert {r.error for r in rows} == {0} and len(rows) == 2


# Spelling


def letters(seed, n):
    """Words of few letters, many of them one edit apart, some with repeated or accented letters."""
    r = random.Random(seed)
    base = ["".join(r.choices("abcdeéß", k=r.randint(5, 9))) for _ in range(n)]
    out = list(base)
    for w in base:
        k = r.randrange(len(w))
        out += [w[:k] + w[k + 1 :], w[:k] + r.choice("abÀ") + w[k:], w[:k] + r.choice("xyz") + w[k + 1 :]]
    return out


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_by_force(counts):
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    out, form = {}, {}
    for w in n:
        others = sorted((-n[v], v) for v in n if near(w, v))
        form[w] = others[0][1] if others and -others[0][0] >= 5 * n[w] else None
        out[w] = (form[w], n[w], len(others), n[form[w]] if form[w] else None)
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        f, c, k, m = out[w]
        out[w] = (f, root, c, k, m)
    return out


def words_by_force(docs):
    import re

    counts = Counter()
    for i, text in docs:
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return counts


def by_word(rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.mark.parametrize("block", [20_000, 25])
def test_variants_equal_brute_force(spark, block):
    r = random.Random(8)
    counts = {w: r.choice([5, 6, 25, 30, 125, 700, 4000]) for w in letters(9, 150)} | {"a" * 40_000: 5, "a" * 39_999: 25, "abcdeé": 5}
    words = spark.createDataFrame([(w, n) for w, n in counts.items() if len(w) >= 6], "word string, n bigint")
    assert by_word(spelling.variants(words, block=block).collect()) == variants_by_force(counts)


def test_spelling_of_odd_documents(spark):
    r = random.Random(4)
    pool = letters(1, 40)
    docs = [(row[0], row[1]) for row in data.odd_rows()]
    docs += [(100 + k, " ".join(r.choices(pool, [40 if k % 4 == 0 else 1 for k in range(len(pool))], k=120)).title() + "·ÉCOLE×2 naïveté-été") for k in range(60)]
    docs += docs[-3:]
    found = by_word(spelling.report(data.frame(spark, docs)).collect())
    assert found == variants_by_force(words_by_force(docs))
    assert any(f for f, *_ in found.values())


def test_runs_lose_a_letter(spark):
    docs = [(i, "letters " * 6) for i in range(1500)]
    counts = words_by_force(docs)
    assert len([w for w in counts if len(w) == 6]) > 1
    found = {r.word: r.n for r in spelling.word_counts(data.frame(spark, docs)).collect()}
    assert found == {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_spelling_of_nothing(spark):
    assert spelling.report(data.frame(spark, [])).collect() == []
    assert spelling.report(data.frame(spark, [(1, None), (2, "")])).collect() == []


def test_chains_of_forms_end_at_the_root(spark):
    chain = [f"w{k}" for k in range(13)]
    rows = spark.createDataFrame(list(pairwise(chain)) + [("x", "w5")], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(rows).collect()} == {w: "w12" for w in chain[:-1]} | {"x": "w12"}
