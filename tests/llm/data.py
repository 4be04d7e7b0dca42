"""Small inputs with all kinds of odd rows."""

from __future__ import annotations

import random

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars int, row int, node int, n_words int, keys string, bands string,"
    " removed string, n_lines int, score double, kept string, label int, gone string, text_key int, unit int, dropped_id int"
)


def words(seed, n, alphabet="abcdefghij"):
    r = random.Random(seed)
    return ["".join(r.choices(alphabet, k=r.randint(3, 7))) for _ in range(n)]


def prose(seed, n):
    """Lines of sentences of made-up words."""
    r, out, line = random.Random(seed), [], []
    text = words(seed, n)
    while text:
        k = min(len(text), r.randint(4, 9))
        line.append(" ".join(text[:k]).capitalize() + ".")
        text = text[k:]
        if r.random() < 0.3:
            out.append(" ".join(line))
            line = []
    return "\n".join([*out, " ".join(line)] if line else out)


def odd_rows():
    """Null ids and texts, empty, blank and very long texts, repeated rows and ties."""
    long = prose(1, 30_000)
    rows = [
        (1, prose(11, 120)),
        (2, None),
        (3, ""),
        (4, " \t\n\r \n"),
        (None, prose(12, 80)),
        (None, None),
        (5, prose(13, 60)),
        (5, prose(13, 60)),
        (6, prose(13, 60)),
        (7, long),
        (8, "é" * 5000 + "\n" + "9" * 5000),
        (9, "One"),
        (10, "漢字 \U0001f600 mixed   text\x00with\x1fodd signs"),
        (11, "a\n" * 400),
        (12, "!!! ??? ... 123"),
        (1 << 62, prose(14, 70)),
    ]
    return [(i, t, "xx" if k % 2 else None, None if k % 3 else "s", 0, *[1] * 3, *["z"] * 3, 1, 0.5, "z", 1, "z", 1, 1, 1) for k, (i, t) in enumerate(rows)]


def frame(spark, rows):
    """Documents of (id, text)."""
    return spark.createDataFrame([(i, t, "xx", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")


def odd(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")
