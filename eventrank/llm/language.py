"""Language identification by cross-parsing entropy.

A suffix automaton of sample text per language tells how far a text goes on as the sample does. Cross-parsing cuts a text
into phrases, each the longest match from where the last one ended. Phrases per character, divided by what other text of
that language needs, say how foreign a text is; the language with the least wins.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventrank.llm.common import documents, held_out, ship, slices, text_bytes

# Learning reads a bounded sample: documents of each language, the first by a hash of their id, each up to this size.
SAMPLE_DOCS = 150
SAMPLE_CHARS = 20_000
# Characters of each automaton, or as many as its language has.
TRAINED_CHARS = 32_768
# All automata together; with more languages each gets less text.
ALL_CHARS = 1 << 20
# Letters with a sign of their own, the most common ones of all languages alike. Any other letter is spelled by DIGITS
# signs of a hash, so that scripts of thousands of letters need no wider tables.
ALPHABET = 60
DIGITS, BASE = 3, 16
# A text is parsed in blocks of so many characters side by side; each border ends a phrase for all languages alike.
BLOCK = 256
UNKNOWN = "und"

_PAD, _GAP, _RARE = 0, 1, 2
_STATE = (1 << 28) - 1


@dataclass
class Automata:
    """One table per language: the entry of a state and a character is the next state's row, and the phrases that end."""

    names: list[str]
    codes: np.ndarray
    edges: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]
    usual: np.ndarray
    width: int

    def tables(self) -> list[np.ndarray]:
        return [_table(*edges, self.width) for edges in self.edges]


def suffix_automaton(text: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Edges (state, character, next state) and the number of states; state 0 is the start."""
    following: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in following[at]:
            following[at][c] = new
            at = link[at]
        if at >= 0:
            target = following[at][c]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                copy = len(following)
                following.append(dict(following[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and following[at].get(c) == target:
                    following[at][c] = copy
                    at = link[at]
                link[target] = link[new] = copy
        last = new
    rows = [(s, c, t) for s, out in enumerate(following) for c, t in out.items()]
    state, char, target = (np.array(x, np.int32) for x in zip(*rows)) if rows else (np.zeros(0, np.int32),) * 3
    return state, char, target, len(following)


def _table(state: np.ndarray, char: np.ndarray, target: np.ndarray, n: int, width: int) -> np.ndarray:
    # Without an edge the phrase ends and the character begins the next one, or is one by itself if it is unknown.
    out = np.full((n, width), 2 << 28, np.int32)
    out[0] = 1 << 28
    first = state == 0
    out[:, char[first]] = (target[first] * width) | (1 << 28)
    out[state, char] = target * width
    out[:, _PAD] = np.arange(n, dtype=np.int32) * width
    return out.ravel()


def in_word(c: str) -> bool:
    """Letters, and the marks that stand with them in many scripts."""
    return unicodedata.category(c)[0] in "LM"


def _spelled(found: np.ndarray, points: np.ndarray, ends: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Each rare letter as ``DIGITS`` signs from ``first`` on, each place with signs of its own."""
    rare = found == _RARE
    size = np.where(rare, DIGITS, 1)
    upto = np.concatenate([[0], np.cumsum(size)])
    out = np.repeat(found, size)
    mixed = points[rare].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(DIGITS):
        digit = (mixed >> np.uint64(40 + 4 * j)) % np.uint64(BASE)
        out[upto[:-1][rare] + j] = first + j * BASE + digit.astype(out.dtype)
    return out, upto[ends]


def coded(texts: list[str | None], codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Signs of lower-cased texts, with runs of other characters than letters as one gap, and n + 1 offsets."""
    lowered = [x.lower() if x else "" for x in texts]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lowered], dtype=np.int64)])
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    found = codes[points]
    again = np.zeros(len(found), bool)
    again[1:] = (found[1:] == _GAP) & (found[:-1] == _GAP)
    again[ends[:-1][ends[:-1] < len(found)]] = False
    kept = np.concatenate([[0], np.cumsum(~again)])
    found, points, ends = found[~again], points[~again], kept[ends]
    first = width - DIGITS * BASE
    # Without signs for digits nothing rare was learnt, and a rare letter is a sign that no language knows.
    return _spelled(found, points, ends, first) if first > int(codes.max()) else (found, ends)


def phrases(found: np.ndarray, ends: np.ndarray, tables: list[np.ndarray], width: int) -> np.ndarray:
    """Number of phrases of each text and language."""
    size = np.diff(ends)
    blocks = -(-size // BLOCK)
    doc = np.repeat(np.arange(len(size)), blocks)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = ends[:-1][doc] + place * BLOCK
    out = np.zeros((len(size), len(tables)), np.int64)
    for a in range(0, len(doc), 4096):
        begin, of = start[a : a + 4096], doc[a : a + 4096]
        left = np.minimum(ends[of + 1] - begin, BLOCK)
        at = begin[:, None] + np.arange(BLOCK)
        chars = np.where(np.arange(BLOCK) < left[:, None], found[np.minimum(at, len(found) - 1)], _PAD)
        chars = np.ascontiguousarray(chars.T).astype(np.int32)
        for k, table in enumerate(tables):
            state, count = np.zeros(len(of), np.int32), np.zeros(len(of), np.int32)
            for row in chars:
                step = table[state + row]
                count += step >> 28
                state = step & _STATE
            np.add.at(out[:, k], of, count + (state > 0))
    return out


def learn(docs: DataFrame) -> Automata | None:
    """Automata of all languages of a bounded sample of documents that are not held out; None without any."""
    rows = documents(docs, F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL")
    rows = rows.where(~held_out(F.col("doc_id")))
    share = F.xxhash64("doc_id", "lang").cast("double") / 2.0**64 + 0.5
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()}
    if not counts:
        return None
    # A few times the wanted number by hash, of which exactly the wanted number is taken.
    limits = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(4.0 * SAMPLE_DOCS / n))])
    chosen = rows.withColumn("share", share).where(F.col("share") < limits[F.col("lang")])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("share", "doc_id"))
    chosen = chosen.withColumn("text", F.left("text", F.lit(SAMPLE_CHARS)))
    sample = chosen.where(F.length("text") > 0).withColumn("place", place).where(F.col("place") <= SAMPLE_DOCS)
    table = sample.select("lang", "place", "text").toArrow()
    texts: dict[str, list[str]] = {}
    for lang, _, text in sorted(zip(*(table[c].to_pylist() for c in ("lang", "place", "text")))):
        texts.setdefault(lang, []).append(text)
    texts = {lang: x for lang, x in texts.items() if any(map(str.isalpha, "".join(x)))}
    return train(texts) if texts else None


def _halves(texts: list[str]) -> tuple[list[str], list[str]]:
    """Every other text; a single text is cut in the middle, as no phrase is usual that is read where it was learnt."""
    if len(texts) > 1:
        return texts[::2], texts[1::2]
    middle = -(-len(texts[0]) // 2)
    return [texts[0][:middle]], [texts[0][middle:] or texts[0]]


def train(texts: dict[str, list[str]]) -> Automata:
    """Half of each language's texts make its automaton, the other half tell how many phrases are usual.

    An automaton of less text than the largest matches less far, and its phrases tell languages apart less well. Phrases
    are about as long as the logarithm of the text, so its usual number is brought down to that of a large one: a poor
    language wins only where it clearly fits, and takes nothing from the others.
    """
    names = sorted(texts)
    counts: Counter[str] = Counter()
    for lang in names:
        own = Counter(c for x in texts[lang] for c in x.lower() if in_word(c))
        total = sum(own.values())
        counts.update({c: n / total for c, n in own.items()})
    alphabet = sorted(c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:ALPHABET])
    codes = np.full(0x110000, _GAP, np.uint8)
    codes[[i for i in range(0x110000) if in_word(chr(i))]] = _RARE
    codes[[ord(c) for c in alphabet]] = np.arange(_RARE + 1, _RARE + 1 + len(alphabet))
    width = _RARE + 1 + len(alphabet) + (DIGITS * BASE if len(counts) > ALPHABET else 0)
    halves = {lang: _halves(texts[lang]) for lang in names}
    trained = {lang: coded(halves[lang][0], codes, width)[0] for lang in names}
    size = max(min(TRAINED_CHARS, ALL_CHARS // len(names)), 1)
    trained = {lang: x[:size] for lang, x in trained.items()}
    largest = max(map(len, trained.values()))
    edges = [suffix_automaton(trained[lang].tolist()) for lang in names]
    found = Automata(names, codes, edges, np.ones(len(names)), width)
    tables = found.tables()
    for k, lang in enumerate(names):
        chars, ends = coded(halves[lang][1], codes, width)
        usual = phrases(chars, ends, [tables[k]], width).sum() / max(len(chars), 1)
        found.usual[k] = usual * np.log(1 + len(trained[lang])) / np.log(1 + largest)
    return found


def predict(texts: list[str | None], automata: Automata, tables: list[np.ndarray]) -> tuple[list[str], np.ndarray]:
    """The language of each text, and by how much of the runner-up's phrases it needs fewer."""
    found, ends = coded(texts, automata.codes, automata.width)
    counts = phrases(found, ends, tables, automata.width) / automata.usual
    best = counts.argmin(axis=1)
    least = counts[np.arange(len(texts)), best]
    counts[np.arange(len(texts)), best] = np.inf
    second = counts.min(axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        score = np.where(second > 0, 1 - least / second, 0.0)
    names = [
        automata.names[b] if x and any(map(str.isalpha, x)) else UNKNOWN for b, x in zip(best.tolist(), texts)
    ]
    known = np.array([x != UNKNOWN or UNKNOWN in automata.names for x in names])
    return names, np.clip(np.where(known, score, 0.0), 0, 1)


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row.

    A null text, one without a letter, and every text if there is nothing to learn from is ``und`` with score 0. Of
    equally good languages the first by name wins, with score 0; with a single learnt language the score is 1. A null id
    counts as held out; repeated rows are predicted alike; other columns are left out.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs))

    def run(batches):
        automata, tables = sent.value, None
        for batch in batches:
            _, ends = text_bytes(batch.column(1))
            for a, b in slices(ends):
                texts = batch.column(1).slice(a, b - a).to_pylist()
                if automata is None:
                    names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                else:
                    tables = tables or automata.tables()
                    names, score = predict(texts, automata, tables)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(names), pa.array(score)],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = documents(docs, held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")
