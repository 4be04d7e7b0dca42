"""Personal data: fixed patterns, and spans that a character-level tagger adds.

The tagger is a bidirectional LSTM with CRF transitions (``tagger``), trained on labelled windows: spans of the patterns
in a bounded sample of windows, with matches that fail their check as labelled non-spans. Texts are decoded in windows
that overlap by half; each character takes its tag from the window in whose middle half it stands, and spans are put
together over the whole text.

All kinds hold a digit or an at sign, so windows without one cannot hold a span and are not decoded.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrank.llm.common import documents, parts, ship
from eventrank.llm.tagger import PAD, Tagger, codes_of
from eventrank.sources.session import stored

KINDS = ("email", "ip", "card", "phone")
WINDOW = 64
HALF = WINDOW // 2
# Labelled windows of each kind, and of windows without a span, that are learnt from: the first by a hash of the text.
SAMPLE = 240
# Batches of 32 windows that the tagger is trained on.
BATCHES = 300
# Mean marginal probability of the characters of a span that is added, and its least length.
SURE = 0.9
LEAST = 6

# What an added span of each kind must hold at least.
_LEAST = {
    "email": re.compile("[A-Za-z].*@|@.*[A-Za-z]", re.S),
    "ip": re.compile("[0-9]+[^0-9]+[0-9]+[^0-9]+[0-9]+[^0-9]+[0-9]"),
    "card": re.compile("(?:[0-9][^0-9]*){12}"),
    "phone": re.compile("(?:[0-9][^0-9]*){7}"),
}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = np.isin(np.arange(256), list(b"0123456789@"))


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the e-mail pattern, found from their at signs: a match begins where its run of characters begins."""
    out, after, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            after = domain.end()
        else:
            after = max(after, at + 1)
        at = text.find("@", max(after, at + 1))
    return out


def addresses(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Four dotted numbers at a time: those with parts of at most 255, and those that fail."""
    good, bad = [], []
    for chain in _DOTTED.finditer(text):
        if text.count(".", chain.start(), chain.end()) < 3:
            continue
        numbers, at = chain.group().split("."), chain.start()
        for k in range(0, len(numbers), 4):
            four = numbers[k : k + 4]
            end = at + sum(map(len, four)) + len(four) - 1
            if len(four) == 4:
                right = all(len(x.lstrip("0")) < 3 or (len(x.lstrip("0")) == 3 and x.lstrip("0") <= "255") for x in four)
                (good if right else bad).append((at, end))
            at = end + 1
    return good, bad


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(int(x) * 2 - 9 * (x > "4") for x in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def cards(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    good, bad = [], []
    for found in _CARD.finditer(text):
        digits = _digits(found.group()) if found.end() - found.start() >= 13 else ""
        right = 13 <= len(digits) <= 19 and luhn(digits)
        (good if right else bad).append(found.span())
    return good, bad


def phones(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    good, bad = [], []
    for found in _PHONE.finditer(text):
        right = 9 <= len(_digits(found.group())) <= 15
        (good if right else bad).append(found.span())
    return good, bad


def base_spans(text: str) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[int, int]]]:
    """Spans of each kind, and matches that fail their check."""
    ip, no_ip = addresses(text)
    card, no_card = cards(text)
    phone, no_phone = phones(text) if "+" in text else ([], [])
    found = {"email": emails(text), "ip": ip, "card": card, "phone": phone}
    # Digits within a span of another kind also match the card pattern; such a failure says nothing.
    spans = sorted(x for y in found.values() for x in y)
    failed = [x for x in no_ip + no_card + no_phone if x[1] - x[0] >= LEAST and not _touches(x, spans)]
    return found, failed


def _touches(span: tuple[int, int], spans: list[tuple[int, int]]) -> bool:
    return any(a < span[1] and span[0] < b for a, b in spans)


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that hold a digit or an at sign, and the codes of their characters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    hits = np.flatnonzero(((points >= 48) & (points <= 57)) | (points == 64)) // HALF
    starts = np.unique(np.concatenate([hits, np.maximum(hits - 1, 0)])) * HALF
    padded = np.full(len(points) + WINDOW, PAD, np.int32)
    padded[: len(points)] = codes_of(points)
    return starts, padded[starts[:, None] + np.arange(WINDOW)]


def tags_of(found: dict[str, list[tuple[int, int]]], n: int) -> np.ndarray:
    tags = np.zeros(n + WINDOW, np.int8)
    for k, kind in enumerate(KINDS):
        for a, b in found[kind]:
            tags[a] = 2 * k + 1
            tags[a + 1 : b] = 2 * k + 2
    return tags


def added_spans(text: str, starts: np.ndarray, tags: np.ndarray, sure: np.ndarray) -> dict[str, list[tuple[int, int]]]:
    """Spans from decoded windows, each character's tag taken from the window that it stands in the middle of."""
    n = len(text)
    whole, certain = np.zeros(n + 2 * WINDOW, np.int8), np.zeros(n + 2 * WINDOW, np.float32)
    quarter = HALF // 2
    for start, tag, p in zip(starts.tolist(), tags, sure):
        a = 0 if start == 0 else quarter
        whole[start + a : start + WINDOW - quarter] = tag[a : WINDOW - quarter]
        certain[start + a : start + WINDOW - quarter] = p[a : WINDOW - quarter]
    last = starts[-1] + WINDOW if len(starts) else 0
    if last >= n and len(starts):
        whole[last - quarter : last] = tags[-1][WINDOW - quarter :]
        certain[last - quarter : last] = sure[-1][WINDOW - quarter :]
    out: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    at = 0
    places = np.flatnonzero(whole[:n])
    for at in places.tolist():
        kind = (whole[at] - 1) // 2
        if whole[at] % 2 == 0 and at and whole[at - 1] and (whole[at - 1] - 1) // 2 == kind:
            continue
        end = at + 1
        while end < n and whole[end] == 2 * kind + 2:
            end += 1
        if certain[at:end].mean() < SURE:
            continue
        a, b = at, end
        while a < b and not (text[a].isalnum() or text[a] in "+(") or a < b and text[a].isspace():
            a += 1
        while b > a and not text[b - 1].isalnum():
            b -= 1
        if b - a >= LEAST and _LEAST[KINDS[kind]].search(text[a:b]):
            out[KINDS[kind]].append((a, b))
    return out


def _joined(found: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(found[kind]))


def labelled_windows(docs: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray] | None:
    """Codes and tags of a bounded sample of windows of all kinds."""

    def run(batches):
        # Of each label the least hashes; a window that occurs again is the same one.
        held: dict[str, dict[int, tuple]] = {kind: {} for kind in (*KINDS, "none")}
        for batch, blob, ends in parts(batches):
            for text in _with_triggers(batch.column(1), blob, ends):
                found, _ = base_spans(text)
                tags = tags_of(found, len(text))
                starts, codes = windows(text)
                for start, code in zip(starts.tolist(), codes):
                    tag = tags[start : start + WINDOW]
                    first = next((KINDS[(t - 1) // 2] for t in tag.tolist() if t % 2), "none")
                    data = code.tobytes()
                    held[first][int.from_bytes(hashlib.blake2b(data, digest_size=7).digest())] = (data, tag.tobytes())
            for kind, rows in held.items():
                if len(rows) > 2 * sample:
                    held[kind] = dict(heapq.nsmallest(sample, rows.items()))
        for kind, rows in held.items():
            some = heapq.nsmallest(sample, rows.items())
            yield pa.RecordBatch.from_pydict(
                {"kind": [kind] * len(some), "rank": [k for k, _ in some], "codes": [x for _, (x, _) in some], "tags": [x for _, (_, x) in some]},
                schema,
            )

    schema = pa.schema([("kind", pa.string()), ("rank", pa.int64()), ("codes", pa.binary()), ("tags", pa.binary())])
    rows = stored(docs.mapInArrow(run, "kind string, rank bigint, codes binary, tags binary"), "windows")
    codes, tags = [], []
    for kind in (*KINDS, "none"):
        chosen = rows.where(F.col("kind") == kind).dropDuplicates(["rank"]).orderBy("rank").limit(sample).toArrow().sort_by("rank")
        codes += [np.frombuffer(x, np.int32) for x in chosen["codes"].to_pylist()]
        tags += [np.frombuffer(x, np.int8) for x in chosen["tags"].to_pylist()]
    return (np.stack(codes), np.stack(tags)) if codes else None


def _with_triggers(column: pa.Array, blob: np.ndarray, ends: np.ndarray) -> list[str]:
    return column.take(pa.array(_trigger_rows(blob, ends))).to_pylist()


def _trigger_rows(blob: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(_TRIGGER[blob])])
    return np.flatnonzero(total[ends[1:]] > total[ends[:-1]])


def learn(docs: DataFrame) -> Tagger | None:
    sample = labelled_windows(docs)
    if sample is None or not sample[1].any():
        return None
    return Tagger(len(KINDS)).fit(*sample, steps=BATCHES)


def found_in(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """``doc_id``, counts of the base spans of each kind, ``base_sha256`` and ``spans`` (base and added ones) of each row.

    Spans are kind:start:end (code points, end exclusive), by kind and start, comma-joined. Added spans touch no base span
    and no match that failed its check. A null text is empty and has no span; without any span in the whole input nothing
    is learnt or added; a null id stays null; repeated rows are equal; other columns are left out.
    """
    ship(docs.sparkSession)
    rows = documents(docs)
    sent = docs.sparkSession.sparkContext.broadcast(tagger if tagger is not None else learn(rows))
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches):
        for batch, blob, ends in parts(batches):
            n = len(batch)
            out = {f"n_{kind}": np.zeros(n, np.int64) for kind in KINDS}
            digest, spans = [empty] * n, [""] * n
            rows = _trigger_rows(blob, ends)
            texts = batch.column(1).take(pa.array(rows)).to_pylist()
            cut = [windows(text) for text in texts]
            decoded = _decoded(sent.value, [codes for _, codes in cut])
            for row, text, (starts, _), (tags, sure) in zip(rows.tolist(), texts, cut, decoded):
                found, failed = base_spans(text)
                for kind in KINDS:
                    out[f"n_{kind}"][row] = len(found[kind])
                digest[row] = hashlib.sha256(_joined(found).encode()).hexdigest()
                taken = [x for y in found.values() for x in y] + failed
                if tags is not None and tags.any():
                    for kind, more in added_spans(text, starts, tags, sure).items():
                        found[kind] = found[kind] + [x for x in more if not _touches(x, taken)]
                spans[row] = _joined(found)
            columns = {k: pa.array(x) for k, x in out.items()} | {"base_sha256": pa.array(digest), "spans": pa.array(spans)}
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns.values()], names=["doc_id", *columns])

    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    return rows.mapInArrow(run, f"doc_id bigint, {counts}, base_sha256 string, spans string")


def _decoded(tagger: Tagger | None, codes: list[np.ndarray], batch: int = 1024):
    """Tags and probabilities of the windows of each text; equal windows are decoded once."""
    if tagger is None or not codes:
        return [(None, None)] * len(codes)
    every, back = np.unique(np.concatenate(codes), axis=0, return_inverse=True)
    some = [tagger.decode(every[a : a + batch]) for a in range(0, len(every), batch)]
    tags, sure = (np.concatenate([x[k] for x in some])[back.ravel()] for k in (0, 1))
    ends = np.cumsum([len(x) for x in codes])[:-1]
    return list(zip(np.split(tags, ends), np.split(sure, ends)))


def report(docs: DataFrame) -> DataFrame:
    return found_in(docs)
