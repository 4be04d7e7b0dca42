"""Best-fit packing of token sequences, improved by a swap-based local search.

Texts are tokenised and cut once. Pieces are dealt over shards of bounded size; each shard is packed best-fit decreasing
and then improved: documents move, change places one for one or two for one between underfull sequences whenever that
increases the sum of squared fills, until the emptiest sequence is empty. What is left underfull in all shards is packed
again, together, in further rounds.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrank.llm.common import documents, ship, slices, text_bytes
from eventrank.sources.session import stored

CAPACITY = 1024
END_ID = 2
# Pieces that one task packs together.
SHARD = 4000
ROUNDS = 4
# Exchanges of the local search for each piece of a shard, at most.
EXCHANGES = 2
NO_ID = -(1 << 63)
# Sequences filled less than this are packed again together with those of other shards.
WELL_FILLED = 0.98
# Texts of which a worker remembers the ids, about 150 bytes each; beyond it, it starts anew.
REMEMBERED = 1_000_000

# The characters that Unicode calls white space.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# Two of these in a row, or one of the others, need the general way of cutting.
_OTHER_SPACE = [x for x in _SPACE if x not in " \n"] + ["  ", " \n", "\n ", "\n\n"]
# No token reaches over the border of two chunks: the vocabulary's own pattern splits before a space that a visible
# character follows, and around all other white space.
_CHUNK = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint, loose boolean"


# A word of Latin letters, and marks behind it: two tokens' worth of text whatever stands around.
_PLAIN = re.compile("( ?[A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u00ff]+)([.,:;!?#*$%&|]*)")
_MARKS = ".,:;!?#*$%&|"


class _Remembered(dict):
    """Ids by text; a text that is asked for the first time is looked up."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, text: str) -> bytes:
        found = self[text] = self.find(text)
        return found


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes, for a byte-level vocabulary without normalisation.

    Equal chunks have equal ids, so each is split and merged once and remembered, up to a bound. Merging uses the
    vocabulary's model without the library's own small memory, which costs more than it saves for rare words. With
    ``added``, the vocabulary's added tokens are found in texts as the library does; without, they are text like other.
    """

    def __init__(self, vocabulary: str, remembered: int = REMEMBERED, added: bool = False):
        from tokenizers import Tokenizer, models, pre_tokenizers

        tokenizer = Tokenizer.from_str(vocabulary)
        if tokenizer.normalizer is not None or not isinstance(tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel):
            raise ValueError("the vocabulary must be byte-level and without normalisation")
        found = json.loads(vocabulary)
        model = found["model"]
        tokens = (found.get("added_tokens") or []) if added else []
        if any(x[kind] for x in tokens for kind in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens must be found wherever they stand, without what is around them")
        self.added = {x["content"]: struct.pack("<I", x["id"]) for x in tokens}
        # Of those that begin at the same place, the longest.
        self.at_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        self.model = models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0)
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        # How the vocabulary writes the bytes of plain words.
        self.letters = {b: self.split(bytes([b]).decode())[0][0] for b in range(128)}
        for first in (0xC2, 0xC3):
            for last in range(0x80, 0xC0):
                self.letters[first], self.letters[last] = self.split(bytes([first, last]).decode())[0][0]
        self.space = self.letters[32]
        self.remembered = remembered
        self.pieces = _Remembered(self._merged)
        self.chunks = _Remembered(self._ids)
        self.spaced = _Remembered(self._spaced_ids)

    def _merged(self, piece: str) -> bytes:
        ids = [token.id for token in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _ids(self, chunk: str) -> bytes:
        plain = _PLAIN.fullmatch(chunk)
        if plain is None:
            return b"".join([self.pieces[piece] for piece, _ in self.split(chunk)])
        word, marks = plain.groups()
        out = self.pieces[word.encode().decode("latin-1").translate(self.letters)]
        return out + self.pieces[marks] if marks else out

    def _spaced_ids(self, chunk: str) -> bytes:
        """Ids of a space and a chunk."""
        word = chunk.rstrip(_MARKS)
        if not (word.isascii() and word.isalpha()):
            return self._ids(" " + chunk)
        out = self.pieces[self.space + word]
        return out + self.pieces[chunk[len(word) :]] if len(word) < len(chunk) else out

    def _line(self, line: str) -> bytes:
        """A line of words with one space between them."""
        words = line.split(" ")
        return self.chunks[words[0]] + b"".join(map(self.spaced.__getitem__, words[1:]))

    def _whole(self, text: str) -> bytes:
        if not any(map(text.__contains__, self.added)):
            return self._text(text)
        return b"".join([self.added.get(x) or self._text(x) for x in self.at_added.split(text) if x])

    def _text(self, text: str) -> bytes:
        if text[0] in " \n" or text[-1] in " \n" or any(map(text.__contains__, _OTHER_SPACE)):
            return b"".join(map(self.chunks.__getitem__, _CHUNK.findall(text)))
        return self.chunks["\n"].join(map(self._line, text.split("\n")))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.pieces) + len(self.spaced) + len(self.chunks) > self.remembered:
            for memory in (self.pieces, self.spaced, self.chunks):
                memory.clear()
        return [self._whole(x) if x else b"" for x in texts]


_encoders: dict[tuple[int, bool], Encoder] = {}


def _encoder(vocabulary: str, added: bool) -> Encoder:
    key = zlib.crc32(vocabulary.encode()), added
    if key not in _encoders:
        _encoders[key] = Encoder(vocabulary, added=added)
    return _encoders[key]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n ids; only the first may be shorter than the capacity."""
    first = n % capacity or capacity
    if n <= capacity:
        return [(0, n)]
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, added: bool = False
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document; an empty or null text is the end id alone.

    With ``added``, added tokens of the vocabulary have their own ids inside texts, as the library's tokenizer gives them;
    without, they are spelt out, as with its ``encode_special_tokens``.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    ship(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = _encoder(vocabulary.value, added)
        for batch in batches:
            _, ends = text_bytes(batch.column(1))
            for a, b in slices(ends):
                out = {name: [] for name in schema.names}
                ids = batch.column(0).slice(a, b - a).to_pylist()
                for doc_id, data in zip(ids, encoder.encode(batch.column(1).slice(a, b - a).to_pylist())):
                    data += end
                    for k, (start, length) in enumerate(cuts(len(data) // 4, capacity)):
                        checksum = zlib.crc32(data[4 * start : 4 * (start + length)])
                        for name, value in zip(schema.names, (doc_id, k, start, length, checksum)):
                            out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, schema)

    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
    schema = pa.schema(list(kinds.items()))
    return documents(docs).mapInArrow(run, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions, best-fit decreasing. Free room is looked up in a bit set."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fitting = rooms >> lengths[i]
        if fitting:
            room = lengths[i] + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        room -= lengths[i]
        if room:
            by_room.setdefault(room, []).append(b)
            rooms |= 1 << room
    return bins


class _Search:
    """Bins under change: what each underfull bin can give or take, as sums of up to two of its pieces."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.bins, self.lengths, self.capacity = bins, lengths, capacity
        self.fill = np.array([sum(lengths[i] for i in x) for x in bins], np.int64)
        self.options = {b: self._options(b) for b in np.flatnonzero(self.fill < capacity).tolist()}
        self._flatten()

    def _options(self, b: int) -> tuple[np.ndarray, list[tuple[int, ...]]]:
        members = [(), *((i,) for i in self.bins[b]), *combinations(self.bins[b], 2)]
        return np.array([sum(self.lengths[i] for i in x) for x in members], np.int64), members

    def _flatten(self) -> None:
        order = sorted(self.options)
        sizes = [len(self.options[b][0]) for b in order]
        self.sums = np.concatenate([np.zeros(0, np.int64), *(self.options[b][0] for b in order)])
        self.of = np.repeat(np.array(order, np.int64), sizes)
        self.place = np.concatenate([np.zeros(0, np.int64), *(np.arange(n) for n in sizes)])
        counts = [len(x) for b in order for x in self.options[b][1]]
        self.count = np.array(counts, np.int64)

    def exchange(self, a: int) -> bool:
        """The exchange of bin ``a`` with another that increases the sum of squared fills most, if one does."""
        best = (0, None)
        for given in self.options[a][1][1:]:
            gain = sum(self.lengths[i] for i in given) - self.sums
            growth = gain * (self.fill[self.of] - self.fill[a] + gain)
            able = (gain > 0) & (gain <= self.capacity - self.fill[self.of]) & (self.of != a) & (self.count + len(given) < 4)
            k = int(np.argmax(np.where(able, growth, 0))) if len(growth) else 0
            if len(growth) and able[k] and growth[k] > best[0]:
                best = (int(growth[k]), (given, int(self.of[k]), int(self.place[k])))
        if best[1] is None:
            return False
        given, b, place = best[1]
        taken = self.options[b][1][place]
        for bin_, out, into in ((a, given, taken), (b, taken, given)):
            self.bins[bin_] = [i for i in self.bins[bin_] if i not in out] + list(into)
            self.fill[bin_] = sum(self.lengths[i] for i in self.bins[bin_])
            if 0 < self.fill[bin_] < self.capacity:
                self.options[bin_] = self._options(bin_)
            else:
                del self.options[bin_]
        self._flatten()
        return True


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Exchanges between underfull bins, emptiest first, while the sum of squared fills grows; empty bins go.

    The sum is a whole number and grows with each exchange, so the search ends; ``EXCHANGES`` for each piece bounds it.
    """
    search, left = _Search(bins, lengths, capacity), EXCHANGES * len(lengths)
    least, moved = -(-sum(lengths) // capacity), True
    while moved:
        moved = False
        for a in sorted(search.options, key=lambda b: (search.fill[b], b)):
            while left and a in search.options and np.count_nonzero(search.fill) > least and search.exchange(a):
                moved, left = True, left - 1
    return [x for x in search.bins if x]


def _packed(rows: DataFrame, shards: int, number: int, capacity: int) -> DataFrame:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=False, ignore_index=True)
        lengths = frame["length"].tolist()
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        sequence, offset, loose = (np.zeros(len(frame), kind) for kind in (np.int64, np.int64, bool))
        base = (number << 56) + (int(frame["shard"].iloc[0]) << 24)
        for b, members in enumerate(bins):
            at = 0
            for i in members:
                sequence[i], offset[i] = base + b, at
                at += lengths[i]
            loose[members] = shards > 1 and at < WELL_FILLED * capacity
        return frame.drop(columns="shard").assign(sequence_id=sequence, offset=offset, loose=loose)

    shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))
    # A null would turn the ids of its group into floats.
    known = rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("shard", shard)
    packed = known.groupBy("shard").applyInPandas(run, PACKED)
    return packed.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, shard: int = SHARD) -> DataFrame:
    """Every piece with its sequence and its place there; ids are those of the unchanged tokenizer.

    Each row is packed, repeated ones too; a null id stays null, a null text is empty, other columns are left out; no rows
    give no sequences. Ids of full pieces are negative numbers, those of the others count from 2^56.
    """
    cut = stored(pieces(docs, tokenizer_path, capacity, end_id, added=True), "pieces")
    full = cut.where(F.col("length") == capacity)
    out = full.select(
        *cut.columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    rows = cut.where(F.col("length") < capacity)
    n = rows.count()
    for number in range(1, ROUNDS + 1):
        last = number == ROUNDS
        packed = stored(_packed(rows, max(1, -(-n // shard)), number, capacity), "packed")
        again = packed.where("loose")
        left = again.count()
        last = last or left == 0 or left > n // 2
        out = out.unionByName((packed if last else packed.where("NOT loose")).drop("loose"))
        if last:
            return out
        rows, n = again.select(*cut.columns), left
