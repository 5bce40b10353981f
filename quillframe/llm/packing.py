"""Packing tokenised documents into fixed-length sequences by exact-complement hashing."""

from __future__ import annotations

import json
import os
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import cut_lineage, text_or_empty
from .words import chunks, hash_spans, running_hash

SEQUENCE = 2048
END_ID = 0
# Text tokenised at once; rows at once, where texts are tokenised whole; units encoded in one text.
CHUNK_BYTES = 2_000_000
ROWS_AT_ONCE = 1_000
UNITS_PER_TEXT = 2_000
# How many units a worker remembers (about 50 bytes each), and the bytes of the longest one.
CACHE_UNITS = 1_500_000
CACHE_LENGTH = 48
# Pieces of one length that one task puts in order.
PART_ROWS = 200_000

_WORKER: dict = {}


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """The path of an installed vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


# What units rest on: white space parts words, letters are lowered one by one, and within a word
# runs of letters, single digits and runs of other signs part by themselves.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_SPLIT = {
    "type": "Split",
    "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}
# Classes of bytes. Words that hold an odd one (an apostrophe, the bar of an added token, control
# characters, anything but ASCII and the letters U+00C0 to U+024F) are one unit each.
_BLANK, _LETTER, _SIGN, _DIGIT, _ODD = range(5)
_CLASS = np.full(256, _ODD, np.uint8)
_CLASS[[0x20, 0x09, 0x0A, 0x0D]] = _BLANK
_CLASS[0x21:0x7F] = _SIGN
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _CLASS[0x80:0xC0] = _CLASS[0xC3:0xCA] = _LETTER
_CLASS[[ord("'"), ord("|")]] = _ODD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _stretches(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all stretches, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _units(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with A-Z as a-z where case plays no part, first and last byte of each unit, and which are odd."""
    kind = _CLASS[data]
    begins = np.concatenate([[0], ends[:-1]])
    some = begins < ends  # a text's edge parts units as well
    new = np.ones(len(data) + 1, bool)
    new[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    new[ends] = new[begins] = True
    inside = kind != _BLANK
    first, last = new[:-1] & inside, new[1:] & inside
    low = _LOWER[data]
    # Signs among the letters (U+00D7, U+00F7), one that lowers to two (U+0130), letters from U+0250 on.
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC9))
    a, b = data[lead], data[lead + 1]
    strange = ((a == 0xC3) & ((b == 0x97) | (b == 0xB7))) | ((a == 0xC4) & (b == 0xB0)) | ((a == 0xC9) & (b >= 0x90))
    odd = np.concatenate([np.flatnonzero(kind == _ODD), lead[strange]])
    whole = np.zeros(0, np.int64)
    if len(odd):
        edge = np.zeros(len(data) + 1, bool)
        edge[ends] = edge[begins[some]] = True
        starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
        stops = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]])))
        word = np.unique(np.searchsorted(starts, odd, "right") - 1)
        whole = starts[word]
        own = _stretches(whole, stops[word] + 1 - whole)
        low[own], first[own], last[own] = data[own], False, False
        first[whole], last[stops[word]] = True, True
    starts, stops = np.flatnonzero(first), np.flatnonzero(last)
    strange = np.zeros(len(starts), bool)
    strange[np.searchsorted(starts, whole)] = True
    return low, starts, stops, strange


class _WordEncoder:
    """Encodes texts unit by unit, where the tokenizer parts texts as word_bpe_49k does.

    Such a tokenizer drops white space, never joins over a space and marks the last id of every
    run of letters, digit and run of signs, so a text's ids are those of its units in a row, and
    a unit that was seen need not be encoded again: units are found, looked up by 64-bit hashes
    and replaced by their ids in whole Arrow batches. A longer unit than CACHE_LENGTH bytes is
    encoded wherever it stands. Texts go whole to any other tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a unit
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        parts = json.loads(self.tokenizer.to_str())
        self.by_units = (
            parts["normalizer"] == _NORMALIZER
            and (parts["pre_tokenizer"] or {}).get("pretokenizers", [None])[0] == _SPLIT
            and all("|" in t["content"] and not set(t["content"]) & set(" \t\n\r") for t in parts["added_tokens"])
            and bool(self.last.any())
        )
        self._forget()

    def _forget(self) -> None:
        # Hashes of units, ascending; where the ids of each begin, and how many they are.
        self.keys, self.begins, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, one after the other, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum()), sizes

    def _plain(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units that are not odd, many in one text: each ends at its own last id."""
        found, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(starts), UNITS_PER_TEXT):
            begin, length = starts[at : at + UNITS_PER_TEXT], (stops - starts + 1)[at : at + UNITS_PER_TEXT]
            text = np.full(length.sum() + len(length), 0x20, np.uint8)
            text[_stretches(np.cumsum(length + 1) - length - 1, length)] = data[_stretches(begin, length)]
            ids = np.array(self.tokenizer.encode(text.tobytes().decode(), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(begin) or ends[-1] != len(ids):
                raise ValueError("this tokenizer does not end each unit by an id of its own")
            found.append(ids)
            sizes.append(np.diff(ends, prepend=0))
        return np.concatenate(found), np.concatenate(sizes)

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, odd: np.ndarray) -> None:
        """Encodes these units, each once, and remembers their ids."""
        order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
        words = [data[a : b + 1].tobytes().decode() for a, b in zip(starts[odd].tolist(), stops[odd].tolist())]
        ids, sizes = map(np.concatenate, zip(self._plain(data, starts[~odd], stops[~odd]), self._whole(words)))
        if self.used + len(ids) > len(self.pool):
            pool = np.zeros(2 * (self.used + len(ids)), np.uint32)
            pool[: self.used] = self.pool[: self.used]
            self.pool = pool
        self.pool[self.used : self.used + len(ids)] = ids
        begins = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        keys = np.concatenate([self.keys, keys[order]])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.begins, self.sizes = np.concatenate([self.begins, begins])[order], np.concatenate([self.sizes, sizes])[order]

    def _chunk(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts that end at ``ends``, one after the other, and the first place after each one's."""
        data, starts, stops, odd = _units(data, ends)
        if len(self.keys) > CACHE_UNITS:
            self._forget()
        long = stops - starts >= CACHE_LENGTH
        keys = hash_spans(running_hash(data, fold=False), starts, stops)
        coded = pa.array(keys[~long]).dictionary_encode()
        distinct, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        at = np.zeros(len(distinct), np.int64)
        at[which] = np.flatnonzero(~long)  # any place of each
        if len(self.keys):
            found = self.keys[np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)] == distinct
            at = at[~found]
        else:
            found = np.zeros(len(distinct), bool)
        if len(at):
            self._learn(distinct[~found], data, starts[at], stops[at], odd[at])
        place = np.searchsorted(self.keys, distinct)
        begins, sizes = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        begins[~long], sizes[~long] = self.begins[place][which], self.sizes[place][which]
        pool = self.pool[: self.used]
        if long.any():
            words = [data[a : b + 1].tobytes().decode() for a, b in zip(starts[long].tolist(), stops[long].tolist())]
            ids, sizes[long] = self._whole(words)
            begins[long] = self.used + np.cumsum(sizes[long]) - sizes[long]
            pool = np.concatenate([pool, ids])
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return pool[_stretches(begins, sizes)], upto[np.searchsorted(starts, ends)]

    def chunks(self, texts: pa.Array) -> Iterator[tuple[int, list[memoryview]]]:
        """The first row of a stretch of texts, and each text's ids as little-endian unsigned 32-bit numbers."""
        if not self.by_units:
            for at in range(0, len(texts), ROWS_AT_ONCE):
                ids, sizes = self._whole(texts.slice(at, ROWS_AT_ONCE).fill_null("").to_pylist())
                yield at, self._cut(ids, np.cumsum(sizes))
            return
        for at, _, data, ends in chunks(texts, CHUNK_BYTES):
            yield at, self._cut(*(self._chunk(data, ends) if len(data) else (np.zeros(0, np.uint32), ends)))

    @staticmethod
    def _cut(ids: np.ndarray, ends: np.ndarray) -> list[memoryview]:
        data = memoryview(ids.astype("<u4").tobytes())
        edges = [0, *(4 * ends).tolist()]
        return [data[a:b] for a, b in zip(edges, edges[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers, without the end id."""
        return [bytes(ids) for _, part in self.chunks(pa.array(texts, pa.large_string())) for ids in part]


_PIECES = pa.schema(
    [
        ("id", pa.int64()),
        ("row", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("crc", pa.int64()),
    ]
)


def _cut(path: str, limit: int):
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _WORKER.get("path") != path:
            _WORKER.update(path=path, encoder=_WordEncoder(path))
        encoder = _WORKER["encoder"]
        for batch in batches:
            for at, found in encoder.chunks(batch["text"]):
                part = batch.slice(at, len(found))
                out = []
                for key, row, ids in zip(part["id"].to_pylist(), part["row"].to_pylist(), found):
                    data = bytes(ids) + end
                    for k, b in enumerate(range(0, len(data), 4 * limit)):
                        piece = data[b : b + 4 * limit]
                        out.append((key, row, k, b // 4, len(piece) // 4, zlib.crc32(piece)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PIECES)], schema=_PIECES)

    return run


# ---------------------------------------------------------------- the plan


class _Sums:
    """Which one, two or three lengths add up to a sum: tables addressed by the sum.

    An entry is a combination that was available when it was stored. It is used while its
    lengths still are, and looked for anew after that; sums without combination stay so,
    since counts only fall.
    """

    def __init__(self, count: np.ndarray):
        self.count = count
        self.free = count > 0
        self.free[0] = False
        self.pair: dict[int, tuple[int, int] | None] = {}
        self.triple: dict[int, tuple[int, int, int] | None] = {}

    def enough(self, lengths: tuple[int, ...]) -> bool:
        return all(self.count[x] >= n for x, n in Counter(lengths).items())

    def take(self, lengths, times: int = 1) -> None:
        for x in lengths:
            self.count[x] -= times
            self.free[x] = self.count[x] > 0

    def two(self, total: int) -> tuple[int, int] | None:
        if total in self.pair:
            found = self.pair[total]
            if found is None or self.enough(found):
                return found
        half = (total + 1) // 2
        first = np.arange(total - 1, half - 1, -1)
        first = first[(first < len(self.free)) & (first > 0)]
        both = first[self.free[first] & self.free[total - first]] if len(first) else first
        found = next(((int(a), total - int(a)) for a in both if self.enough((int(a), total - int(a)))), None)
        self.pair[total] = found
        return found

    def three(self, total: int) -> tuple[int, int, int] | None:
        if total in self.triple:
            found = self.triple[total]
            if found is None or self.enough(found):
                return found
        found = None
        for a in np.flatnonzero(self.free[: max(0, total - 1)])[::-1]:
            if 3 * a < total:  # the largest of three is at least a third
                break
            rest = self.two(total - int(a))
            if rest and self.enough((int(a), *rest)):
                found = (int(a), *rest)
                break
        self.triple[total] = found
        return found

    def exact(self, gap: int) -> tuple[int, ...] | None:
        if gap < len(self.free) and self.free[gap]:
            return (gap,)
        return self.two(gap) or self.three(gap)

    def largest(self, most: int) -> int:
        fit = np.flatnonzero(self.free[: most + 1])
        return int(fit[-1]) if len(fit) else 0


def plan_sequences(count: np.ndarray, limit: int = SEQUENCE) -> list[tuple[int, dict[int, int]]]:
    """Sequences as (how many, {length: pieces of it}); ``count[length]`` pieces are given.

    The longest piece left opens a sequence. If one, two or three lengths fill its gap
    exactly, they close it; otherwise the longest piece that fits (best fit) goes in and
    the gap is looked up again. A sequence is repeated while all its lengths last, so every
    entry uses up a length and the plan stays short whatever the counts.
    """
    count = count.astype(np.int64).copy()
    plan, sums = [], _Sums(count)
    while (opening := sums.largest(limit)) > 0:
        before = dict()
        held, gap, add = Counter(), limit, (opening,)
        while add:
            for x in add:
                before.setdefault(x, int(count[x]))
            sums.take(add)
            held.update(add)
            gap -= sum(add)
            if not gap:
                break
            add = sums.exact(gap)
            if add is None:
                best = sums.largest(gap)
                add = (best,) if best else ()
        times = min(before[x] // n for x, n in held.items())
        for x, n in held.items():
            sums.take((x,), n * (times - 1))
        plan.append((times, dict(sorted(held.items(), reverse=True))))
    return plan


def _lookup(plan: list[tuple[int, dict[int, int]]]):
    """Tables from (length, rank among the pieces of that length) to sequence and offset."""
    next_rank: Counter = Counter()
    rows, sequence = [], 0
    for times, held in plan:
        offset = 0
        for length, n in held.items():
            rows.append((length, next_rank[length], sequence, n, offset))
            next_rank[length] += times * n
            offset += length * n
        sequence += times
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 5).T


_RANK_BITS = 48


def pack(
    df: DataFrame,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = SEQUENCE,
) -> DataFrame:
    """One row per piece: where it lies in which sequence of at most ``limit`` tokens.

    A document's ids are the tokenizer's, then END_ID; only documents longer than ``limit``
    are cut, into full pieces and a rest. Returns ``id_col``, piece, start, length,
    ids_crc32, sequence_id and offset. A null text is empty and has one token; a null id
    stays null; rows that repeat an id are documents of their own. An empty table gives an
    empty result; other columns play no part.

    Only the number of pieces of each length (at most ``limit`` numbers) reaches the driver,
    where :func:`plan_sequences` makes the plan; pieces are numbered within their length in
    hash parts side by side, and look up their place by length and number.
    """
    rows = df.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.monotonically_increasing_id().alias("row"),
        text_or_empty(text_col).alias("text"),
    )
    schema = "id long, row long, piece int, start long, length long, crc long"
    pieces = cut_lineage(rows.mapInArrow(_cut(tokenizer or public_tokenizer(), limit), schema))

    count = np.zeros(limit + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most `limit` rows
        count[r["length"]] = r["count"]
    length, first, sequence, each, offset = _lookup(plan_sequences(count, limit))
    key = (length << _RANK_BITS) | first

    @F.pandas_udf("sequence_id long, offset long")
    def place(of: pd.Series, rank: pd.Series) -> pd.DataFrame:
        of, rank = of.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(key, (of << _RANK_BITS) | rank, "right") - 1
        past = rank - first[at]
        return pd.DataFrame({"sequence_id": sequence[at] + past // each[at], "offset": offset[at] + past % each[at] * of})

    parts = max(1, -(-int(count.max()) // PART_ROWS))
    split = pieces.withColumn("part", F.pmod(F.xxhash64("row", "piece"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = split.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("from"))
    within = Window.partitionBy("length", "part").orderBy("id", "row", "piece")
    numbered = split.withColumn("number", F.row_number().over(within)).join(starts, ["length", "part"])
    placed = numbered.withColumn("place", place("length", F.col("from") + F.col("number") - 1))
    return placed.select(
        F.col("id").alias(id_col),
        "piece",
        "start",
        "length",
        F.col("crc").alias("ids_crc32"),
        F.col("place.sequence_id").alias("sequence_id"),
        F.col("place.offset").alias("offset"),
    )
