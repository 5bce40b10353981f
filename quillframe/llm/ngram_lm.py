"""Scoring texts with an interpolated modified Kneser-Ney model that is counted in Spark."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage, scratch_path, text_or_empty
from .warc import _open
from .words import chunks, hash_words, mix

FOLDS, HELD_OUT = 5, 1
# Hashes of the marks before and after a text; no word can be a mark, as words have no space.
START, END = (np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344))
# Tokens that are counted together before they are dealt out, and distinct pairs of a counting task.
BLOCK_TOKENS = 2_000_000
BUCKET_PAIRS = 2_000_000


def tokens(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's words and the end mark, and for every token the one before it."""
    ends = np.cumsum(counts)
    after = np.insert(words, ends, END)
    before = np.empty_like(after)
    before[1:] = after[:-1]
    starts = np.concatenate([[0], (ends + np.arange(1, len(counts) + 1))[:-1]]).astype(np.int64) if len(counts) else np.zeros(0, np.int64)
    before[starts] = START
    return after, before


def pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + word)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(h) % np.uint64(buckets)).astype(np.int64)


def _small(a: np.ndarray) -> bytes:
    """Counts, mostly ones: compressed."""
    raw = np.asarray(a, "<u8").tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True) if raw else b""


def _large(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), "<u8")


def _hashes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")


# ---------------------------------------------------------------- counting

_PAIRS = pa.schema([("bucket", pa.int32()), ("before", pa.binary()), ("followers", pa.binary()), ("word", pa.binary()), ("count", pa.binary())])


def _pair_rows(before: np.ndarray, word: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Counts of the distinct pairs of a block, a row per bucket of the first word."""
    _, at, count = np.unique(pair(before, word), return_index=True, return_counts=True)
    before, word = before[at], word[at]
    bucket = _bucket(before, buckets)
    order = np.lexsort((before, bucket))
    before, word, count, bucket = before[order], word[order], count[order], bucket[order]
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(edges)):
        lo, hi = edges[b], edges[b + 1]
        first, followers = np.unique(before[lo:hi], return_counts=True)
        rows.append((int(b), first.tobytes(), _small(followers), word[lo:hi].tobytes(), _small(count[lo:hi])))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PAIRS)], schema=_PAIRS)


def _count_pairs(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, data, ends in chunks(batch["text"]):
                held.append(tokens(*hash_words(data, ends)))
                size += len(held[-1][0])
                if size >= BLOCK_TOKENS:
                    yield _pair_rows(np.concatenate([b for _, b in held]), np.concatenate([w for w, _ in held]), buckets)
                    held, size = [], 0
        if size:
            yield _pair_rows(np.concatenate([b for _, b in held]), np.concatenate([w for w, _ in held]), buckets)

    return run


def _save(folder: str, kind: str, bucket: int, arrays: dict[str, np.ndarray]) -> str:
    """Arrays as files of a name that no other attempt has; the name is what the task returns."""
    store, root = _open(folder)
    store.create_dir(root, recursive=True)
    name = f"{root}/{kind}-{bucket:05d}-{uuid.uuid4().hex}"
    for field, values in arrays.items():
        with store.open_output_stream(f"{name}.{field}", compression=None) as out:
            out.write(np.ascontiguousarray(values).tobytes())
    return name


def _sums(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, and the sums of the values of each."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return (key[at], *[np.add.reduceat(v[order], at) if len(key) else v for v in values])


def _of_counts(count: np.ndarray) -> list[int]:
    return [int((count == k).sum()) for k in (1, 2, 3, 4)]


_TOP = pa.schema(
    [
        ("kind", pa.string()),
        ("bucket", pa.int32()),
        ("name", pa.string()),
        ("size", pa.int64()),
        ("of_counts", pa.list_(pa.int64())),
        ("total", pa.int64()),
        ("word", pa.binary()),
        ("left", pa.binary()),
        ("raw", pa.binary()),
    ]
)
_TOP_DDL = "kind string, bucket int, name string, size long, of_counts array<long>, total long, word binary, left binary, raw binary"


def _pair_shard(folder: str, buckets: int):
    """Write one bucket's pairs and contexts; hand on, per word, its predecessors and its count."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        before, word, count = [], [], []
        for r in table.to_pylist():
            before.append(np.repeat(_hashes(r["before"]), _large(r["followers"]).astype(np.int64)))
            word.append(_hashes(r["word"]))
            count.append(_large(r["count"]))
        before, word, count = np.concatenate(before), np.concatenate(word), np.concatenate(count)
        key = pair(before, word)
        order = np.argsort(key, kind="stable")
        key, before, word, count = key[order], before[order], word[order], count[order]
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        key, before, word, count = key[at], before[at], word[at], np.add.reduceat(count, at)
        ones = np.ones(len(key), np.uint64)
        context, total, *by_count = _sums(before, count, *[np.where(t, ones, 0) for t in (count == 1, count == 2, count > 2)])
        name = _save(
            folder,
            "pairs",
            bucket,
            {"key": key, "count": count.astype("<u4"), "context": context, "total": total, "by_count": np.stack(by_count, axis=1).astype("<u4")},
        )
        rows = [("pairs", bucket, name, len(key), _of_counts(count), int(count.sum()), None, None, None)]
        own, left, raw = _sums(word, ones, count)
        to = _bucket(own, buckets)
        order = np.argsort(to, kind="stable")
        own, left, raw, to = own[order], left[order], raw[order], to[order]
        edges = np.searchsorted(to, np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)):
            part = slice(edges[b], edges[b + 1])
            rows.append(("words", int(b), None, 0, None, 0, own[part].tobytes(), _small(left[part]), _small(raw[part])))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _TOP)], schema=_TOP)

    return run


_WORDS = pa.schema([("bucket", pa.int32()), ("name", pa.string()), ("size", pa.int64()), ("of_counts", pa.list_(pa.int64())), ("total", pa.int64()), ("lefts", pa.int64())])


def _word_shard(folder: str):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        word, left, raw = (np.concatenate([f(r[c]) for r in rows]) for c, f in (("word", _hashes), ("left", _large), ("raw", _large)))
        word, left, raw = _sums(word, left, raw)
        name = _save(folder, "words", rows[0]["bucket"], {"word": word, "left": left, "raw": raw})
        row = (rows[0]["bucket"], name, len(word), _of_counts(left), int(raw.sum()), int(left.sum()))
        return pa.Table.from_arrays([pa.array([c], f.type) for c, f in zip(row, _WORDS)], schema=_WORDS)

    return run


# ---------------------------------------------------------------- the model


def discounts(of_counts: list[int]) -> np.ndarray:
    """What is taken from counts of 0, 1, 2 and 3 or more, from the numbers of counts 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in of_counts)
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    ratio = [(1, n2, n1), (2, n3, n2), (3, n4, n3)]
    out = [k - (k + 1) * y * (more / less) if less else 0.5 * k for k, more, less in ratio]
    return np.array([0.0, *[min(max(d, 0.0), float(k)) for d, (k, _, _) in zip(out, ratio)]])


@dataclass
class KneserNey:
    """Where the arrays lie, and the sums over all of them. Bucket files are ascending by hash.

    ``pairs`` and ``words`` name each bucket's files (None: no entry). The folder must be
    one that workers can map, that is a mounted one; arrays are mapped, never loaded.
    """

    pairs: list[str | None]
    words: list[str | None]
    pair_discount: np.ndarray
    word_discount: np.ndarray
    word_rest: float
    tokens: int
    vocabulary: int
    lefts: int

    def __post_init__(self):
        self._open: dict[str, np.ndarray] = {}

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def _array(self, name: str, field: str, kind: str) -> np.ndarray:
        path = f"{name}.{field}"
        if path not in self._open:
            self._open[path] = np.memmap(path, kind, "r")
        return self._open[path]

    def _find(self, names: list, bucket: np.ndarray, key: np.ndarray, field: str, values: tuple) -> list[np.ndarray]:
        """Values of keys by binary search in their buckets' arrays; 0 where a key is missing."""
        out = [np.zeros((len(key), width) if width > 1 else len(key), np.float64) for _, _, width in values]
        order = np.lexsort((key, bucket))
        edges = np.searchsorted(bucket[order], np.arange(len(names) + 1))
        for b, name in enumerate(names):
            if name is None or edges[b] == edges[b + 1]:
                continue
            rows = order[edges[b] : edges[b + 1]]
            have = self._array(name, field, "<u8")
            at = np.minimum(np.searchsorted(have, key[rows]), len(have) - 1)
            hit = have[at] == key[rows]
            for o, (f, kind, width) in zip(out, values):
                v = self._array(name, f, kind)
                o[rows[hit]] = (v.reshape(-1, width) if width > 1 else v)[at[hit]]
        return out

    def score(self, word: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each token after the one before it, and its count in training."""
        unique, inverse = np.unique(word, return_inverse=True)
        left, raw = self._find(self.words, _bucket(unique, len(self.words)), unique, "word", (("left", "<u8", 1), ("raw", "<u8", 1)))
        level = np.minimum(left, 3).astype(int)
        single = (left - self.word_discount[level]) / self.lefts if self.lefts else np.zeros(len(left))
        single = (single + self.word_rest / (self.vocabulary + 1))[inverse]

        contexts, of = np.unique(before, return_inverse=True)
        total, by_count = self._find(
            self.pairs, _bucket(contexts, len(self.pairs)), contexts, "context", (("total", "<u8", 1), ("by_count", "<u4", 3))
        )
        keys, at, back = np.unique(pair(before, word), return_index=True, return_inverse=True)
        (count,) = self._find(self.pairs, _bucket(before[at], len(self.pairs)), keys, "key", (("count", "<u4", 1),))
        count, known = count[back], (total > 0)[of]
        most = np.where(total > 0, total, 1)[of]
        rest = np.where(known, (by_count @ self.pair_discount[1:])[of] / most, 1.0)
        own = np.where(known, (count - self.pair_discount[np.minimum(count, 3).astype(int)]) / most, 0.0)
        return np.log10(own + rest * single), raw[inverse]


def train(docs: DataFrame, text_col: str = "text") -> KneserNey:
    """Count a table's texts and write the model's arrays into the shared folder.

    Pairs of tokens are counted block by block and meet in buckets of their first word (no
    pair of a bucket is anywhere else, so a context's sums are final there); what a word has
    of predecessors meets in buckets of the word. The driver sees names and sums of buckets.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "lm")
    if not isinstance(_open(folder)[0], fs.LocalFileSystem):
        raise ValueError("workers map the model's arrays: mount the folder in spark.checkpoint.dir and name it by file:")
    text = text_or_empty(text_col)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = int(max(8, size // 6 // BUCKET_PAIRS))
    counted = docs.select(text.alias("text")).mapInArrow(
        _count_pairs(buckets), "bucket int, before binary, followers binary, word binary, count binary"
    )
    shards = cut_lineage(counted.groupBy("bucket").applyInArrow(_pair_shard(folder, buckets), _TOP_DDL))
    words = shards.filter("kind = 'words'").select("bucket", "word", "left", "raw")
    words = cut_lineage(
        words.groupBy("bucket").applyInArrow(
            _word_shard(folder), "bucket int, name string, size long, of_counts array<long>, total long, lefts long"
        )
    )
    pair_rows = shards.filter("kind = 'pairs'").select("bucket", "name", "size", "of_counts").collect()  # one per bucket
    word_rows = words.collect()  # one per bucket
    sums = lambda rows: [sum(r["of_counts"][k] for r in rows) for k in range(4)]
    name_of = lambda rows: [{r["bucket"]: r["name"] for r in rows}.get(b) for b in range(buckets)]
    n1, n2, *_ = sums(word_rows)
    vocabulary, lefts = sum(r["size"] for r in word_rows), sum(r["lefts"] for r in word_rows)
    own = discounts(sums(word_rows))
    freed = own[1] * n1 + own[2] * n2 + own[3] * (vocabulary - n1 - n2)
    return KneserNey(
        pairs=name_of(pair_rows),
        words=name_of(word_rows),
        pair_discount=discounts(sums(pair_rows)),
        word_discount=own,
        word_rest=freed / lefts if lefts else 1.0,
        tokens=sum(r["total"] for r in word_rows),
        vocabulary=vocabulary,
        lefts=lefts,
    )


_SCORES = pa.schema(
    [
        ("id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)


def _score_texts(model: KneserNey):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, ends in chunks(batch["text"]):
                words, n_words = hash_words(data, ends)
                word, before = tokens(words, n_words)
                log, count = model.score(word, before)
                base = np.log10((count + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1)))
                n = n_words + 1
                firsts = np.cumsum(n) - n
                sums = [np.add.reduceat(x, firsts) for x in (base, log)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].slice(at, to - at),
                        batch["held_out"].slice(at, to - at),
                        pa.array(n),
                        pa.array(np.add.reduceat((count > 0).astype(np.int64), firsts)),
                        pa.array(np.full(to - at, model.tokens, np.int64)),
                        *[pa.array(s) for s in sums],
                    ],
                    schema=_SCORES,
                )

    return run


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, fold: int = HELD_OUT) -> DataFrame:
    """Train on all folds but one and score every row: a bigram model of the whole texts.

    A row's fold is crc32 of its id as text, modulo ``folds``; a null id is no fold and so
    in training. Words are lower-cased (A-Z) and split at white space; a text ends with a
    token of its own, so a null or empty text has one token. Returns ``id_col``, held_out,
    n_tokens, n_known, train_tokens, base_score (add-half unigrams) and score, the log10
    probability under interpolated modified Kneser-Ney: pairs back off to words by their
    number of distinct predecessors, and words to all words and one unknown alike. Without
    training rows every token has probability 1. Repeated rows count as often as they
    occur; an empty table gives an empty result; other columns play no part.
    """
    held = F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds == fold, F.lit(False))
    model = train(df.filter(~held), text_col)
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), held.alias("held_out"), text_or_empty(text_col).alias("text"))
    scored = rows.mapInArrow(
        _score_texts(model),
        "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    return scored.withColumnRenamed("id", id_col)
