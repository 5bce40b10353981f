"""Words of whole texts as 64-bit hashes, computed over Arrow buffers with numpy.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased.
Nothing here makes a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = 0x9E3779B97F4A7C15  # odd, so that powers have inverses modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
# Text handled at once; a longer document is handled alone.
CHUNK_BYTES = 2_000_000


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def mix_one(value: int) -> int:
    return int(mix(np.array([value], np.uint64))[0])


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done, step = 1, base
    while done < n:
        m = min(done, n - done)
        out[done : done + m] = out[:m] * np.uint64(step)
        done, step = done + m, step * step % (1 << 64)
    return out


_TABLES: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _TABLES or len(_TABLES["up"]) < n:
        size = max(n, CHUNK_BYTES)
        _TABLES["up"], _TABLES["down"] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _TABLES["up"][:n], _TABLES["down"]


def runs(data: np.ndarray, ends: np.ndarray, parts: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last byte of each run of bytes that ``parts`` does not name, and each text's runs.

    ``data`` holds the bytes of texts laid end to end, ``ends`` the first byte after each text.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
    inside = ~parts[data]
    starts_here = inside.copy()
    starts_here[1:] &= ~inside[:-1]
    stops_here = inside.copy()
    stops_here[:-1] &= ~inside[1:]
    edges = np.concatenate([[0], ends])
    some = edges[:-1] < ends  # a text's edge parts runs as well
    starts_here[edges[:-1][some]] = inside[edges[:-1][some]]
    stops_here[ends[some] - 1] = inside[ends[some] - 1]
    starts, stops = np.flatnonzero(starts_here), np.flatnonzero(stops_here)
    return starts, stops, np.diff(np.searchsorted(starts, edges))


def running_hash(data: np.ndarray, fold: bool = True) -> np.ndarray:
    """Sums from which :func:`hash_spans` takes the hash of any span of the bytes, with ``fold`` of A-Z as a-z."""
    return np.cumsum(_BYTE[_LOWER[data] if fold else data] * _tables(len(data))[0])


def hash_spans(summed: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    words = summed[stops]
    words[starts > 0] -= summed[starts[starts > 0] - 1]
    return mix(words * _tables(len(summed))[1][starts])


def hash_words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts laid end to end, and each text's number of words."""
    starts, stops, counts = runs(data, ends)
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    return hash_spans(running_hash(data), starts, stops), counts


def chunks(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a string array of about ``chunk_bytes``: first row, row after, bytes, ends.

    Null texts are empty.
    """
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + chunk_bytes, "right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at + 1 : to + 1] - offsets[at]
        at = to


class Spans:
    """Hashes of spans of words, case and all: as many steps for a long span as for a short one."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        starts, stops, self.counts = runs(data, ends)
        words = hash_spans(running_hash(data, fold=False), starts, stops) if len(starts) else np.zeros(0, np.uint64)
        self.firsts = np.cumsum(self.counts) - self.counts
        up, self._down = _tables(len(words) + 1)
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[1:])])

    def hash(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Of the words from ``start`` up to, not with, ``stop``; numbers count through all texts."""
        length = (stop - start).astype(np.uint64)
        return mix((self._sums[stop] - self._sums[start]) * self._down[start] + length)


def word_hash(word: str) -> int:
    """The hash of one word, for tests."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(hash_words(data, np.array([len(data)]))[0][0])


def shingles(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and how many each has.

    A text with fewer than ``size`` words, but some, has its whole sequence as one shingle.
    """
    starts = np.cumsum(counts) - counts
    text_of = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(words)) - starts[text_of] if len(words) else np.zeros(0, np.int64)
    own = np.maximum(counts - size + 1, np.minimum(counts, 1))
    begins = np.flatnonzero(at < own[text_of]) if len(words) else np.zeros(0, np.int64)
    text_of = text_of[begins]
    length = np.minimum(counts[text_of], size)
    h = mix(length.astype(np.uint64) + np.uint64(0x51ED270B))
    for k in range(size):
        use = k < length
        step = words[np.minimum(begins + k, len(words) - 1)] if len(words) else words
        h = np.where(use, mix(h * np.uint64(_BASE) + step), h)
    order = np.lexsort((h, text_of))
    h, text_of = h[order], text_of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text_of[1:] != text_of[:-1])
    return h[new], np.bincount(text_of[new], minlength=len(counts)).astype(np.int64)
