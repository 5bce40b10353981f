"""Quantiles of many frames over one sequence, with numpy inside a task."""

from __future__ import annotations

import numpy as np


class RankTree:
    """A wavelet matrix over the ranks of a sequence: the k-th smallest of any stretch in as
    many steps as ranks have bits, for all stretches asked for at once."""

    def __init__(self, values: np.ndarray) -> None:
        self.values, ranks = np.unique(values, return_inverse=True)
        narrow = np.int32 if len(values) < 2**31 else np.int64
        ranks = ranks.astype(narrow)
        self.bits = max(1, int(max(len(self.values) - 1, 0)).bit_length())
        self.zeros = []  # per bit: zeros before each place
        for bit in range(self.bits - 1, -1, -1):
            one = (ranks >> bit) & 1
            self.zeros.append(np.concatenate([np.zeros(1, narrow), np.cumsum(1 - one, dtype=narrow)]))
            ranks = np.concatenate([ranks[one == 0], ranks[one == 1]])

    def smallest(self, start: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of values[start:end]."""
        start, end, k = (np.asarray(a, np.int64).copy() for a in (start, end, k))
        rank = np.zeros(len(k), np.int64)
        for zeros in self.zeros:
            a, b = zeros[start], zeros[end]
            low = k < b - a
            rank = rank * 2 + ~low
            k = np.where(low, k, k - (b - a))
            start = np.where(low, a, zeros[-1] + start - a)
            end = np.where(low, b, zeros[-1] + end - b)
        return self.values[rank]


def frame_quantiles(values: np.ndarray, known: np.ndarray, start: np.ndarray, end: np.ndarray, qs: list[float], least: int) -> list[np.ndarray]:
    """Linearly interpolated quantiles of the known values in each values[start:end]; masked
    arrays, masked with fewer than ``least`` known values or none."""
    before = np.concatenate([[0], np.cumsum(known)])
    start, end = before[start], before[end]
    n = end - start
    enough = n >= max(1, least)
    out = []
    tree = RankTree(values[known]) if enough.any() else None
    for q in qs:
        result = np.zeros(len(start))
        if tree is not None:
            a, b, m = start[enough], end[enough], n[enough]
            target = (m - 1) * q
            low = np.floor(target).astype(np.int64)
            first = tree.smallest(a, b, low)
            following = tree.smallest(a, b, np.minimum(low + 1, m - 1))
            share = target - low
            with np.errstate(invalid="ignore"):
                between = first * (1 - share) + following * share
            result[enough] = np.where((share == 0) | (first == following), first, between)
        out.append(np.ma.array(result, mask=~enough))
    return out
