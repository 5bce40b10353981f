"""Documents whose word-shingle sets overlap by a Jaccard similarity, joined by signature trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage, text_or_empty
from .components import connected_components
from .words import chunks, hash_words, mix, shingles

SHINGLE = 5
PERCENT = 75
# Text of a block of documents, and shingles that one counting task holds.
BLOCK_BYTES = 2_000_000
BUCKET_SHINGLES = 2_000_000
# A signature's bits and a tree node's children.
BITS = 2048
FANOUT = 4
# Node pairs looked at in one step of a traversal.
STEP_PAIRS = 100_000

_LOW = np.uint64((1 << 48) - 1)


def _pack(h: np.ndarray) -> bytes:
    """The lower 48 bits of each hash; the rest is in the bucket's number."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _runs(counts: np.ndarray) -> np.ndarray:
    """The index of the run that each element is in."""
    return np.repeat(np.arange(len(counts)), counts)


# ---------------------------------------------------------------- shingles and their frequency

_BLOCKS = pa.schema(
    [
        ("bucket", pa.int32()),
        ("block", pa.int64()),
        ("hashes", pa.binary()),
        ("counts", pa.binary()),
        ("ids", pa.list_(pa.int64())),
        ("rows", pa.list_(pa.int64())),
        ("same_as", pa.binary()),
    ]
)


def _split(size: int, buckets: int):
    """Cut each block's shingle sets by hash: a row per block and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"]
            for at, to, data, ends in chunks(texts, BLOCK_BYTES):
                words, n_words = hash_words(data, ends)
                h, n = shingles(words, n_words, size)
                # Equal sets of a block go on once: by size and two sums over the set.
                of = _runs(n)
                first, second = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                np.add.at(first, of, h)
                np.add.at(second, of, mix(h))
                seen: dict = {}
                same = np.array([seen.setdefault(k, i) for i, k in enumerate(zip(n.tolist(), first.tolist(), second.tolist()))], np.uint32)
                go = (same == np.arange(len(n)))[of] if len(n) else np.zeros(0, bool)
                h, of = h[go], of[go]
                bucket = ((h >> np.uint64(48)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                h, of, bucket = h[order], of[order], bucket[order]
                edges = np.searchsorted(bucket, np.arange(buckets + 1))
                rows = []
                block = batch["row"][at].as_py()  # a row's number is nobody else's
                keeper = block % buckets
                for b in range(buckets):
                    lo, hi = edges[b], edges[b + 1]
                    if lo == hi and b != keeper:
                        continue
                    held = np.bincount(of[lo:hi], minlength=len(n)).astype("<u4")
                    own = b == keeper
                    rows.append(
                        {
                            "bucket": b,
                            "block": block,
                            "hashes": _pack(h[lo:hi]),
                            "counts": held.tobytes(),
                            "ids": batch["id"].slice(at, to - at).to_pylist() if own else None,
                            "rows": batch["row"].slice(at, to - at).to_pylist() if own else None,
                            "same_as": same.astype("<u4").tobytes() if own else None,
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, schema=_BLOCKS)

    return run


_COUNTED = pa.schema([*_BLOCKS, ("shared", pa.binary()), ("frequency", pa.binary())])


def _count(table: pa.Table) -> pa.Table:
    """In one bucket: keep the shingles that several sets hold, with their number of sets (255 at most)."""
    rows = table.to_pylist()
    hashes = [_unpack(r["hashes"]) for r in rows]
    every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    _, inverse, count = np.unique(every, return_inverse=True, return_counts=True)
    frequency = np.minimum(count, 255).astype(np.uint8)[inverse]
    at, out = 0, []
    for r, h in zip(rows, hashes):
        f = frequency[at : at + len(h)]
        at += len(h)
        many = f > 1
        held = np.frombuffer(r["counts"], "<u4")
        shared = np.bincount(_runs(held)[many], minlength=len(held)).astype("<u4")
        out.append(r | {"hashes": _pack(h[many]), "shared": shared.tobytes(), "frequency": f[many].tobytes()})
    return pa.Table.from_pylist(out, schema=_COUNTED)


_SETS = pa.schema(
    [
        ("id", pa.int64()),
        ("row", pa.int64()),
        ("same_as", pa.int64()),
        ("n", pa.int64()),
        ("keys", pa.list_(pa.int64())),
        ("shared", pa.binary()),
    ]
)


def _prefixes(percent: int):
    """Per document of a block: its set's size and, if it can be in a link, keys and shared shingles.

    A set that links with another misses at most n - ceil(percent * n / 100) of its own
    shingles, so one more than that, in an order common to all sets (rarest first, then by
    hash), hold one that both have. A set with so many shingles of its own has no link.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
        lead = next(r for r in rows if r["rows"] is not None)
        size = len(lead["rows"])
        total = np.zeros(size, np.int64)
        h, f, of = [], [], []
        for r in rows:
            total += np.frombuffer(r["counts"], "<u4")
            h.append(_unpack(r["hashes"]) | np.uint64(r["bucket"] << 48))
            f.append(np.frombuffer(r["frequency"], np.uint8))
            of.append(_runs(np.frombuffer(r["shared"], "<u4")))
        h, f, of = np.concatenate(h), np.concatenate(f), np.concatenate(of)
        order = np.lexsort((h, of))
        h, f, of = h[order], f[order], of[order]
        edges = np.searchsorted(of, np.arange(size + 1))
        same = np.frombuffer(lead["same_as"], "<u4")
        out = []
        for i in range(size):
            n = int(total[same[i]])
            row = {"id": lead["ids"][i], "row": lead["rows"][i], "same_as": lead["rows"][same[i]], "n": n, "keys": None, "shared": None}
            if same[i] == i and n:
                own, often = h[edges[i] : edges[i + 1]], f[edges[i] : edges[i + 1]]
                need = n + (-n * percent // 100) + 1 - (n - len(own))  # keys beyond the set's own shingles
                if need > 0:
                    first = np.lexsort((own, often))[:need]
                    row |= {"keys": own[first].view(np.int64).tolist(), "shared": own.astype("<u8").tobytes()}
            out.append(row)
        return pa.Table.from_pylist(out, schema=_SETS)

    return run


# ---------------------------------------------------------------- signature trees


class _Forest:
    """Which documents are known to be connected."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = int(self.up[i])
        return i

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def labels(self) -> np.ndarray:
        up = self.up
        while not np.array_equal(up[up], up):
            up = up[up]
        self.up = up
        return up


def _link(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, percent: int) -> bool:
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (n_a + n_b - common)


class _Tree:
    """Levels of nodes over sets in a fixed order; node k of a level covers FANOUT of the level below.

    A node holds the OR of its sets' bitmaps, the range of their sizes, the most shingles
    that share a bit with another of the same set, and their component if they have one
    in common (else -1).
    """

    def __init__(self, bits: np.ndarray, n: np.ndarray, spare: np.ndarray, component: np.ndarray):
        self.levels = [(bits, n, n, spare, component)]
        while len(self.levels[-1][1]) > 1:
            b, low, high, s, c = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            least, most = np.minimum.reduceat(c, at), np.maximum.reduceat(c, at)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(b, at, axis=0),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(s, at),
                    np.where(least == most, least, -1),
                )
            )

    def possible(self, level: int, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Whether a set below node i may link with one below node j of another component."""
        bits, low, high, spare, component = self.levels[level]
        ok = (component[i] != component[j]) | (component[i] < 0)
        ok &= (100 * high[i] >= percent * low[j]) & (100 * high[j] >= percent * low[i])
        at = np.flatnonzero(ok)
        common = np.bitwise_count(bits[i[at]] & bits[j[at]]).sum(axis=1, dtype=np.int64)
        most = common + np.minimum(spare[i[at]], spare[j[at]])  # no two sets here share more shingles
        ok[at] = (100 + percent) * most >= percent * (low[i[at]] + low[j[at]])
        return ok


def link_sets(sets: list[np.ndarray], n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Component (smallest index) of each set under links of at least ``percent``.

    ``sets`` are ascending hashes, without those that no other set holds; ``n`` are the sizes
    with them. Exact: a pair is left out only if its bound is too low or it is connected already.
    """
    m = len(sets)
    forest = _Forest(m)
    if m < 2:
        return forest.labels()
    first = np.array([s[0] if len(s) else 0 for s in sets], np.uint64)
    order = np.lexsort((n, first))
    for a, b in zip(order[:-1].tolist(), order[1:].tolist()):  # likely neighbours first
        if _link(sets[a], sets[b], n[a], n[b], percent):
            forest.join(a, b)

    # Sets of a component lie together, so whole nodes have one component.
    order = np.lexsort((n, first, forest.labels()))
    lengths = np.array([len(sets[i]) for i in order])
    bit = (mix(np.concatenate([sets[i] for i in order])) % np.uint64(BITS)).astype(np.int64)
    grid = np.zeros((m, BITS), bool)
    bits = np.zeros((m, BITS // 64), np.uint64)
    ends = np.cumsum(lengths)
    for k in range(0, m, 512):  # the unpacked grid of some sets at a time
        hi = min(m, k + 512)
        part = grid[: hi - k]
        part[:] = False
        lo_at = ends[k] - lengths[k]
        part[_runs(lengths[k:hi]), bit[lo_at : ends[hi - 1]]] = True
        bits[k:hi] = np.packbits(part, axis=1).view(np.uint64)
        if k == 0:
            grid = grid[:512]
    spare = lengths - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    sizes = n[order].astype(np.int64)
    tree = _Tree(bits, sizes, spare, forest.labels()[order])

    top = len(tree.levels) - 1
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, i, j = stack.pop()
        if len(i) > STEP_PAIRS:
            stack.append((level, i[STEP_PAIRS:], j[STEP_PAIRS:]))
            i, j = i[:STEP_PAIRS], j[:STEP_PAIRS]
        keep = tree.possible(level, i, j, percent)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if level:
            step = np.arange(FANOUT)
            below = len(tree.levels[level - 1][1])
            ii = (i[:, None, None] * FANOUT + step[None, :, None] + 0 * step[None, None, :]).ravel()
            jj = (j[:, None, None] * FANOUT + step[None, None, :] + 0 * step[None, :, None]).ravel()
            ok = (ii < below) & (jj < below) & ((ii < jj) | ((ii == jj) & (level > 1)))
            stack.append((level - 1, ii[ok], jj[ok]))
            continue
        while len(i):  # one pair of each two components, then the labels again
            labels = forest.labels()
            a, b = labels[order[i]], labels[order[j]]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            _, pick = np.unique(np.minimum(a, b) * m + np.maximum(a, b), return_index=True)
            for k in pick.tolist():
                x, y = int(order[i[k]]), int(order[j[k]])
                if forest.find(x) != forest.find(y) and _link(sets[x], sets[y], n[x], n[y], percent):
                    forest.join(x, y)
            rest = np.ones(len(i), bool)
            rest[pick] = False
            i, j = i[rest], j[rest]
    return forest.labels()


_LINKED = pa.schema([("row", pa.int64()), ("component", pa.int64())])


def _link_cluster(percent: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table["row"].to_numpy()
        sets = [np.frombuffer(s, "<u8") for s in table["shared"].to_pylist()]
        labels = link_sets(sets, table["n"].to_numpy(), percent)
        return pa.Table.from_arrays([pa.array(rows), pa.array(rows[labels])], schema=_LINKED)

    return run


# ---------------------------------------------------------------- the join


def shingle_sets(df: DataFrame, id_col: str, text_col: str, size: int, percent: int, row_col: str | None = None) -> DataFrame:
    """Rows (id, row, same_as, n, keys, shared) of all documents, written to the shared folder."""
    text = text_or_empty(text_col)
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = int(min(60_000, max(8, total // 6 // BUCKET_SHINGLES)))
    row = F.monotonically_increasing_id() if row_col is None else F.col(f"`{row_col}`").cast("bigint")
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), row.alias("row"), text.alias("text"))
    blocks = rows.mapInArrow(
        _split(size, buckets),
        "bucket int, block long, hashes binary, counts binary, ids array<long>, rows array<long>, same_as binary",
    )
    counted = blocks.groupBy("bucket").applyInArrow(
        _count,
        "bucket int, block long, hashes binary, counts binary, ids array<long>, rows array<long>, same_as binary, "
        "shared binary, frequency binary",
    )
    sets = counted.groupBy("block").applyInArrow(
        _prefixes(percent), "id long, row long, same_as long, n long, keys array<long>, shared binary"
    )
    return cut_lineage(sets)


def jaccard_components(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    row_col: str | None = None,
) -> DataFrame:
    """One row per row of ``df``: ``id_col``, n_shingles and component_id.

    With ``row_col``, a bigint column of ``df`` that is unique and not null, rows go by it: it
    is returned first, and component, the row_col of some row of the component, last.


    Two rows link when their sets of ``size``-word shingles have a Jaccard similarity of at
    least ``percent`` in a hundred; component_id is the smallest id that links reach.
    Words are lower-cased (A-Z) and split at white space; a text with fewer words is one
    shingle, a null text or one without words has none and links with nothing. Null ids stay
    null and are passed over as component_id unless a component has no other; rows that
    repeat an id are rows of their own. An empty table gives an empty result; other columns
    play no part.

    1. Blocks of documents are turned into shingle hashes, equal sets of a block go on once,
       and hashes travel in packed arrays, a row per block and hash bucket. A bucket counts
       its shingles and returns those that several sets hold.
    2. Per document, rarest first, the shingles that a link cannot avoid are its keys;
       most documents have enough shingles of their own and none.
    3. Documents with a key in common form clusters (a star per key, then connected
       components), so no link leaves a cluster and no pairs are listed.
    4. In each cluster a signature tree is traversed against itself (:func:`link_sets`).
    """
    sets = shingle_sets(df, id_col, text_col, size, percent, row_col)
    keys = sets.filter("keys IS NOT NULL").select("row", F.explode("keys").alias("key"))
    hubs = keys.groupBy("key").agg(F.min("row").alias("hub"), F.count(F.lit(1)).alias("held")).filter("held > 1").select("key", "hub")
    stars = keys.join(hubs, "key").filter("row <> hub").groupBy("row", "hub").agg(F.count(F.lit(1)).alias("keys")).select("row", "hub")
    clusters = connected_components(cut_lineage(stars), "row", "hub")
    members = sets.filter("shared IS NOT NULL").select("row", "n", "shared").join(clusters.withColumnRenamed("node", "row"), "row")
    linked = members.groupBy("component").applyInArrow(_link_cluster(percent), "row long, component long")
    linked = cut_lineage(linked.withColumnRenamed("row", "same_as"))
    placed = sets.select("id", "row", "same_as", "n").join(linked, "same_as", "left")
    placed = placed.withColumn("component", F.when(F.col("n") > 0, F.coalesce("component", "same_as")))
    least = placed.groupBy("component").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows"))
    least = least.filter("component IS NOT NULL AND rows > 1").select("component", "least")
    by_row = row_col is not None
    return placed.join(least, "component", "left").select(
        *([F.col("row").alias(row_col)] if by_row else []),
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("least", "id").alias("component_id"),
        *(["component"] if by_row else []),
    )
