"""Approximate nearest neighbours by cosine over a forest of hash-prefix trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut_lineage
from .words import mix

TREES = 40
BITS = 32  # length of a hash string
RECALL = 0.97  # aimed at on the sample of queries that sets how far queries ascend
SAMPLE_QUERIES, SAMPLE_ROWS = 128, 20_000  # bounds of the two samples
SHARD_ROWS = 200_000  # rows of a tree that one task holds
SEED = 7
TIE = 1e-9  # cosines so close may be equal: their order is left to the exact ranking


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _direction(vector: Column) -> Column:
    """The vector over its largest component; scaled copies are alike and have the same cosines."""
    top = F.array_max(F.transform(vector, F.abs))
    return F.get(F.transform(F.array(top), lambda t: F.transform(vector, lambda x: x / t)), F.lit(0))


class _Hasher:
    """Hash strings of a tree: on which side of BITS planes a vector lies, first plane first.

    Planes are random directions; each is moved so that a sample of the vectors splits evenly.
    """

    def __init__(self, dimension: int, trees: int, sample: np.ndarray):
        self.planes = np.random.default_rng(SEED).normal(size=(trees, dimension, BITS))
        unit = _unit(sample) if len(sample) else sample.reshape(0, dimension)
        self.middle = np.stack([np.median(unit @ p, axis=0) if len(unit) else np.zeros(BITS) for p in self.planes])

    def strings(self, unit: np.ndarray, tree: int) -> np.ndarray:
        sides = unit @ self.planes[tree] > self.middle[tree]
        return np.packbits(sides, axis=1).view(">u4").ravel().astype(np.uint32)


def _matrix(vectors: pa.Array, dimension: int) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return np.asarray(vectors.flatten(), np.float64).reshape(-1, dimension)


def _unit(matrix: np.ndarray) -> np.ndarray:
    top = np.abs(matrix).max(axis=1, keepdims=True) if len(matrix) else matrix[:, :1]
    matrix = matrix / top  # so that squares neither vanish nor overflow
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _prefix(strings: np.ndarray, depth: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """First and last hash string with the same first ``depth`` bits."""
    low = np.asarray(BITS - np.asarray(depth), np.uint64)
    first = (strings.astype(np.uint64) >> low) << low
    return first, first + (np.uint64(1) << low) - np.uint64(1)


# ---------------------------------------------------------------- how far to ascend


def _best_of_sample(queries: np.ndarray, dimension: int, k: int):
    """The nearest ``k`` vectors to each sample query among a task's rows, by brute force."""
    unit = _unit(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_score, best = np.full((len(unit), 0), -2.0), np.zeros((len(unit), 0, dimension))
        for batch in batches:
            rows = _matrix(batch["vector"], dimension)
            if not len(rows):
                continue
            score = unit @ _unit(rows).T
            score[score > 1 - 1e-12] = -2  # the query itself, or the same direction: found in any tree
            at = np.argsort(-score, axis=1)[:, :k]
            best_score = np.concatenate([best_score, np.take_along_axis(score, at, 1)], axis=1)
            best = np.concatenate([best, rows[at]], axis=1)
            at = np.argsort(-best_score, axis=1)[:, :k]
            best_score, best = np.take_along_axis(best_score, at, 1), np.take_along_axis(best, at[:, :, None], 1)
        q, r = np.nonzero(best_score > -2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(q.astype(np.int32)), pa.array(best_score[q, r]), pa.array(list(best[q, r]), pa.list_(pa.float64()))],
            names=["query", "score", "vector"],
        )

    return run


def _candidates_wanted(classes: DataFrame, queries: np.ndarray, hasher: _Hasher, rows: int, k: int, recall: float) -> tuple[int, int]:
    """Depth, and candidates over all trees, that a query must reach for the sample's neighbours to be found.

    A neighbour is found at a depth if it shares so many first bits with the query in any
    tree. The deepest depth with enough found says how many rows a query meets there.
    """
    trees, dimension, _ = hasher.planes.shape
    if not len(queries):
        return BITS, 1
    best = classes.mapInArrow(_best_of_sample(queries, dimension, k), "query int, score double, vector array<double>")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vector")
    nearest = best.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k).collect()  # k a sample query
    if not nearest:
        return 0, rows
    ours = _unit(queries[[r["query"] for r in nearest]])
    theirs = _unit(np.array([r["vector"] for r in nearest]))
    shared = np.zeros(len(nearest), int)
    for t in range(trees):
        differ = hasher.strings(ours, t) ^ hasher.strings(theirs, t)
        bits = np.where(differ > 0, BITS - 1 - np.floor(np.log2(np.maximum(differ, 1))), BITS).astype(int)
        shared = np.maximum(shared, bits)
    depth = max(d for d in range(BITS + 1) if (shared >= d).mean() >= recall)
    return depth, max(1, -(-trees * rows // (1 << depth)))


# ---------------------------------------------------------------- trees

_CODES = "tree int, shard int, part int, query boolean, key array<long>, string array<long>, vector array<double>, depth array<int>"


def _plant(hasher: _Hasher, root: int, parts: int, with_vectors: bool):
    """Deal rows out to every tree's shards; ``root`` first bits name the shard.

    A hash of the row names one of the shard's ``parts``; queries go to all of them.
    """
    trees, dimension, _ = hasher.planes.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(batch["vector"], dimension)
            if not len(matrix):
                continue
            unit, key = _unit(matrix), batch["key"].to_numpy()
            query = batch["query"].to_numpy(zero_copy_only=False)
            depth = batch["depth"].to_numpy() if with_vectors else np.zeros(len(key), np.int32)
            of = (mix(key.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
            rows = []
            for t in range(trees):
                strings = hasher.strings(unit, t)
                shard = strings >> np.uint32(BITS - root) if root else np.zeros(len(strings), np.uint32)
                for s in np.unique(shard):
                    own, asking = np.flatnonzero((shard == s) & ~query), np.flatnonzero((shard == s) & query)
                    for part in range(parts) if len(asking) else np.unique(of[own]).tolist():
                        for asks, at in ((False, own[of[own] == part]), (True, asking)):
                            if len(at):
                                vectors = matrix[at].ravel() if with_vectors else []
                                rows.append((t, int(s), part, asks, key[at], strings[at].astype(np.int64), vectors, depth[at]))
                if len(rows) > 64 or t == trees - 1:
                    if rows:
                        yield _rows(rows)
                    rows = []

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    tree, shard, piece, query, key, string, vector, depth = zip(*rows)
    lists = [(key, pa.int64()), (string, pa.int64()), (vector, pa.float64()), (depth, pa.int32())]
    return pa.RecordBatch.from_arrays(
        [*[pa.array(x, pa.int32()) for x in (tree, shard, piece)], pa.array(query), *[pa.array(x, pa.list_(kind)) for x, kind in lists]],
        names=["tree", "shard", "part", "query", "key", "string", "vector", "depth"],
    )


def _gather(table: pa.Table, asks: bool, dimension: int | None):
    part = table.filter(table["query"] if asks else pa.compute.invert(table["query"]))
    flat = lambda c, kind: np.asarray(part[c].combine_chunks().flatten() if part.num_rows else [], kind)
    key, string, depth = flat("key", np.int64), flat("string", np.int64).astype(np.uint64), flat("depth", np.int64)
    vector = flat("vector", np.float64).reshape(-1, dimension) if dimension else None
    return key, string, depth, vector


def _descend(root: int):
    """For each query of a part of a tree's shard: how many rows, itself too, share at least d first bits."""

    def run(table: pa.Table) -> pa.Table:
        _, have, _, _ = _gather(table, False, None)
        key, string, _, _ = _gather(table, True, None)
        have = np.sort(have)
        counts = np.zeros((len(key), BITS + 1), np.int64)
        for d in range(root, BITS + 1):
            first, last = _prefix(string, d)
            counts[:, d] = np.searchsorted(have, last, "right") - np.searchsorted(have, first, "left")
        counts[:, :root] = counts[:, root : root + 1]
        return pa.table({"key": pa.array(key), "counts": pa.array(list(counts), pa.list_(pa.int64()))})

    return run


def _meet(dimension: int, keep: int):
    """Score each query against the rows below the node that it has ascended to; the best ``keep`` go on, with all that tie."""

    def run(table: pa.Table) -> pa.Table:
        rows, have, _, vectors = _gather(table, False, dimension)
        key, string, depth, asked = _gather(table, True, dimension)
        order = np.lexsort((rows, have))
        rows, have, unit = rows[order], have[order], _unit(vectors)[order] if len(rows) else vectors
        out_q, out_r, out_s = [], [], []
        asked = _unit(asked) if len(asked) else asked
        first, last = _prefix(string, depth) if len(key) else (string, string)
        lo, hi = np.searchsorted(have, first, "left"), np.searchsorted(have, last, "right")
        nodes, of = np.unique(np.stack([lo, hi]), axis=1, return_inverse=True)
        for k in range(nodes.shape[1]):  # queries at one node are scored together
            a, b = int(nodes[0, k]), int(nodes[1, k])
            if a == b:
                continue
            for own in np.array_split(np.flatnonzero(of.ravel() == k), max(1, (b - a) * int((of.ravel() == k).sum()) // 4_000_000)):
                score = asked[own] @ unit[a:b].T
                n = min(keep, b - a)
                last = np.partition(score, b - a - n, axis=1)[:, b - a - n]
                q, r = np.nonzero(score >= last[:, None] - TIE)
                out_q.append(key[own][q])
                out_r.append(rows[a:b][r])
                out_s.append(score[q, r])
        cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        return pa.table({"asked": cat(out_q, np.int64), "key": cat(out_r, np.int64), "near": cat(out_s, np.float64)})

    return run


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The measure itself, on the original vectors, in double precision."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        a = np.asarray(batch["ours"].flatten(), np.float64).reshape(n, -1)
        b = np.asarray(batch["theirs"].flatten(), np.float64).reshape(n, -1)
        a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
        score = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
        yield pa.RecordBatch.from_arrays([batch["asked"], batch["key"], pa.array(score)], names=["asked", "key", "score"])


def nearest(
    df: DataFrame,
    asks: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    recall: float = RECALL,
) -> DataFrame:
    """The ``k`` rows nearest by cosine to every row where ``asks`` holds, other ids only.

    Returns query_id, rank (from 1, ties to the smaller id), ``id_col`` and score. Takes no
    part: a row with a null id, a vector that is null, zero, of another length than most, or
    with null or non-finite components. Rows that repeat an id and a vector are one row; a
    query never meets rows of its own id. An empty table gives an empty result; other columns
    play no part.

    Equal and scaled vectors are one class with its smallest ids (one more than ``k`` is all a
    query can need), so copies fill no node; candidates that tie with the last one kept stay. Every class is in every tree: sorted arrays of hash strings,
    cut into shards of about SHARD_ROWS by their first bits and, where that prefix would be
    longer than queries may ascend, by a hash of the row. A query descends to its longest prefix
    in each tree; then all trees ascend together, bit by bit, to the depth that most queries
    need, and on until the query meets enough rows over all trees: shards' prefixes are shortened
    until that holds for every query. Those rows are scored where they lie, in all parts of
    the shard. Depth and number are measured on at most SAMPLE_QUERIES
    queries whose true neighbours are found by brute force over all rows.
    """
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), vector.alias("vector"), asks.alias("query"))
    rows = rows.filter(F.col("id").isNotNull() & _usable(F.col("vector")))
    rows = rows.withColumn("vector", _direction(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dimension = lengths["n"] if lengths else 1
    # Class: the smallest id that has the vector; of larger groups only the smallest ids are kept,
    # and all that ask.
    same = Window.partitionBy("vector").orderBy("id")
    first = rows.filter(F.size("vector") == dimension).groupBy("vector").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = cut_lineage(first.select(F.monotonically_increasing_id().alias("key"), "vector"))
    few = (
        rows.select("id", "vector").distinct().withColumn("at", F.row_number().over(same)).filter(F.col("at") <= k + 1).select("id", "vector")
    )
    members = cut_lineage(few.join(classes, "vector").select("id", "key"))
    asking = cut_lineage(rows.filter("query").select("id", "vector").distinct().join(classes, "vector").select("id", "key"))

    n = classes.count()
    asked = classes.join(asking.select("key").distinct(), "key", "left_semi")
    drawn = F.xxhash64(F.lit(SEED), F.col("vector"))
    take = lambda d, most: np.array([r["vector"] for r in d.orderBy(drawn).limit(most).collect()], float).reshape(-1, dimension)
    hasher = _Hasher(dimension, trees, take(classes.select("vector"), SAMPLE_ROWS))
    known, wanted = _candidates_wanted(classes, take(asked.select("vector"), SAMPLE_QUERIES), hasher, n, k, recall)
    # So many that one tree alone has k of them, or all rows where there are fewer.
    wanted = max(wanted, trees * min(k, n - 1))
    root = min(BITS - 1, max(0, int(np.ceil(np.log2(max(1, n / SHARD_ROWS))))))

    every = classes.select("key", "vector", F.lit(False).alias("query")).unionByName(
        asked.select("key", "vector", F.lit(True).alias("query"))
    )
    root = min(root, known)
    while True:
        parts = max(1, int(np.ceil(n / (1 << root) / SHARD_ROWS)))
        codes = every.mapInArrow(_plant(hasher, root, parts, False), _CODES)
        counts = codes.groupBy("tree", "shard", "part").applyInArrow(_descend(root), "key long, counts array<long>")
        sums = counts.groupBy("key").agg(*[(F.sum(F.get("counts", F.lit(d))) - trees).alias(f"c{d}") for d in range(BITS + 1)])
        if not root:
            break
        sums = cut_lineage(sums)
        if sums.filter(F.col(f"c{root}") < wanted).isEmpty():
            break
        root //= 2  # some query must ascend further
    deep = F.greatest(F.lit(root), *[F.when(F.col(f"c{d}") >= wanted, d).otherwise(root) for d in range(root, BITS + 1)])
    deep = F.least(deep, F.lit(known))
    depths = cut_lineage(sums.select("key", deep.cast("int").alias("depth")))

    every = (
        classes.select("key", "vector", F.lit(False).alias("query"), F.lit(0).alias("depth"))
        .unionByName(asked.join(depths, "key").select("key", "vector", F.lit(True).alias("query"), "depth"))
    )
    planted = every.mapInArrow(_plant(hasher, root, parts, True), _CODES)
    met = planted.groupBy("tree", "shard", "part").applyInArrow(_meet(dimension, k + 1), "asked long, key long, near double")
    pairs = met.groupBy("asked", "key").agg(F.max("near").alias("near"))
    best = Window.partitionBy("asked").orderBy(F.desc("near"), "key")
    pairs = pairs.withColumn("at", F.row_number().over(best))
    last = F.min(F.when(F.col("at") <= 2 * k + 2, F.col("near"))).over(Window.partitionBy("asked"))
    pairs = pairs.withColumn("last", last).filter(F.col("near") >= F.col("last") - TIE).select("asked", "key")
    with_vectors = pairs.join(classes.select(F.col("key").alias("asked"), F.col("vector").alias("ours")), "asked").join(
        classes.select("key", F.col("vector").alias("theirs")), "key"
    )
    scored = with_vectors.select("asked", "key", "ours", "theirs").mapInArrow(_cosines, "asked long, key long, score double")
    found = (
        asking.select(F.col("id").alias("query_id"), F.col("key").alias("asked"))
        .join(scored, "asked")
        .join(members, "key")
        .filter("id <> query_id")
        .select("query_id", "id", "score")
        .groupBy("query_id", "id")
        .agg(F.max("score").alias("score"))
    )
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        found.withColumn("rank", F.row_number().over(rank))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
    )
