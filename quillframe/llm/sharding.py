"""Sharding by a k-d tree over metadata (DataFrame functions only)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut_lineage, text_or_empty

# A dimension's value takes the upper 31 bits of a split key, a hash of the row the lower
# 32: equal values can still be cut, so one source with a third of all rows is no obstacle.
_VALUE = 1 << 31
_HASH = 1 << 32
# Cells of one histogram pass, and the share of a leaf's bytes at which a cut is exact enough.
CELLS = 256
TOLERANCE = 1e-3
# Rows numbered by one task.
SLOT_ROWS = 200_000


@dataclass
class _Node:
    key: int
    leaves: int
    first_leaf: int
    dimension: int = -1
    cut: int = 0
    children: tuple[int, int] = (-1, -1)


def _spread(name: str) -> Column:
    """A column as a number in [0, 1): names by their hash, so equal names stay together."""
    return F.pmod(F.xxhash64(F.col(name)), F.lit(_VALUE)) / F.lit(float(_VALUE))


def kd_shards(
    df: DataFrame,
    shards: int | None = 40,
    target_bytes: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    names: tuple[str, ...] = ("source", "lang"),
    numbers: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Put every row into a shard of nearly equal bytes; neighbours in metadata share one.

    ``shards`` fixes the number of leaves, or ``target_bytes`` the bytes of a leaf. A row
    weighs its text's UTF-8 bytes plus 16. Dimensions are the ``names`` (by hash), the
    ``numbers`` and the row's size; a node is cut along the dimension that is widest, as a
    share of the whole table's width, at the weighted median (for an odd number of leaves,
    the quantile that gives each leaf its share). Medians come from histograms of at most
    CELLS cells a node, narrowed until the cell that holds the cut weighs less than
    TOLERANCE of a leaf; only those histograms reach the driver.

    Returns id, size, text_crc32, law (``bytes``), shard, slot and grown_shard (null). Slots
    are gapless from 0 in each shard. Null texts weigh 16 and count as empty; null numbers
    lie before all others, null names are one name; equal rows may part. An empty table
    gives an empty result; columns of other names are ignored, and missing dimensions are left out.
    """
    text, columns = text_or_empty(text_col), {c.lower() for c in df.columns}
    names = tuple(c for c in names if c.lower() in columns)
    numbers = tuple(c for c in numbers if c.lower() in columns)
    base = df.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.crc32(text.cast("binary"))), F.lit(_HASH)).alias("tie"),
        *[_spread(f"`{c}`").alias(f"d{k}") for k, c in enumerate(names)],
        *[F.col(f"`{c}`").cast("double").alias(f"r{k}") for k, c in enumerate(numbers)],
    )
    base = cut_lineage(base)
    whole = base.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("size").alias("bytes"),
        *[f(c).alias(f"{c}_{f.__name__}") for c in [f"r{k}" for k in range(len(numbers))] + ["size"] for f in (F.min, F.max)],
    ).first()
    if not whole["n"]:
        leaves = 1
    else:
        leaves = shards or max(1, -(-whole["bytes"] // target_bytes))

    def scaled(name: str) -> Column:
        low, high = whole[f"{name}_min"], whole[f"{name}_max"]
        if low is None or not high > low:
            return F.lit(0.0)
        at = (F.col(name).cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low))
        return F.coalesce(at, F.lit(0.0))

    dimensions = [F.col(f"d{k}") for k in range(len(names))] + [scaled(f"r{k}") for k in range(len(numbers))] + [scaled("size")]
    keys = [F.floor(F.least(d, F.lit(1.0)) * (_VALUE - 1)) * F.lit(_HASH) + F.col("tie") for d in dimensions]
    rows = base.select("id", "size", "crc", "tie", *[k.cast("bigint").alias(f"k{i}") for i, k in enumerate(keys)])
    rows = cut_lineage(rows.withColumn("node", F.lit(0)))

    nodes = [_Node(0, leaves, 0)]
    open_nodes = [nodes[0]] if leaves > 1 and whole["n"] else []
    leaf_bytes = (whole["bytes"] or 0) / leaves
    while open_nodes:
        _choose_cuts(rows, open_nodes, len(keys), leaf_bytes)
        following = []
        for node in open_nodes:
            left = node.leaves // 2
            pair = (_Node(len(nodes), left, node.first_leaf), _Node(len(nodes) + 1, node.leaves - left, node.first_leaf + left))
            node.children = (pair[0].key, pair[1].key)
            nodes += pair
            following += [x for x in pair if x.leaves > 1]
        # Written at each level: nested in one another, the levels' conditions would double each time.
        rows = cut_lineage(rows.withColumn("node", _descend(open_nodes)))
        open_nodes = following

    leaf = F.create_map(*[F.lit(x) for n in nodes if n.leaves == 1 for x in (n.key, n.first_leaf)])
    placed = rows.select("id", "size", "crc", "tie", leaf[F.col("node")].alias("shard"))
    return _with_slots(placed, whole["n"]).select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _pick(nodes: list[_Node], value, otherwise=None) -> Column:
    """``value(node)`` for the row's node."""
    out = None
    for n in nodes:
        test = F.col("node") == n.key
        out = F.when(test, value(n)) if out is None else out.when(test, value(n))
    return out if otherwise is None else out.otherwise(otherwise)


def _descend(nodes: list[_Node]) -> Column:
    def side(n: _Node) -> Column:
        return F.when(F.col(f"k{n.dimension}") < n.cut, n.children[0]).otherwise(n.children[1])

    return _pick(nodes, side, F.col("node")).cast("int")


def _choose_cuts(rows: DataFrame, nodes: list[_Node], dimensions: int, leaf_bytes: float) -> None:
    """Set dimension and cut of every node of a level, all nodes in each pass."""
    inside = rows.filter(F.col("node").isin([n.key for n in nodes]))
    ends = [f(f"k{i}").alias(f"{f.__name__}{i}") for i in range(dimensions) for f in (F.min, F.max)]
    spans, state = {}, {}
    for r in inside.groupBy("node").agg(F.sum("size").alias("bytes"), *ends).collect():
        spans[r["node"]] = r
    for n in nodes:
        r = spans.get(n.key)
        if r is None:  # no rows: any cut will do
            n.dimension, n.cut = 0, 0
            continue
        widths = [(r[f"max{i}"] // _HASH) - (r[f"min{i}"] // _HASH) for i in range(dimensions)]
        n.dimension = max(range(dimensions), key=lambda i: (widths[i], -i))
        low, high = r[f"min{n.dimension}"], r[f"max{n.dimension}"]
        state[n.key] = [low, high, r["bytes"] * (n.leaves // 2) / n.leaves]  # range, bytes wanted to the left in it
    todo = [n for n in nodes if n.key in state]
    while todo:
        key = _pick(todo, lambda n: F.col(f"k{n.dimension}"))
        low = _pick(todo, lambda n: F.lit(state[n.key][0]))
        step = _pick(todo, lambda n: F.lit(max(1, -(-(state[n.key][1] - state[n.key][0] + 1) // CELLS))))
        high = _pick(todo, lambda n: F.lit(state[n.key][1]))
        cells = (
            rows.filter(F.col("node").isin([n.key for n in todo]))
            .select("node", "size", key.alias("key"), low.alias("low"), high.alias("high"), step.alias("step"))
            .filter("key BETWEEN low AND high")
            .groupBy("node", F.expr("(key - low) DIV step").alias("cell"))
            .agg(F.sum("size").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high"))
            .collect()  # at most CELLS rows a node
        )
        by_node: dict[int, list] = {}
        for c in cells:
            by_node.setdefault(c["node"], []).append(c)
        left = []
        for n in todo:
            want = state[n.key][2]
            for c in sorted(by_node[n.key], key=lambda c: c["cell"]):
                at = c
                if want < c["bytes"]:
                    break
                want -= c["bytes"]
            if at["low"] == at["high"] or at["bytes"] <= TOLERANCE * leaf_bytes:
                n.cut = at["low"] if 2 * want <= at["bytes"] else at["high"] + 1
            else:
                state[n.key] = [at["low"], at["high"], want]
                left.append(n)
        todo = left


def _with_slots(placed: DataFrame, rows: int) -> DataFrame:
    """Gapless numbers in each shard: hash parts of SLOT_ROWS rows, numbered side by side."""
    parts = max(4, -(-(rows or 0) // SLOT_ROWS))
    placed = placed.withColumn("part", F.pmod(F.hash("tie"), F.lit(parts)))
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "part").orderBy("tie", "id")
    numbered = placed.withColumn("at", F.row_number().over(within))
    return numbered.join(starts, ["shard", "part"]).withColumn("slot", F.col("start") + F.col("at") - 1)
