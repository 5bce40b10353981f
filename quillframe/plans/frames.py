"""Statistics of sliding frames put together from partial results, so a frame's cost does not
depend on its length.

Rows are cut into blocks as long as the frame. A frame then is the end of one block and the
beginning of the next: both are running results inside a block, one step a row each. Nothing is
ever subtracted, so a huge value outside a frame leaves no trace in it.

Parts of a result: ``n`` known values, ``sum`` (in Spark's type for it), ``total`` (in double),
``min``, ``max``, ``mean_x`` and ``m2_x`` (mean and sum of squared differences from it), the same
of ``y``, and ``co`` (sum of products of differences).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from .groups import attach
from .ordering import POSITION, SEGMENT

Parts = dict[str, Column]

NEEDED = {
    "sum": ["sum"],
    "count": [],
    "mean": ["total"],
    "min": ["min"],
    "max": ["max"],
    "std": ["mean_x", "m2_x"],
    "var": ["mean_x", "m2_x"],
    "cov": ["mean_x", "mean_y", "co"],
    "corr": ["mean_x", "mean_y", "m2_x", "m2_y", "co"],
}


def parts_of(functions: Iterable[str], exact_mean: bool = False) -> list[str]:
    """The parts that the functions need; an ``exact_mean`` comes from ``sum`` and not ``total``."""
    wanted = dict.fromkeys(["n"])
    for f in functions:
        wanted |= dict.fromkeys(["sum"] if f == "mean" and exact_mean else NEEDED[f])
    return list(wanted)


def aggregates(parts: Iterable[str], x: Column, y: Column | None = None) -> Parts:
    """Each part as an aggregate; with ``y`` only rows where both are known count."""
    if y is not None:
        x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    double = {"x": x.cast("double"), "y": None if y is None else y.cast("double")}
    made = {
        "n": lambda: F.count(x),
        "sum": lambda: F.sum(x),
        "total": lambda: F.sum(double["x"]),
        "min": lambda: F.min(x),
        "max": lambda: F.max(x),
        "co": lambda: F.covar_pop(double["x"], double["y"]),
    }
    for v in ("x", "y"):
        made[f"mean_{v}"] = lambda v=v: F.avg(double[v])
        made[f"m2_{v}"] = lambda v=v: F.var_pop(double[v])
    return {p: made[p]() for p in parts}


def _scaled(parts: Parts) -> Parts:
    """Averages of squares and products, which Spark has, as sums, which can be merged."""
    return {p: c * parts["n"] if p == "co" or p.startswith("m2_") else c for p, c in parts.items()}


def running(parts: Iterable[str], frame: WindowSpec, x: Column, y: Column | None = None) -> Parts:
    return _scaled({p: a.over(frame) for p, a in aggregates(parts, x, y).items()})


def merged(a: Parts, b: Parts) -> Parts:
    """The parts of two sets of rows together; either may be null where it holds no rows."""
    a = {**a, "n": F.coalesce(a["n"], F.lit(0).cast("long"))}
    b = {**b, "n": F.coalesce(b["n"], F.lit(0).cast("long"))}
    n = a["n"] + b["n"]
    share = F.try_divide(b["n"].cast("double"), n.cast("double"))
    weight = a["n"] * share

    def one(p: str) -> Column:
        if p == "n":
            return n
        if p in ("min", "max"):
            return (F.least if p == "min" else F.greatest)(a[p], b[p])
        if p.startswith("mean_"):
            both = a[p] + (b[p] - a[p]) * share
        elif p in ("sum", "total"):
            both = a[p] + b[p]
        else:
            first, second = ("x", "y") if p == "co" else (p[-1], p[-1])
            gap = [b[f"mean_{v}"] - a[f"mean_{v}"] for v in (first, second)]
            both = a[p] + b[p] + gap[0] * gap[1] * weight
        # A side without known values has null means; its squares are zero or null.
        return F.when(a["n"] == 0, b[p]).when(b["n"] == 0, a[p]).otherwise(both)

    return {p: one(p) for p in a}


class Finish:
    """From parts to results of the type that Spark's own function gives."""

    def __init__(self, df: DataFrame, col: str, functions: Iterable[str]) -> None:
        own = {"sum": F.sum, "mean": F.avg}
        used = [f for f in own if f in set(functions)]
        schema = df.agg(*[own[f](col).alias(f) for f in used]).schema if used else []
        self.types = {f.name: f.dataType for f in schema}
        self.exact_mean = self.types.get("mean") is not None and self.types["mean"].typeName() != "double"

    def value(self, function: str, parts: Parts) -> Column:
        n = parts["n"]
        if function == "count":
            return n
        if function == "sum":
            return parts["sum"].cast(self.types["sum"])
        if function == "mean":
            return F.try_divide(parts["sum" if self.exact_mean else "total"], n).cast(self.types["mean"])
        if function in ("min", "max"):
            return parts[function]
        spread = F.when(n > 1, parts["co" if function in ("cov", "corr") else "m2_x"] / (n - 1))
        if function == "corr":
            scale = F.sqrt(parts["m2_x"] / (n - 1)) * F.sqrt(parts["m2_y"] / (n - 1))
            return F.when(n > 1, F.try_divide(spread, scale))
        return F.sqrt(spread) if function == "std" else spread


def packed(parts: Parts) -> Column:
    return F.struct(*[c.alias(p) for p, c in parts.items()])


def unpacked(column: str, parts: Iterable[str]) -> Parts:
    return {p: F.col(f"{column}.{p}") for p in parts}


_PLACE, _BLOCK, _LAST = "_place", "_frame_block", "_frame_last"
# What is asked of the frames: new column: its parts, x and, for pairs, y.
Asked = dict[str, tuple[list[str], Column, Column | None]]


def over_row_frames(rows: DataFrame, partition: list[str], window: WindowSpec, before: int, after: int, asked: Asked) -> DataFrame:
    """Adds columns of parts over ``before`` rows, the row itself and ``after`` rows.

    Blocks count from the first row of the partition, so of a frame cut off by the partition's
    start only the beginning of a block is left, and of one cut off by its end, if it begins
    inside the last block, only the block's end.
    """
    n = before + after + 1
    rows = rows.withColumn(_PLACE, F.row_number().over(window).cast("long") - 1)
    rows = rows.withColumn(_BLOCK, F.floor(F.col(_PLACE) / F.lit(n)).cast("long"))
    block = Window.partitionBy(*partition, _BLOCK)
    upto = (Window.unboundedPreceding, Window.currentRow)
    head, tail = (block.orderBy(c).rowsBetween(*upto) for c in (F.col(_PLACE).asc(), F.col(_PLACE).desc()))
    rows = rows.withColumns({f"_tail{out}": packed(running(parts, tail, x, y)) for out, (parts, x, y) in asked.items()})
    rows = rows.withColumns({f"_head{out}": packed(running(parts, head, x, y)) for out, (parts, x, y) in asked.items()})
    whole = Window.partitionBy(*partition).orderBy(_PLACE)
    start = F.col(_PLACE) - before
    moved = {f"_tail{out}": F.when(start % n != 0, F.lag(f"_tail{out}", before).over(whole)) for out in asked}
    if after:
        ends = F.struct(F.col(_PLACE).alias("place"), *[F.col(f"_head{out}").alias(out) for out in asked])
        last = F.last(ends).over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        moved[_LAST] = F.coalesce(F.lead(ends, after).over(whole), last)
    rows = rows.withColumns(moved)
    if after:
        same = F.floor(F.col(f"{_LAST}.place") / F.lit(n)) == F.floor(start / F.lit(n))
        inside = (start >= 0) & (start % n != 0) & same
        rows = rows.withColumns({f"_head{out}": F.when(~inside, F.col(f"{_LAST}.{out}")) for out in asked}).drop(_LAST)
    both = {out: packed(merged(unpacked(f"_tail{out}", parts), unpacked(f"_head{out}", parts))) for out, (parts, _, _) in asked.items()}
    return rows.withColumns(both).drop(_PLACE, _BLOCK, *[f"_{side}{out}" for side in ("head", "tail") for out in asked])


def with_carry(rows: DataFrame, by: list[str], parts: list[str], x: Column, out: str, reverse: bool = False) -> DataFrame:
    """Adds ``out``: the parts from the first row of the group (``reverse``: the last) to the row.

    Rows lie in segments (:mod:`ordering`); inside of one the result runs on row by row, and one
    row per segment carries it on. Squares are carried as differences from the first segment's
    mean, which is one of the values they stand for, so they lose no more digits than there are
    segments.
    """
    place = F.col(POSITION).desc() if reverse else F.col(POSITION).asc()
    inside = Window.partitionBy(SEGMENT, *by).orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn(out, packed(running(parts, inside, x)))
    totals = {p: a.alias(f"_t_{p}") for p, a in aggregates(parts, x).items()}
    summary = rows.groupBy(SEGMENT, *by).agg(*totals.values())
    summary = summary.withColumns({f"_t_{p}": c for p, c in _scaled({p: F.col(f"_t_{p}") for p in parts}).items()})
    key = F.col(SEGMENT).desc() if reverse else F.col(SEGMENT).asc()
    order = Window.partitionBy(*by).orderBy(key)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    carried: Parts = {"n": F.sum("_t_n").over(earlier)}
    for p in parts:
        if p in ("min", "max"):
            carried[p] = (F.min if p == "min" else F.max)(f"_t_{p}").over(earlier)
        elif p in ("sum", "total"):
            carried[p] = F.sum(f"_t_{p}").over(earlier)
    if "mean_x" in parts:
        everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        summary = summary.withColumn("_base", F.first("_t_mean_x", ignorenulls=True).over(everything))
        gap = F.col("_t_mean_x") - F.col("_base")
        moved = F.sum(F.col("_t_n") * gap).over(earlier)
        squares = F.sum(F.col("_t_m2_x") + F.col("_t_n") * gap * gap).over(earlier)
        carried["mean_x"] = F.col("_base") + F.try_divide(moved, carried["n"])
        carried["m2_x"] = F.greatest(squares - F.try_divide(moved * moved, carried["n"]), F.lit(0.0))
    summary = summary.select(SEGMENT, *by, packed({p: carried[p] for p in parts}).alias("_carried"))
    rows = attach(rows, summary, [SEGMENT, *by], null_safe=True)
    together = packed(merged(unpacked("_carried", parts), unpacked(out, parts)))
    return rows.withColumn(out, together).drop("_carried")
