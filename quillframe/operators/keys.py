"""Row keys: numbering, conforming to a key list, composite keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, mul
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.ordering import Order, with_known_neighbours, with_position


def add_row_id(df: DataFrame, order_by: Order, name: str = "row_id") -> DataFrame:
    """Dense 0-based row number over the whole table (runs the counting job)."""
    return with_position(df, order_by, name)


def reindex(
    df: DataFrame,
    keys: DataFrame,
    on: Sequence[str],
    fill: Any = None,
    method: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """The rows of ``df`` for exactly the given keys.

    Missing keys give null, ``fill``, or with ``method`` ffill / bfill the value of
    the nearest earlier / later key present in ``df`` (within ``by``). The last column of ``on`` is the ordered one."""
    on = list(on)
    values = [c for c in df.columns if c not in on]
    present = "_present"
    joined = keys.select(*on).join(df.withColumn(present, F.struct(*values)).drop(*values), on, "left")
    if method is None:
        out = joined
    else:
        # Keys of df that are not asked for still serve as sources of a carried value.
        extra = df.join(keys.select(*on), on, "left_anti")
        extra = extra.select(*on, F.struct(*values).alias(present), F.lit(False).alias("_asked"))
        both = joined.withColumn("_asked", F.lit(True)).unionByName(extra)
        near = with_known_neighbours(both, by, on[-1], present, "_prev", "_next", "_row")
        source = "_prev" if method == "ffill" else "_next"
        out = near.filter("_asked").withColumn(present, F.col(f"{source}.value"))

    def value(name: str) -> Column:
        got = F.col(present)[name]
        if fill is None:
            return got
        return F.when(F.col(present).isNull(), F.lit(fill)).otherwise(got)

    return out.select(*on, *[value(c).alias(c) for c in values])


def reindex_like(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys and columns of ``other`` with the values of ``df``; absent ones are null."""
    on = list(on)
    shared = [c for c in df.columns if c in other.columns]
    joined = other.select(*on).join(df.select(*shared), on, "left")
    types = {f.name: f.dataType for f in other.schema.fields}
    return joined.select(
        *[F.col(c) if c in shared else F.lit(None).cast(types[c]).alias(c) for c in other.columns]
    )


def key_product(levels: Sequence[DataFrame]) -> DataFrame:
    """Every combination of the levels' distinct values.

    Each level is numbered; the product is then a range of numbers whose digits are
    looked up level by level with even equi-joins (one count per level is run)."""
    numbered, sizes = [], []
    for i, level in enumerate(levels):
        rows = with_position(level.distinct(), list(level.columns), f"_digit_{i}")
        numbered.append(rows)
        sizes.append(rows.count())
    spark = levels[0].sparkSession
    out = spark.range(reduce(mul, sizes, 1))
    step = 1
    for i in reversed(range(len(levels))):
        digit = F.pmod(F.floor(F.col("id") / F.lit(step)), F.lit(max(sizes[i], 1)))
        out = out.withColumn(f"_digit_{i}", digit.cast("long"))
        step *= max(sizes[i], 1)
    for i, rows in enumerate(numbered):
        out = out.join(rows, f"_digit_{i}").drop(f"_digit_{i}")
    return out.select(*[c for level in levels for c in level.columns])


def key_slice(df: DataFrame, levels: Sequence[str], lo: Sequence, hi: Sequence) -> DataFrame:
    """Lexicographic slice lo <= (levels) <= hi, both ends included; a bound may name
    only the leading levels."""
    low, high = (F.struct(*[F.lit(v) for v in bound]) for bound in (lo, hi))
    first = F.col(levels[0])  # implied by the slice, and simple enough to be pushed into the scan
    return df.filter(
        (first >= lo[0])
        & (first <= hi[0])
        & (F.struct(*levels[: len(lo)]) >= low)
        & (F.struct(*levels[: len(hi)]) <= high)
    )


def level_select(df: DataFrame, selectors: dict[str, set | list | tuple]) -> DataFrame:
    """An independent selector per level: a set or list of values, or a (lo, hi) range."""

    def one(name: str, chosen) -> Column:
        if isinstance(chosen, tuple):
            return F.col(name).between(*chosen)
        return F.col(name).isin(list(chosen))

    return df.filter(reduce(and_, [one(n, s) for n, s in selectors.items()]))
