"""Sorting, limits, duplicates, sampling, stacking tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.groups import as_list, attach, scalar_of
from ..plans.ordering import Key, Order, as_keys, sort_columns, with_position
from .select import TOP_K_ROWS


def sort_values(df: DataFrame, order_by: Order, na_position: str = "last") -> DataFrame:
    """Rows sorted by several keys; a range shuffle, each task sorts its own range."""
    return df.orderBy(*_placed_nulls(order_by, na_position))


def _placed_nulls(order_by: Order, na_position: str) -> list[Column]:
    if na_position == "last":
        return sort_columns(order_by)
    return [
        F.col(n).desc_nulls_first() if descending else F.col(n).asc_nulls_first()
        for n, descending in as_keys(order_by)
    ]


def sort_rank(df: DataFrame, order_by: Order, name: str = "rank") -> DataFrame:
    """The 1-based place of every row in the sorted table."""
    return with_position(df, order_by, name).withColumn(name, F.col(name) + 1)


def sort_key(df: DataFrame, keys: Sequence[str], ascending: bool = True) -> DataFrame:
    return df.orderBy(*sort_columns([(k, "asc" if ascending else "desc") for k in as_list(keys)]))


def head(df: DataFrame, n: int, order_by: Order) -> DataFrame:
    """First n rows; more of them than one task should merge are picked by their place."""
    if n <= TOP_K_ROWS:
        return df.orderBy(*sort_columns(order_by)).limit(n)
    return with_position(df, order_by, "_at").filter(F.col("_at") < n).drop("_at")


def tail(df: DataFrame, n: int, order_by: Order) -> DataFrame:
    """Last n rows: the first n of the reversed order."""
    if n <= TOP_K_ROWS:
        return df.orderBy(*sort_columns(order_by, reverse=True)).limit(n)
    placed = with_position(df, order_by, "_at")
    return placed.filter(F.col("_at") >= scalar_of(df, F.count(F.lit(1))) - n).drop("_at")


def nlargest(df: DataFrame, n: int, col: str, ties: Sequence[Key] = ()) -> DataFrame:
    """n rows of largest value, ties by the given order; nulls never count."""
    return head(df.filter(F.col(col).isNotNull()), n, [(col, "desc"), *ties])


def nsmallest(df: DataFrame, n: int, col: str, ties: Sequence[Key] = ()) -> DataFrame:
    return head(df.filter(F.col(col).isNotNull()), n, [col, *ties])


def duplicated(
    df: DataFrame, subset: Sequence[str], order_by: Sequence[str], keep: str | None = "first", name: str = "duplicated"
) -> DataFrame:
    """Flags repeats (nulls are equal); keep first, last or None (all are repeats).

    Only the count and the outermost row's key of each group are aggregated and
    joined back, so many copies of one row do not meet in one task."""
    subset = list(subset)
    place = F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)  # a lone key hashes
    edge = {"first": F.min, "last": F.max}[keep or "first"](place)
    marks = df.groupBy(*subset).agg(edge.alias("_kept"), F.count(F.lit(1)).alias("_copies"))
    repeat = F.col("_copies") > 1 if keep is None else place != F.col("_kept")
    return attach(df, marks, subset, null_safe=True).withColumn(name, repeat).drop("_kept", "_copies")


def drop_duplicates(
    df: DataFrame, subset: Sequence[str] | None, order_by: Order, keep: str | None = "first"
) -> DataFrame:
    """One chosen row per distinct subset; with keep=None only rows without a copy.

    Keeping first or last asks for row 1 of a group, so every task sends at most one
    row per group to the shuffle, however many copies there are. The hash in front of
    the subset settles most comparisons of long texts by one number."""
    subset = list(subset or df.columns)
    if keep is None:
        single = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_copies")).filter("_copies = 1")
        return attach(df, single, subset, null_safe=True, how="inner").drop("_copies")
    hashed = df.withColumn("_hash", F.xxhash64(*subset))
    window = Window.partitionBy("_hash", *subset).orderBy(*sort_columns(order_by, reverse=keep == "last"))
    return hashed.withColumn("_copy", F.row_number().over(window)).filter("_copy = 1").drop("_copy", "_hash")


def _uniform(seed: int, key: Sequence[str], salt: str = "") -> Column:
    """A repeatable number in (0, 1) from the seed and the row's key."""
    text = F.concat_ws(":", F.lit(f"{seed}{salt}"), *[F.col(k).cast("string") for k in key])
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / F.lit(2.0**48)


def sample(
    df: DataFrame,
    key: Sequence[str],
    n: int | None = None,
    frac: float | None = None,
    replace: bool = False,
    seed: int = 0,
) -> DataFrame:
    """Exactly n rows (or round(frac * rows)) chosen by a hash of seed and key.

    The choice depends on the data only, not on how it is partitioned. Without
    ``replace`` these are the rows of smallest hash; with it, every draw looks up a
    row number."""
    key = as_list(key)
    if n is None or replace:
        rows = df.count()
        n = round(frac * rows) if n is None else n
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    if replace:
        placed = with_position(df, key, "_at")
        draws = df.sparkSession.range(n).select(
            F.floor(_uniform(seed, ["id"], "draw") * F.lit(rows)).cast("long").alias("_at")
        )
        return draws.join(placed, "_at").drop("_at")
    hashed = df.withColumn("_hash", F.md5(text))
    order = ["_hash", *key]
    if n <= TOP_K_ROWS:
        return head(hashed, n, order).drop("_hash")
    return with_position(hashed, order, "_at").filter(F.col("_at") < n).drop("_at", "_hash")


def sample_fraction(df: DataFrame, frac: float, replace: bool = False, seed: int = 0) -> DataFrame:
    """About frac * rows random rows, decided row by row without any shuffle."""
    return df.sample(withReplacement=replace, fraction=frac, seed=seed)


def sample_weighted(df: DataFrame, key: Sequence[str], n: int, weight: str, seed: int = 0) -> DataFrame:
    """n rows without replacement, chances proportional to weight.

    The n largest ln(u) / weight with u uniform per row (Efraimidis and Spirakis);
    rows of zero or null weight are never drawn."""
    key = as_list(key)
    scored = df.filter(F.col(weight) > 0).withColumn("_score", F.ln(_uniform(seed, key)) / F.col(weight))
    order = [("_score", "desc"), *key]
    if n <= TOP_K_ROWS:
        return head(scored, n, order).drop("_score")
    return with_position(scored, order, "_at").filter(F.col("_at") < n).drop("_at", "_score")


def append(df: DataFrame, other: DataFrame) -> DataFrame:
    """Rows of both tables, columns matched by name, absent ones null."""
    return df.unionByName(other, allowMissingColumns=True)


def concat(tables: dict[str, DataFrame] | Sequence[DataFrame], join: str = "outer", label: str | None = None) -> DataFrame:
    """Rows of several tables with the union or the intersection of their columns;
    ``label`` names a column telling the source."""
    named = tables if isinstance(tables, dict) else {str(i): t for i, t in enumerate(tables)}
    frames = list(named.items())
    if join == "inner":
        common = [c for c in frames[0][1].columns if all(c in t.columns for _, t in frames)]
        frames = [(k, t.select(*common)) for k, t in frames]
    if label:
        frames = [(k, t.withColumn(label, F.lit(k))) for k, t in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t for _, t in frames])


def concat_columns(tables: Sequence[DataFrame], key: Sequence[str], join: str = "outer") -> DataFrame:
    """Tables side by side on a unique key."""
    how = "full" if join == "outer" else "inner"
    return reduce(lambda a, b: a.join(b, as_list(key), how), tables)
