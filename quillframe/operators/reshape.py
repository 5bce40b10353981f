"""Wide and long tables, cross tables, one-hot columns and codes.

In the wide forms every distinct value of a pivoted column becomes a column, so those values
must be few; when they are not given they are read by one query and checked against
``MAX_COLUMNS``. :func:`pivot_sparse` has no such bound.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.groups import as_list, attach, not_null, scalar_of
from ..plans.ordering import Order, key_names, with_position

MAX_COLUMNS = 10_000


def column_values(df: DataFrame, col: str) -> list:
    """Sorted distinct non-null values, refused when too many for columns (an action)."""
    found = df.select(col).filter(F.col(col).isNotNull()).distinct().limit(MAX_COLUMNS + 1)
    values = sorted(r[0] for r in found.collect())
    if len(values) > MAX_COLUMNS:
        raise ValueError(f"{col} has more than {MAX_COLUMNS} values; use pivot_sparse")
    return values


def pivot(df: DataFrame, index, columns: str, values: str, categories: Sequence | None = None) -> DataFrame:
    """Long to wide; two rows for one cell are an error, as there is nothing to choose by."""
    index = as_list(index)
    cells = df.groupBy(*index, columns)
    if not cells.agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty():
        raise ValueError("several rows for one cell; use pivot_table")
    categories = column_values(df, columns) if categories is None else list(categories)
    return df.groupBy(*index).pivot(columns, categories).agg(F.first(values))


_FUNCTIONS = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count}


def pivot_table(
    df: DataFrame,
    index,
    columns: str,
    values: str,
    aggfunc: str = "mean",
    fill_value: Any = None,
    categories: Sequence | None = None,
) -> DataFrame:
    """Long to wide with aggregation; cells without rows are null or ``fill_value``."""
    index = as_list(index)
    categories = column_values(df, columns) if categories is None else list(categories)
    wide = not_null(df, index).groupBy(*index).pivot(columns, categories).agg(_FUNCTIONS[aggfunc](values))
    return wide if fill_value is None else wide.na.fill(fill_value, [str(c) for c in categories])


def pivot_sparse(
    df: DataFrame, index, columns: str, values: str, aggfunc: str = "mean", block: int | None = None
) -> DataFrame:
    """:func:`pivot_table` over any number of values: index, ``labels`` and ``cells``.

    Both are arrays, ascending by label, that hold the cells with rows only (a cell of nulls
    is a null); null labels make no cell. No value is known when the plan is built. With
    ``block``, for index values that have more cells than a row should hold, a row has the
    labels of one hash block out of ``block`` and their number in ``block``."""
    index = as_list(index)
    cells = not_null(df, [*index, columns]).groupBy(*index, columns).agg(_FUNCTIONS[aggfunc](values).alias("_v"))
    keys = list(index)
    if block is not None:
        cells = cells.withColumn("block", F.pmod(F.xxhash64(columns), F.lit(block)))
        keys.append("block")
    entries = F.array_sort(F.collect_list(F.struct(F.col(columns).alias("label"), F.col("_v").alias("cell"))))
    rows = cells.groupBy(*keys).agg(entries.alias("_e"))
    return rows.select(*keys, F.col("_e.label").alias("labels"), F.col("_e.cell").alias("cells"))


def sparse_columns(sparse: DataFrame, categories: Sequence, fill_value: Any = None) -> DataFrame:
    """The wide form of :func:`pivot_sparse` for the given categories only."""
    keys = [c for c in sparse.columns if c not in ("labels", "cells")]

    def cell(c: Any) -> Column:
        at = F.array_position("labels", F.lit(c)).cast("int")
        value = F.when(at > 0, F.get("cells", at - 1))
        return (value if fill_value is None else F.coalesce(value, F.lit(fill_value))).alias(str(c))

    return sparse.select(*keys, *[cell(c) for c in categories])


def pivot_table_margins(
    df: DataFrame,
    index: str,
    columns: str,
    values: str,
    aggfunc: str = "sum",
    margin: str = "All",
    categories: Sequence | None = None,
) -> DataFrame:
    """:func:`pivot_table` with an extra row and column over everything.

    One cube pass gives cells, row totals, column totals and the grand total."""
    categories = column_values(df, columns) if categories is None else list(categories)
    cube = (
        not_null(df, [index, columns])
        .cube(index, columns)
        .agg(_FUNCTIONS[aggfunc](values).alias("_v"), F.grouping(index).alias("_gi"), F.grouping(columns).alias("_gc"))
        .select(
            F.when(F.col("_gi") == 1, margin).otherwise(F.col(index).cast("string")).alias(index),
            F.when(F.col("_gc") == 1, margin).otherwise(F.col(columns).cast("string")).alias("_c"),
            "_v",
        )
    )
    return cube.groupBy(index).pivot("_c", [*[str(c) for c in categories], margin]).agg(F.first("_v"))


def crosstab(
    df: DataFrame,
    a: str,
    b: str,
    values: str | None = None,
    aggfunc: str = "count",
    categories: Sequence | None = None,
) -> DataFrame:
    """Frequencies of value pairs (0 where none), or an aggregate of ``values``."""
    categories = column_values(df, b) if categories is None else list(categories)
    wide = not_null(df, [a, b]).groupBy(a).pivot(b, categories)
    if values is None:
        return wide.agg(F.count(F.lit(1))).na.fill(0)
    return wide.agg(_FUNCTIONS[aggfunc](values))


def crosstab_share(df: DataFrame, a: str, b: str, normalize: str, categories: Sequence | None = None) -> DataFrame:
    """Shares of the total (all), of the row (index) or of the column (columns)."""
    categories = column_values(df, b) if categories is None else list(categories)
    known = not_null(df, [a, b])
    counts = known.groupBy(a, b).agg(F.count(F.lit(1)).alias("_n"))
    if normalize == "all":
        shares = counts.withColumn("_s", F.col("_n") / scalar_of(known, F.count(F.lit(1))))
    else:
        side = a if normalize == "index" else b
        totals = known.groupBy(side).agg(F.count(F.lit(1)).alias("_t"))
        shares = counts.join(totals, side).withColumn("_s", F.col("_n") / F.col("_t"))
    return shares.groupBy(a).pivot(b, categories).agg(F.first("_s")).na.fill(0.0)


def melt(
    df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str], var_name="variable", value_name="value"
) -> DataFrame:
    """Wide to long: one row per id and value column, nulls kept."""
    return df.unpivot(list(id_vars), list(value_vars), var_name, value_name)


def stack(df: DataFrame, keys: Sequence[str], level: str = "level", value: str = "value") -> DataFrame:
    """Columns moved into an inner key level; nulls disappear."""
    cols = [c for c in df.columns if c not in keys]
    return df.unpivot(list(keys), cols, level, value).filter(F.col(value).isNotNull())


def unstack(df: DataFrame, keys, level: str, value: str, fill: Any = None, categories=None) -> DataFrame:
    """A key level moved into columns; cells without a row are null or ``fill``."""
    wide = pivot(df, keys, level, value, categories)
    return wide if fill is None else wide.na.fill(fill)


def dummies(
    df: DataFrame, col: str, prefix: str | None = None, drop_first: bool = False, categories=None
) -> DataFrame:
    """One 0/1 column per category in place of the column; null gives all zeros."""
    categories = column_values(df, col) if categories is None else list(categories)
    prefix = col if prefix is None else prefix
    shown = categories[1:] if drop_first else categories
    hot = {f"{prefix}_{c}": F.coalesce(F.col(col) == F.lit(c), F.lit(False)).cast("int") for c in shown}
    return df.withColumns(hot).drop(col)


def factorize(df: DataFrame, col: str, order_by: Order, out: str = "code") -> tuple[DataFrame, DataFrame]:
    """Codes by first appearance (null: -1) and the table (value, code).

    First appearances come from one partial aggregation; numbering the values uses
    the distributed row number, so the value list may be long."""
    first = F.min(F.struct(*key_names(order_by))).alias("_first")
    seen = not_null(df, [col]).groupBy(col).agg(first)
    table = with_position(seen, "_first", out).select(col, out)
    return attach(df, table, [col]).na.fill(-1, [out]), table
