"""Projections, filters and element-wise operations."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import numeric
from ..plans.ordering import Order, sort_columns, with_position

# Up to this many leading rows a top-k plan (heap per task, one small merge) is used.
TOP_K_ROWS = 100_000


def select_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def select_positions(df: DataFrame, idx: Sequence[int]) -> DataFrame:
    """Columns by 0-based position; negative positions count from the end."""
    return df.select(*[df.columns[i] for i in idx])


def loc_range(df: DataFrame, key: str, lo, hi) -> DataFrame:
    """Rows with lo <= key <= hi, both ends included; None leaves a side open."""
    if lo is not None:
        df = df.filter(F.col(key) >= lo)
    if hi is not None:
        df = df.filter(F.col(key) <= hi)
    return df


def iloc_range(df: DataFrame, order_by: Order, start: int, stop: int) -> DataFrame:
    """Rows at positions start <= p < stop of the given order."""
    if stop <= TOP_K_ROWS:
        return df.orderBy(*sort_columns(order_by)).offset(start).limit(max(stop - start, 0))
    p = F.col("_at")
    return with_position(df, order_by, "_at").filter((p >= start) & (p < stop)).drop("_at")


def filter_where(df: DataFrame, cond: Column) -> DataFrame:
    """Rows where the condition is true (unknown counts as false)."""
    return df.filter(cond)


def query(df: DataFrame, expr: str) -> DataFrame:
    """Rows where the expression text is true."""
    return df.filter(F.expr(expr))


def where(df: DataFrame, cond: Column, cols: Sequence[str], other: Any = None) -> DataFrame:
    """Keep values where the condition holds, elsewhere put ``other`` (default null)."""
    alternative = other if isinstance(other, Column) else F.lit(other)
    return df.withColumns({c: F.when(cond, F.col(c)).otherwise(alternative) for c in cols})


def mask(df: DataFrame, cond: Column, cols: Sequence[str], other: Any = None) -> DataFrame:
    """Replace values where the condition holds; an unknown condition replaces nothing."""
    return where(df, ~F.coalesce(cond, F.lit(False)), cols, other)


def assign(df: DataFrame, **cols: Column) -> DataFrame:
    """Add or overwrite columns, all computed from the input columns."""
    return df.withColumns(cols)


def rename_cols(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def mapped(col: Column, mapping: dict) -> Column:
    """Value looked up in the mapping, null when it is not listed."""
    out: Column | None = None
    for old, new in mapping.items():
        hit = col.isNull() if old is None else col == F.lit(old)
        out = F.when(hit, F.lit(new)) if out is None else out.when(hit, F.lit(new))
    return F.lit(None) if out is None else out


def replace_values(df: DataFrame, mapping: dict[str, dict]) -> DataFrame:
    """Per-column value replacement; values that are not listed stay.

    When the new values have another type the column takes that type; an unlisted value
    that cannot be read as it is an error, never a null."""
    changed = {}
    for name, values in mapping.items():
        new_type = df.sparkSession.range(0).select(mapped(F.lit(None), values)).schema[0].dataType
        old = F.col(name)
        if new_type != df.schema[name].dataType:
            unread = F.concat(F.lit(f"{name} holds a value that is not listed and is no {new_type.simpleString()}: "), old.cast("string"))
            old = F.when(old.isNull() | old.try_cast(new_type).isNotNull(), old.try_cast(new_type)).otherwise(F.raise_error(unread))
        hit = F.col(name).isin([k for k in values if k is not None])
        if None in values:
            hit = hit | F.col(name).isNull()
        changed[name] = F.when(hit, mapped(F.col(name), values)).otherwise(old)
    return df.withColumns(changed)


def clip(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    return df.withColumn(col, numeric.bounded(F.col(col), lo, hi))


def row_apply(
    df: DataFrame,
    out: str,
    fn: Callable[..., Any],
    cols: Sequence[str],
    returns: T.DataType | str | None = None,
) -> DataFrame:
    """A new column computed from each row.

    ``fn`` maps columns to a column and stays inside the JVM; when ``returns`` is
    given it maps pandas Series to a Series and runs on Arrow batches."""
    inputs = [F.col(c) for c in cols]
    if returns is None:
        return df.withColumn(out, fn(*inputs))

    def batched(*series: pd.Series) -> pd.Series:
        return fn(*series)

    return df.withColumn(out, F.pandas_udf(batched, returnType=returns)(*inputs))


def log_transform(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, numeric.natural_log(F.col(col)))


def align_arith(
    left: DataFrame, right: DataFrame, key: Sequence[str], op: str, cols: Sequence[str], fill=None
) -> DataFrame:
    """Arithmetic on rows of equal key; ``fill`` stands in for a missing operand.

    A key on one side only gives null unless ``fill`` is set."""
    keys = list(key)
    other = right.select(*keys, *[F.col(c).alias(f"_right_{c}") for c in cols])

    def operand(name: str) -> Column:
        return F.col(name) if fill is None else F.coalesce(name, F.lit(fill))

    values = [numeric.arithmetic(op, operand(c), operand(f"_right_{c}")).alias(c) for c in cols]
    return left.select(*keys, *cols).join(other, keys, "full").select(*keys, *values)
