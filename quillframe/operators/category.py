"""Categories and labels.

A category column is text plus a small table of its categories; the order of the
categories is their rank in that table. Category lists are given by the caller and
travel with the plan as literals, codes learnt from data are joined."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import compare
from ..plans.groups import attach, not_null, scalar_of
from ..plans.ordering import with_position
from .select import mapped


@dataclass(frozen=True)
class Categories:
    """An ordered or unordered list of category values."""

    values: tuple
    ordered: bool = False

    def code(self, col: Column) -> Column:
        """0-based rank; null for null and unknown values."""
        return mapped(col, {v: i for i, v in enumerate(self.values)}).cast("int")

    def known(self, col: Column) -> Column:
        return F.when(col.isin(list(self.values)), col)

    def table(self, df: DataFrame, col: str) -> DataFrame:
        """(value, code) as a DataFrame."""
        kind = df.schema[col].dataType
        rows = [F.struct(F.lit(v).cast(kind).alias(col), F.lit(i).alias("code")) for i, v in enumerate(self.values)]
        return df.sparkSession.range(1).select(F.inline(F.array(*rows)))

    def add(self, *values) -> Categories:
        return replace(self, values=self.values + tuple(v for v in values if v not in self.values))

    def remove(self, *values) -> Categories:
        return replace(self, values=tuple(v for v in self.values if v not in values))

    def set(self, *values) -> Categories:
        return replace(self, values=tuple(values))

    def rename(self, names: dict) -> Categories:
        return replace(self, values=tuple(names.get(v, v) for v in self.values))

    def reorder(self, *values) -> Categories:
        if set(values) != set(self.values):
            raise ValueError("reorder needs the same categories")
        return Categories(tuple(values), ordered=True)


def to_category(df: DataFrame, col: str, categories: Categories) -> DataFrame:
    """Values outside the list become null."""
    return df.withColumn(col, categories.known(F.col(col)))


def add_categories(df: DataFrame, col: str, categories: Categories, *values) -> tuple[DataFrame, Categories]:
    return df, categories.add(*values)


def remove_categories(df: DataFrame, col: str, categories: Categories, *values) -> tuple[DataFrame, Categories]:
    """Rows of a removed category become null."""
    left = categories.remove(*values)
    return to_category(df, col, left), left


def set_categories(df: DataFrame, col: str, categories: Categories, *values) -> tuple[DataFrame, Categories]:
    new = categories.set(*values)
    return to_category(df, col, new), new


def rename_categories(df: DataFrame, col: str, categories: Categories, names: dict) -> tuple[DataFrame, Categories]:
    renamed = F.coalesce(mapped(F.col(col), names), F.col(col))
    return df.withColumn(col, renamed), categories.rename(names)


def drop_unused(df: DataFrame, col: str, categories: Categories) -> tuple[DataFrame, Categories]:
    """Categories no row uses are removed (one grouped query over at most the list)."""
    used = {r[0] for r in to_category(df, col, categories).select(col).distinct().collect()}
    return df, replace(categories, values=tuple(v for v in categories.values if v in used))


def category_info(df: DataFrame, col: str, categories: Categories) -> DataFrame:
    """Every category with its code and count, empty ones included."""
    counts = to_category(df, col, categories).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return categories.table(df, col).join(counts, col, "left").na.fill(0, ["n"])


def order_category(df: DataFrame, col: str, categories: Categories, out: str = "rank") -> DataFrame:
    """Adds the rank of each row's category."""
    return df.withColumn(out, categories.code(F.col(col)))


def sort_category(df: DataFrame, col: str, categories: Categories, ties: Sequence[str]) -> DataFrame:
    """Rows in category order, unknown values last."""
    return df.orderBy(categories.code(F.col(col)).asc_nulls_last(), *ties)


def compare_category(
    df: DataFrame, col: str, op: str, other, categories: Categories, out: str
) -> DataFrame:
    """Rank comparison with a category value or with another column of the same list.

    Order comparisons need ordered categories; an unknown value on either side
    compares as false (and as true under !=)."""
    if op not in ("==", "!=") and not categories.ordered:
        raise TypeError("unordered categories only compare with == and !=")
    if not isinstance(other, Column):
        if other not in categories.values:
            if op in ("==", "!="):
                return df.withColumn(out, F.lit(op == "!="))
            raise TypeError(f"{other!r} is not a category")
        right = F.lit(categories.values.index(other))
    else:
        right = categories.code(other)
    result = compare(op, categories.code(F.col(col)), right)
    return df.withColumn(out, F.coalesce(result, F.lit(op == "!=")))


def compare_categories(
    df: DataFrame, a: str, b: str, op: str, categories_a: Categories, categories_b: Categories, out: str
) -> DataFrame:
    """Two category columns; their lists must be equal (in order too, when ordered)."""
    same = (
        categories_a == categories_b
        if categories_a.ordered
        else set(categories_a.values) == set(categories_b.values)
    )
    if not same:
        raise TypeError("categories differ")
    return compare_category(df, a, op, F.col(b), categories_a, out)


def cut(
    df: DataFrame, col: str, edges: Sequence[float], out: str, labels: Sequence[str] | None = None, right: bool = True
) -> DataFrame:
    """Bin values into intervals; outside all of them is null."""
    x = F.col(col)
    result: Column | None = None
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        inside = (x > lo) & (x <= hi) if right else (x >= lo) & (x < hi)
        text = f"({lo:g}, {hi:g}]" if right else f"[{lo:g}, {hi:g})"
        label = F.lit(labels[i] if labels else text)
        result = F.when(inside, label) if result is None else result.when(inside, label)
    return df.withColumn(out, result)


def label_encode_sorted(df: DataFrame, col: str, out: str) -> DataFrame:
    """Codes from the sorted distinct values (numbered without a single-task sort)."""
    values = not_null(df, [col]).select(col).distinct()
    return attach(df, with_position(values, col, out), [col])


def label_encode_map(df: DataFrame, col: str, mapping: dict, out: str) -> DataFrame:
    """Codes from a given mapping; unlisted values give null."""
    return df.withColumn(out, mapped(F.col(col), mapping))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and the weight rows / (classes * class rows)."""
    counts = not_null(df, [label]).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    per_class = scalar_of(counts, F.sum("n") / F.count(F.lit(1)))
    return counts.withColumn("weight", per_class / F.col("n"))
