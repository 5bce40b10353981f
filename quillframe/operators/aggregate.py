"""Whole-table and grouped aggregation.

Aggregates skip nulls, null keys form no group, and group statistics are joined
back to rows instead of being computed in a window, so that partial sums are taken
before any shuffle and one hot group never has to fit into a single task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


from ..plans.groups import as_list, attach, largest_group, not_null, scalar_of
from ..plans.ordering import Order, sort_columns, with_group_position
from ..plans.quantiles import group_quantiles, quantile_name
from .mergeable import FAN_IN, Mergeable, group_merged

# Spark keeps only the first n rows per group before the shuffle up to this n.
GROUP_LIMIT_ROWS = 1000


def unique(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def nunique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column: (column, n_unique)."""
    counts = df.agg(*[F.count_distinct(c).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column", "n_unique")


def count_non_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Non-null values per column: (column, n)."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count(c).alias(c) for c in cols]).unpivot([], cols, "column", "n")


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Frequency of each non-null value, descending, with ``normalize`` also its share."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        counts = counts.withColumn("share", F.col("n") / scalar_of(df, F.count(col)))
    return counts.orderBy(F.desc("n"), col)


_DESCRIBED = [0.25, 0.5, 0.75]


def describe_numeric(df: DataFrame, cols: Sequence[str], by=None) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column (and group).

    All columns share one aggregation for the plain statistics; quartiles are found
    column by column."""
    by = as_list(by)
    df = not_null(df, by)
    wanted = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    basic = df.groupBy(*by).agg(*[f(c).alias(f"{c}_{n}") for c in cols for n, f in wanted.items()])
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}_n").alias("n"),
            *[F.col(f"{c}_{n}").cast("double").alias(n) for n in ("mean", "std", "min", "max")],
        )
        for c in cols
    ]
    table = basic.select(*by, F.inline(F.array(*entries)))
    names = [quantile_name(q) for q in _DESCRIBED]
    quartiles = reduce(
        DataFrame.unionByName,
        [group_quantiles(df, by, c, _DESCRIBED).withColumn("column", F.lit(c)) for c in cols],
    )
    return table.join(quartiles, [*by, "column"], "left").select(
        *by, "column", "n", "mean", "std", "min", *names, "max"
    )


def describe_text(df: DataFrame, col: str) -> DataFrame:
    """count, unique, the most frequent value (smallest on ties) and its frequency."""
    counts = value_counts(df, col)
    top = F.min_by(F.col(col), F.struct(-F.col("n"), F.col(col)))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("count"),
        F.count(col).alias("unique"),
        top.alias("top"),
        F.max("n").alias("freq"),
    )


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, non-null and null count, from one aggregation."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    known = df.agg(*[F.count(c).alias(c) for c in df.columns], F.count(F.lit(1)).alias("_rows"))
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("dtype"),
            F.col(c).alias("non_null"),
            (F.col("_rows") - F.col(c)).alias("nulls"),
        )
        for c in df.columns
    ]
    return known.select(F.inline(F.array(*entries)))


def idxmax(df: DataFrame, col: str, key: str, order_by: str, by=None) -> DataFrame:
    """Key of the largest value, the first in order on ties."""
    return _extreme(df, col, key, order_by, by, "idxmax", -1)


def idxmin(df: DataFrame, col: str, key: str, order_by: str, by=None) -> DataFrame:
    """Key of the smallest value, the first in order on ties."""
    return _extreme(df, col, key, order_by, by, "idxmin", 1)


def _extreme(df, col, key, order_by, by, name, sign):
    by, known = as_list(by), not_null(df, as_list(by))
    hit = F.struct(F.col(key).alias("key"), F.col(col).alias("value"))
    if sign > 0 or isinstance(df.schema[col].dataType, T.NumericType):
        value = F.col(col) if sign > 0 else -F.col(col)
        rank = F.when(F.col(col).isNotNull(), F.struct(value, F.col(order_by)))
        out = known.groupBy(*by).agg(F.min_by(hit, rank).alias("_hit"))
    else:  # dates, times and text have no negative: the largest first, then its first row
        best = known.groupBy(*by).agg(F.max(col).alias("_best"))
        rows = attach(known.withColumn("_all", F.lit(0)), best.withColumn("_all", F.lit(0)), [*by, "_all"])
        rank = F.when(F.col(col) == F.col("_best"), F.struct(order_by))
        out = rows.groupBy(*by).agg(F.min_by(hit, rank).alias("_hit"))
    return out.select(*by, F.col("_hit.key").alias(name), F.col("_hit.value").alias("value"))


def _named(function: str, col: str, order: Column | None) -> Column:
    simple = {
        "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
        "mean": F.avg,
        "min": F.min,
        "max": F.max,
        "count": F.count,
        "nunique": F.count_distinct,
        "size": lambda c: F.count(F.lit(1)),
        "std": F.stddev_samp,
        "var": F.var_samp,
    }
    if function in simple:
        return simple[function](col)
    if order is None:
        raise ValueError(f"{function} needs order_by")
    known = F.when(F.col(col).isNotNull(), order)
    return {"first": F.min_by, "last": F.max_by}[function](F.col(col), known)


def group_agg(
    df: DataFrame, by, spec: dict[str, Sequence[str]], order_by: Sequence[str] | None = None
) -> DataFrame:
    """Several statistics per column, named column_function.

    Functions: sum, mean, min, max, count, size, nunique, std, var, median, first
    and last (the latter two need ``order_by``). Plain sums take one hash aggregation.
    Distinct counts, first / last (which sort) and medians would drag all other
    columns through their wider plans, so each of these kinds reads only its own
    columns and is joined on the group keys."""
    by = as_list(by)
    df = not_null(df, by)
    order = F.struct(*order_by) if order_by else None
    wanted = [(c, f) for c, fs in spec.items() for f in fs]
    kinds: dict[str, list[Column]] = {}
    for c, f in wanted:
        if f != "median":
            kind = f if f == "nunique" else "edge" if f in ("first", "last") else "plain"
            kinds.setdefault(kind, []).append(_named(f, c, order).alias(f"{c}_{f}"))
    tables = [df.groupBy(*by).agg(*columns) for columns in kinds.values()]
    for c in [c for c, f in wanted if f == "median"]:
        medians = group_quantiles(df, by, c, [0.5])
        tables.append(medians.withColumnRenamed(quantile_name(0.5), f"{c}_median"))
    if not by:  # one row each
        tables = [t.withColumn("_all", F.lit(0)) for t in tables]
    out = reduce(lambda a, b: a.join(b, by or ["_all"], "full"), tables)
    return out.select(*by, *[f"{c}_{f}" for c, f in wanted])


def group_by_expr(df: DataFrame, key: Column, name: str, aggs: Sequence[Column]) -> DataFrame:
    """Groups by a computed key; rows where it is null are dropped."""
    return not_null(df.withColumn(name, key), [name]).groupBy(name).agg(*aggs)


def group_nth(df: DataFrame, by, n: int, order_by: Order, head: bool = False) -> DataFrame:
    """Row number n (0-based) of each group, or with ``head`` its first n rows."""
    by = as_list(by)
    df = not_null(df, by)
    last = n if head else n + 1
    if last <= GROUP_LIMIT_ROWS:  # only the leading rows of a group are shuffled
        window = Window.partitionBy(*by).orderBy(*sort_columns(order_by))
        placed = df.withColumn("_at", F.row_number().over(window)).filter(F.col("_at") <= last)
        placed = placed.withColumn("_at", F.col("_at") - 1)
    else:
        placed = with_group_position(df, by, order_by, "_at")
    keep = F.col("_at") < n if head else F.col("_at") == n
    return placed.filter(keep).drop("_at")


def group_filter(df: DataFrame, by, cond: Column) -> DataFrame:
    """All rows of the groups for which the aggregate condition holds."""
    by = as_list(by)
    kept = not_null(df, by).groupBy(*by).agg(cond.alias("_keep")).filter("_keep").select(*by)
    return df.join(kept, by, "left_semi")


def group_transform(df: DataFrame, by, col: str, wanted: dict[str, str]) -> DataFrame:
    """Group statistics carried back to the rows in one pass and one join.

    ``wanted`` maps new (or existing) names to mean, sum, demean, zscore or fill_mean;
    rows without a key get null."""
    by = as_list(by)
    stats = (
        not_null(df, by)
        .groupBy(*by)
        .agg(F.avg(col).alias("_mean"), F.sum(col).alias("_sum"), F.stddev_samp(col).alias("_std"))
    )
    x, mean = F.col(col), F.col("_mean")
    values = {
        "mean": mean,
        "sum": F.col("_sum"),
        "demean": x - mean,
        "zscore": F.try_divide(x - mean, F.col("_std")),
        "fill_mean": F.coalesce(x, mean),
    }
    joined = attach(df, stats, by).withColumns({out: values[how] for out, how in wanted.items()})
    return joined.select(*df.columns, *[out for out in wanted if out not in df.columns])


def group_custom(
    df: DataFrame, by, wanted: dict[str, tuple[Callable[[pd.Series], float] | Mergeable, str]], largest: int = 1_000_000
) -> DataFrame:
    """Own aggregate functions: new name -> (function of a Series to a number, column).

    A :class:`Mergeable` function takes groups of any size. A plain one sees a group's values
    at once, so groups above ``largest`` rows are refused; :func:`group_apply` with ``merge``
    works on slices of them. All functions of a call are of one sort."""
    by = as_list(by)
    parts = [isinstance(fn, Mergeable) for fn, _ in wanted.values()]
    if any(parts):
        if not all(parts):
            raise ValueError("mergeable and plain functions take calls of their own")
        return group_merged(df, by, wanted)
    df = not_null(df, by)
    top = largest_group(df, by)
    if top > largest:
        raise ValueError(f"a group has {top} rows; use group_apply with merge=")

    def aggregate_of(fn: Callable[[pd.Series], float], col: str) -> Column:
        def over(values: pd.Series) -> float:
            return float(fn(values))

        return F.pandas_udf(over, T.DoubleType())(F.col(col).cast("double"))

    return _spread(df, by).groupBy(*by).agg(*[aggregate_of(fn, c).alias(n) for n, (fn, c) in wanted.items()])


def group_apply(
    df: DataFrame,
    by,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    merge: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
    slice_key: str | None = None,
    slice_rows: int = 100_000,
    largest: int = 1_000_000,
) -> DataFrame:
    """Any table-to-table function of a group (null keys are dropped).

    A function that must see a whole group can only run where the group fits into
    one worker; a group above ``largest`` rows is refused instead of failing there.
    For such data give ``merge``: ``fn`` then sees slices of about ``slice_rows`` rows
    of a group (split by a hash of ``slice_key``) and ``merge`` the stacked results of at
    most about ``FAN_IN`` slices of one group, in rounds, so it must not matter which are
    merged first. Both results have ``schema``, which includes the keys.
    """
    by = as_list(by)
    df = not_null(df, by)
    top = largest_group(df, by)
    if merge is None:
        if top > largest:
            raise ValueError(f"a group has {top} rows; give merge= to work on slices")
        return _spread(df, by).groupBy(*by).applyInPandas(fn, schema)
    slices = max(1, -(-top // slice_rows))
    cut = df.withColumn("_slice", F.pmod(F.xxhash64(slice_key), F.lit(slices)))
    numbered = T.StructType([*(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)]).add("_slice", T.LongType())

    def within(work: Callable[[pd.DataFrame], pd.DataFrame]):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            return work(pdf.drop(columns="_slice")).assign(_slice=pdf["_slice"].iloc[0])

        return run

    keys = [*by, "_slice"]
    partial = _spread(cut, keys).groupBy(*keys).applyInPandas(within(fn), numbered)
    while slices > FAN_IN:
        slices = -(-slices // FAN_IN)
        partial = partial.withColumn("_slice", F.pmod("_slice", F.lit(slices)))
        partial = partial.groupBy(*keys).applyInPandas(within(merge), numbered)
    return partial.drop("_slice").groupBy(*by).applyInPandas(merge, schema)


def _spread(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Hash partitions of a fixed number: Python time per row is what counts here, and
    partitions packed by bytes would leave most workers idle."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def group_metrics(df: DataFrame, by, exprs: dict[str, Column]) -> DataFrame:
    """Several named, possibly cross-column, indicators per group in one pass."""
    by = as_list(by)
    return not_null(df, by).groupBy(*by).agg(*[e.alias(n) for n, e in exprs.items()])


def na_sum(df: DataFrame, by, col: str, min_count: int = 0) -> DataFrame:
    """Sum with nulls as 0; fewer than ``min_count`` known values give null."""
    return _with_count(df, by, col, min_count, F.coalesce(F.sum(col), F.lit(0.0)), "sum")


def na_prod(df: DataFrame, by, col: str, min_count: int = 0) -> DataFrame:
    """Product with nulls as 1; fewer than ``min_count`` known values give null."""
    return _with_count(df, by, col, min_count, F.coalesce(F.product(F.col(col)), F.lit(1.0)), "prod")


def _with_count(df, by, col, min_count, value, name):
    by = as_list(by)
    guarded = F.when(F.count(col) >= min_count, value)
    return not_null(df, by).groupBy(*by).agg(guarded.alias(name))


def histogram(df: DataFrame, value: Column, bins: int = 20, by=None) -> DataFrame:
    """Equal-width counts over each class's own range; empty bins are not listed.

    Columns: class, bin (0-based), lo, hi, n. The top edge belongs to the last bin;
    null, NaN and infinite values are left out."""
    by = as_list(by)
    x = F.col("_x")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    data = not_null(df, by).select(*by, value.cast("double").alias("_x")).filter(finite)
    edges = data.groupBy(*by).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    if by:
        placed = data.join(edges, by)
    else:
        packed = edges.select(F.struct("_lo", "_hi")).scalar()
        placed = data.select("_x", packed["_lo"].alias("_lo"), packed["_hi"].alias("_hi"))
    lo, hi = F.col("_lo"), F.col("_hi")
    share = F.try_divide(x - lo, hi - lo)
    number = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1)).cast("long")
    counted = placed.groupBy(*by, number.alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
    step = (hi - lo) / F.lit(bins)
    b = F.col("bin")
    return counted.select(*by, "bin", (lo + b * step).alias("lo"), (lo + (b + 1) * step).alias("hi"), "n")


def category_histogram(df: DataFrame, col: str, by) -> DataFrame:
    """Counts by class and category."""
    by = as_list(by)
    return not_null(df, [*by, col]).groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))


def entropy_index(df: DataFrame, by, entity: str, amount: Column) -> DataFrame:
    """Information entropy (bits) of the entities' shares of a group's amount.

    With S the group total, -sum(p log2 p) = log2 S - sum(x log2 x) / S, so two
    rounds of partial sums are enough."""
    by = as_list(by)
    totals = not_null(df, [*by, entity]).groupBy(*by, entity).agg(F.sum(amount).alias("_x"))
    x, s = F.col("_x"), F.sum("_x")
    own = F.sum(x * F.log2(x))
    return totals.filter(x > 0).groupBy(*by).agg((F.log2(s) - own / s).alias("entropy"))


def judge_score(df: DataFrame, item: str, score: str) -> DataFrame:
    """Mean score per item without one highest and one lowest score (null below 3)."""
    trimmed = F.sum(score) - F.max(score) - F.min(score)
    kept = F.count(score) - 2
    value = F.when(kept > 0, F.try_divide(trimmed, kept))
    return not_null(df, [item]).groupBy(item).agg(value.alias("score"), F.count(score).alias("judges"))
