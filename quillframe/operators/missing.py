"""Missing values: reporting, unifying, filling, dropping, interpolating."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.dates import micros
from ..plans.groups import as_list, not_null
from ..plans.ordering import Order, key_names, with_known_neighbours
from ..plans.quantiles import group_quantiles, quantile_name

_PREV, _NEXT, _ROW = "_prev", "_next", "_row"


def null_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and share per column, from one aggregation."""
    cols = list(cols or df.columns)
    known = df.agg(*[F.count(c).alias(c) for c in cols], F.count(F.lit(1)).alias("_rows"))
    nulls = {c: F.col("_rows") - F.col(c) for c in cols}
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            nulls[c].alias("nulls"),
            F.try_divide(nulls[c], F.col("_rows")).alias("share"),
        )
        for c in cols
    ]
    return known.select(F.inline(F.array(*entries)))


def rows_with_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows in which any of the columns is null."""
    missing = [F.col(c).isNull() for c in (cols or df.columns)]
    return df.filter(reduce(lambda a, b: a | b, missing))


def unify_missing(df: DataFrame, cols: Sequence[str] | None = None, markers: Sequence[str] = ("",)) -> DataFrame:
    """NaN and the given marker texts become null."""

    def clean(name: str) -> Column:
        c = F.col(name)
        kind = df.schema[name].dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(c), c)
        if isinstance(kind, T.StringType):
            return F.when(~F.trim(c).isin(list(markers)), c)
        return c

    return df.withColumns({c: clean(c) for c in (cols or df.columns)})


# Candidate types from narrow to wide; text that fits none of them stays text.
_CANDIDATES = ["boolean", "bigint", "double", "date", "timestamp_ntz"]


def narrowest_types(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, str]:
    """The narrowest type every non-null value of a text or double column fits (one pass)."""
    kinds = {c: df.schema[c].dataType for c in (cols or df.columns)}
    tests: dict[tuple[str, str], Column] = {}
    for c, kind in kinds.items():
        if isinstance(kind, T.StringType):
            for t in _CANDIDATES:
                tests[c, t] = _fits(c, t)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            tests[c, "bigint"] = (F.col(c) == F.floor(F.col(c))) & (F.abs(F.col(c)) < 2.0**53)
    if not tests:
        return {}
    fits = [F.coalesce(F.every(F.col(c).isNull() | ok), F.lit(False)) for (c, _), ok in tests.items()]
    known = [F.count(c) for c, _ in tests]
    row = df.agg(*fits, *known).first()
    chosen: dict[str, str] = {}
    for i, (c, t) in enumerate(tests):
        if c not in chosen and row[i] and row[len(fits) + i]:
            chosen[c] = t
    return chosen


def _fits(col: str, kind: str) -> Column:
    c = F.col(col)
    shape = {
        "boolean": r"^(?i)(true|false)$",
        "bigint": r"^[+-]?(0|[1-9]\d{0,18})$",  # a leading zero is an identifier's
        "double": r"^[+-]?((0|[1-9]\d*)(\.\d*)?|\.\d+)([eE][+-]?\d+)?$",
        "date": r"^\d{4}-\d{1,2}-\d{1,2}$",
        "timestamp_ntz": r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}.*$",
    }[kind]
    return c.rlike(shape) & c.try_cast(kind).isNotNull()


def convert_types(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns cast to :func:`narrowest_types`."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in narrowest_types(df, cols).items()})


def group_drop_null_keys(df: DataFrame, by, aggs: Sequence[Column]) -> DataFrame:
    """Grouped aggregation in which rows without a complete key take no part."""
    by = as_list(by)
    return not_null(df, by).groupBy(*by).agg(*aggs)


def fillna(df: DataFrame, value) -> DataFrame:
    """Constant fill; a dict gives one value per column."""
    return df.na.fill(value)


def fill_forward(df: DataFrame, by, order_by: Order, col: str, limit: int | None = None) -> DataFrame:
    """Carry the last known value on, over at most ``limit`` rows."""
    return _carried(df, by, order_by, col, limit, _PREV)


def fill_backward(df: DataFrame, by, order_by: Order, col: str, limit: int | None = None) -> DataFrame:
    """Carry the next known value back, over at most ``limit`` rows."""
    return _carried(df, by, order_by, col, limit, _NEXT)


def _carried(df, by, order_by, col, limit, side):
    near = with_known_neighbours(df, by, order_by, col, _PREV, _NEXT, _ROW)
    value = F.col(f"{side}.value")
    if limit is not None:
        value = F.when(F.abs(F.col(_ROW) - F.col(f"{side}.pos")) <= limit, value)
    return near.withColumn(col, value).select(*df.columns)


def fill_stat(df: DataFrame, col: str, stat: str, by=None, fit_on: DataFrame | None = None) -> DataFrame:
    """Nulls filled with a mean or median fitted on ``fit_on`` (default: the table itself).

    With ``by`` the statistic is per group; a group unseen in the fit stays null."""
    by = as_list(by)
    train = not_null(df if fit_on is None else fit_on, by)
    if stat == "median":
        fitted = group_quantiles(train, by, col, [0.5]).withColumnRenamed(quantile_name(0.5), "_fit")
    else:
        fitted = train.groupBy(*by).agg(F.avg(col).alias("_fit"))
    if by:
        joined = df.join(fitted, by, "left")
    else:
        joined = df.withColumn("_fit", fitted.select("_fit").scalar())
    return joined.withColumn(col, F.coalesce(col, "_fit")).select(*df.columns)


def dropna(df: DataFrame, how: str = "any", thresh: int | None = None, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any / only nulls, or with fewer than ``thresh`` known values."""
    subset = list(subset or df.columns)
    known = reduce(add, [F.col(c).isNotNull().cast("int") for c in subset])
    least = thresh if thresh is not None else len(subset) if how == "any" else 1
    return df.filter(known >= least)


def drop_null_columns(df: DataFrame, max_share: float) -> DataFrame:
    """Drop columns whose share of nulls is above ``max_share`` (one aggregation is run)."""
    shares = {r["column"]: r["share"] for r in null_report(df).collect()}
    return df.select(*[c for c in df.columns if (shares[c] or 0.0) <= max_share])


def interpolate(
    df: DataFrame,
    by,
    order_by: Order,
    col: str,
    method: str = "linear",
    limit: int | None = None,
    limit_direction: str = "forward",
    limit_area: str | None = None,
) -> DataFrame:
    """Fill gaps between known values.

    ``method`` linear spaces by row position, time by the first order column, and
    nearest takes the closer neighbour (the earlier one on ties). After the last
    known value that value goes on; before the first one the gap stays, unless
    ``limit_direction`` is backward or both. ``limit`` fills at most that many rows of
    a gap, counted from the side(s) of ``limit_direction``; ``limit_area`` inside /
    outside restricts filling to gaps between / beyond known values.
    """
    name = key_names(order_by)[0]
    kind = df.schema[name].dataType
    is_time = isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType))
    at = micros(F.col(name)) if is_time else F.col(name).cast("double")
    by_position = method == "linear"
    near = with_known_neighbours(
        df, by, order_by, col, _PREV, _NEXT, _ROW, at=F.lit(0) if by_position else at
    )
    before, after = F.col(f"{_PREV}.value"), F.col(f"{_NEXT}.value")
    here = F.col(_ROW) if by_position else at
    start, end = (F.col(f"{s}.pos" if by_position else f"{s}.at") for s in (_PREV, _NEXT))
    if method == "nearest":
        inside = F.when(here - start <= end - here, before).otherwise(after)
    else:
        inside = before + (after - before) * F.try_divide(here - start, end - start)

    forward = limit_direction in ("forward", "both")
    backward = limit_direction in ("backward", "both")
    from_start = F.col(_ROW) - F.col(f"{_PREV}.pos")
    from_end = F.col(f"{_NEXT}.pos") - F.col(_ROW)
    reach = F.lit(False)
    if forward:
        reach = reach | (F.lit(True) if limit is None else F.coalesce(from_start <= limit, F.lit(False)))
    if backward:
        reach = reach | (F.lit(True) if limit is None else F.coalesce(from_end <= limit, F.lit(False)))

    value = F.when(F.col(col).isNotNull(), F.col(col).cast("double"))
    between = before.isNotNull() & after.isNotNull()
    if limit_area != "outside":
        value = value.when(between & reach, inside)
    if limit_area != "inside":
        if forward:
            value = value.when(after.isNull() & reach, before)
        if backward:
            value = value.when(before.isNull() & reach, after)
    return near.withColumn(col, value).select(*df.columns)


def interpolate_linear(df: DataFrame, by, order_by: Order, col: str) -> DataFrame:
    """Evenly by row position; the tail goes on, the head stays null."""
    return interpolate(df, by, order_by, col)


def interpolate_time(df: DataFrame, by, order_by: Order, col: str) -> DataFrame:
    """In proportion to the first order column."""
    return interpolate(df, by, order_by, col, method="time")


def interpolate_nearest(df: DataFrame, by, order_by: Order, col: str) -> DataFrame:
    """The nearest known value between two known ones; outside gaps stay null."""
    return interpolate(df, by, order_by, col, method="nearest", limit_area="inside")
