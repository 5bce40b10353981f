"""Exact, linearly interpolated quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from . import groups
from .groups import as_list, largest_group
from .ordering import with_running


def quantile_name(q: float) -> str:
    return f"q{round(q * 100, 6):g}".replace(".", "_")


def group_quantiles(df: DataFrame, by, col: str, qs: Sequence[float]) -> DataFrame:
    """One row per group (one row in all without ``by``) with a column per quantile.

    Values are first counted per distinct value, which shrinks the data before any
    shuffle of values. While the distinct values of a group fit in one task the
    built-in exact percentile runs on those counts; beyond that the counts are
    summed up in value order by the split running sum, and the two values around
    each target rank are picked.
    """
    by = as_list(by)
    counts = (
        df.filter(F.col(col).isNotNull())
        .groupBy(*by, F.col(col).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    if largest_group(counts, by) <= min(groups.LARGEST_PLAIN_GROUP, groups.SEGMENT_ROWS):
        wanted = [F.percentile("_value", q, F.col("_rows")).alias(quantile_name(q)) for q in qs]
        return counts.groupBy(*by).agg(*wanted)
    running = with_running(counts, by, "_value", {"_upto": ("sum", "_rows")})
    totals = running.groupBy(*by).agg(F.max("_upto").alias("_n"))
    if by:
        placed = running.join(totals, by)
    else:
        placed = running.withColumn("_n", totals.select("_n").scalar())
    return placed.groupBy(*by).agg(*[_interpolated(q).alias(quantile_name(q)) for q in qs])


def _interpolated(q: float) -> Column:
    target = (F.col("_n") - 1) * F.lit(float(q))
    low = F.floor(target)

    def value_at(rank: Column) -> Column:
        held = (F.col("_upto") - F.col("_rows") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(held, F.col("_value")))

    share = F.max(target - low)
    return value_at(low) * (1 - share) + value_at(F.ceil(target)) * share
