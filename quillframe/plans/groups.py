"""Group helpers that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .lineage import cut_lineage

# A group of at most this many rows is sorted inside one task (the sort spills);
# a larger one is cut into segments of SEGMENT_ROWS rows.
LARGEST_PLAIN_GROUP = 4_000_000
SEGMENT_ROWS = 1_000_000
# Rows of small groups that one task takes.
TASK_ROWS = 250_000


def as_list(names: str | Sequence[str] | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def not_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows whose group keys are all present (null keys form no group)."""
    return df.filter(all_of([F.col(n).isNotNull() for n in names])) if names else df


def largest_group(df: DataFrame, by: Sequence[str]) -> int:
    """Rows in the largest group: one pass over the key columns with map-side counts."""
    counts = df.groupBy(*[F.col(b) for b in by]).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def hot_keys(df: DataFrame, by: Sequence[str], largest: int | None = None) -> DataFrame | None:
    """Keys of the groups above ``LARGEST_PLAIN_GROUP`` (or fewer: ``largest``) rows, or None
    when there are none."""
    return hot_keys_and_rows(df, by, largest)[0]


def hot_keys_and_rows(df: DataFrame, by: Sequence[str], largest: int | None = None) -> tuple[DataFrame | None, int]:
    """:func:`hot_keys` and the number of rows of ``df``.

    One pass over the key columns with map-side counts. There are at most one such key per so
    many rows; they are written out when there are any."""
    largest = min(LARGEST_PLAIN_GROUP, largest or LARGEST_PLAIN_GROUP)
    counts = df.groupBy(*[F.col(b) for b in by]).agg(F.count(F.lit(1)).alias("_n"))
    most, rows = counts.agg(F.max("_n"), F.sum("_n")).first()
    hot = cut_lineage(counts.filter(F.col("_n") > largest).select(*by)) if (most or 0) > largest else None
    return hot, rows or 0


def in_small_tasks(df: DataFrame, by: Sequence[str], rows: int) -> DataFrame:
    """``df``, of about so many rows, dealt out by group to tasks of about ``TASK_ROWS`` rows, for
    work that sorts them several times in one task. However large a table is, such a task needs no
    more memory."""
    if rows <= TASK_ROWS:
        return df
    tasks = max(-(-rows // TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(tasks, *by)


def kept_or_none(keys: DataFrame) -> DataFrame | None:
    return None if keys.isEmpty() else cut_lineage(keys)


def parted(df: DataFrame, hot: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of other groups, rows of the hot groups)."""
    return tuple(attach(df, hot, by, null_safe=True, how=how) for how in ("left_anti", "left_semi"))


def attach(
    df: DataFrame, stats: DataFrame, by: Sequence[str], null_safe: bool = False, how: str = "left"
) -> DataFrame:
    """Join one-row-per-group values back to the rows.

    No hint is given: Spark broadcasts ``stats`` only when its measured size is
    below the threshold, and otherwise splits a skewed ``df`` side at run time.
    """
    if not null_safe:
        return df.join(stats, list(by), how)
    renamed = stats.withColumnsRenamed({b: f"_key_{i}" for i, b in enumerate(by)})
    match = all_of([F.col(b).eqNullSafe(F.col(f"_key_{i}")) for i, b in enumerate(by)])
    return df.join(renamed, match, how).drop(*[f"_key_{i}" for i in range(len(by))])


def scalar_of(df: DataFrame, value: Column) -> Column:
    """A whole-table aggregate as a scalar subquery (computed once, never joined)."""
    return df.agg(value.alias("value")).scalar()
