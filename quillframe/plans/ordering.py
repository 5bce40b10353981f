"""Order-dependent work without moving a table, or a hot group, into one task.

Two layouts are used. For small groups a plain window over the group is the cheapest
plan. The rows of groups larger than ``LARGEST_PLAIN_GROUP`` rows (or all rows, when
there is no group key) are range-partitioned on key and order, numbered from
per-partition counts, and cut into segments of ``SEGMENT_ROWS`` consecutive rows;
windows then run per segment and small per-segment summaries carry state on.

An order is a list of keys, each a column name (ascending) or ``(name, "desc")``;
nulls sort last. Orders end in a unique key, so that every result is repeatable.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from . import groups
from .groups import as_list, attach, hot_keys_and_rows, in_small_tasks, parted
from .lineage import cut_lineage

Key = str | tuple[str, str]
Order = Key | Sequence[Key]

ROW_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits

POSITION = "_position"
SEGMENT = "_segment"


def as_keys(order_by: Order) -> list[tuple[str, bool]]:
    """(name, descending) pairs."""
    keys = order_by if isinstance(order_by, list) else [order_by]
    return [(k, False) if isinstance(k, str) else (k[0], k[1] == "desc") for k in keys]


def key_names(order_by: Order) -> list[str]:
    return [name for name, _ in as_keys(order_by)]


def sort_columns(order_by: Order, reverse: bool = False) -> list[Column]:
    def one(name: str, descending: bool) -> Column:
        c = F.col(name)
        if reverse:
            return c.asc_nulls_first() if descending else c.desc_nulls_first()
        return c.desc_nulls_last() if descending else c.asc_nulls_last()

    return [one(name, descending) for name, descending in as_keys(order_by)]


def with_position(df: DataFrame, order_by: Order, name: str = POSITION) -> DataFrame:
    """0-based dense row number over the whole table.

    One range shuffle; the partition and the row index inside it are written out,
    and only one count per partition is summed up on the driver, so the broadcast
    side has as many rows as there are partitions.
    """
    keys = sort_columns(order_by)
    raw = "_raw_position"
    placed = cut_lineage(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(raw, F.monotonically_increasing_id())
    )
    part = F.shiftright(F.col(raw), ROW_BITS)
    index = F.col(raw).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows")).toPandas()
    if len(counts) < 2:
        return placed.withColumn(name, index).drop(raw)
    counts = counts.sort_values("_part")
    counts["_offset"] = counts["_rows"].cumsum() - counts["_rows"]
    offsets = df.sparkSession.createDataFrame(counts[["_part", "_offset"]], "_part long, _offset long")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, index + F.col("_offset"))
        .drop("_part", "_offset", raw)
    )


def with_group_position(df: DataFrame, by, order_by: Order, name: str) -> DataFrame:
    """0-based row number inside each group (null keys count as a group)."""

    def numbered(lay: Layout) -> DataFrame:
        if not lay.split:
            return lay.rows.withColumn(name, F.row_number().over(lay.window()).cast("long") - 1)
        if not lay.by:
            return lay.rows.withColumn(name, F.col(POSITION)).drop(POSITION, SEGMENT)
        starts = lay.rows.groupBy(*lay.by).agg(F.min(POSITION).alias("_start"))
        rows = attach(lay.rows, starts, lay.by, null_safe=True)
        return rows.withColumn(name, F.col(POSITION) - F.col("_start")).drop(POSITION, SEGMENT, "_start")

    return over_groups(df, by, order_by, numbered)


@dataclass
class Layout:
    """Rows laid out for ordered windows; made by :func:`over_groups`."""

    rows: DataFrame
    by: list[str]
    order: Order
    split: bool
    segment_rows: int | None = None

    @property
    def partition(self) -> list[str]:
        return [SEGMENT, *self.by] if self.split else self.by

    def window(self, reverse: bool = False) -> WindowSpec:
        """``reverse`` walks the same rows backwards: a running frame there costs one
        step per row, while a frame open towards the end is re-read for every row."""
        return Window.partitionBy(*self.partition).orderBy(*sort_columns(self.order, reverse))

    def own_rows(self, df: DataFrame) -> DataFrame:
        """Drop rows that were only lent to a neighbouring segment."""
        if not self.split:
            return df.drop(POSITION)
        own = F.col(SEGMENT) == _segment_of(F.col(POSITION), self.segment_rows)
        return df.filter(own).drop(SEGMENT, POSITION)


def _segment_of(position: Column, segment_rows: int) -> Column:
    return F.floor(position / F.lit(segment_rows)).cast("long")


def over_groups(
    df: DataFrame,
    by,
    order_by: Order,
    work: Callable[[Layout], DataFrame],
    before: int = 0,
    after: int = 0,
    largest: int | None = None,
) -> DataFrame:
    """Run ``work`` on rows laid out for windows that look ``before`` rows back and
    ``after`` ahead.

    Only hot groups (or a table without group key) go through the split layout; all
    other rows take the plain one, and the results are put together. ``largest`` rows are
    as many as ``work`` takes in one task, if that is less than a sort does."""
    by = as_list(by)
    if not by:
        return work(_cut(df, by, order_by, before, after, largest))
    hot, rows = hot_keys_and_rows(df, by, largest)
    if hot is None:
        return work(Layout(in_small_tasks(df, by, rows), by, order_by, split=False))
    cold_rows, hot_rows = parted(df, hot, by)
    plain = work(Layout(in_small_tasks(cold_rows, by, rows), by, order_by, split=False))
    return plain.unionByName(work(_cut(hot_rows, by, order_by, before, after, largest)))


def _cut(df: DataFrame, by: list[str], order_by: Order, before: int, after: int, largest: int | None = None) -> Layout:
    """Segments of consecutive rows. A row near a segment's edge is lent to the segments
    that look at it, on average 1 + (before + after) / SEGMENT_ROWS copies of each row."""
    order = [*by, *(order_by if isinstance(order_by, list) else [order_by])]
    placed = with_position(df, order)
    p = F.col(POSITION)
    size = min(groups.SEGMENT_ROWS, largest or groups.SEGMENT_ROWS)
    if before or after:
        first = _segment_of(F.greatest(p - after, F.lit(0)), size)
        rows = placed.withColumn(SEGMENT, F.explode(F.sequence(first, _segment_of(p + before, size))))
    else:
        rows = placed.withColumn(SEGMENT, _segment_of(p, size))
    return Layout(rows, by, POSITION, split=True, segment_rows=size)


def _carry(summary: DataFrame, by: list[str], reverse: bool = False):
    """Window over one row per (group, segment), ending before the current one."""
    key = F.col(SEGMENT).desc() if reverse else F.col(SEGMENT).asc()
    return Window.partitionBy(*by).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)


def with_known_neighbours(
    df: DataFrame, by, order_by: Order, col: str, prev: str, nxt: str, row: str, at: Column | None = None
) -> DataFrame:
    """Adds the nearest non-null values of ``col`` on both sides.

    ``prev`` and ``nxt`` are ``struct<pos, at, value>`` (null where there is none; the
    row itself when its value is known) and ``row`` is the row's own position. Only
    differences between positions of one group are meaningful.
    """
    at = F.lit(0) if at is None else at
    return over_groups(df, by, order_by, lambda lay: _neighbours(lay, col, prev, nxt, row, at))


def _neighbours(lay: Layout, col: str, prev: str, nxt: str, row: str, at: Column) -> DataFrame:
    by = lay.by
    if lay.split:
        rows = lay.rows.withColumn(row, F.col(POSITION))
    else:
        rows = lay.rows.withColumn(row, F.row_number().over(lay.window()).cast("long") - 1)
    mark = F.when(
        F.col(col).isNotNull(), F.struct(F.col(row).alias("pos"), at.alias("at"), F.col(col).alias("value"))
    )
    rows = rows.withColumn("_mark", mark)
    upto = (Window.unboundedPreceding, Window.currentRow)
    last = F.last("_mark", ignorenulls=True)
    rows = rows.withColumn(prev, last.over(lay.window().rowsBetween(*upto))).withColumn(
        nxt, last.over(lay.window(reverse=True).rowsBetween(*upto))
    )
    if lay.split:
        summary = rows.groupBy(SEGMENT, *by).agg(
            F.max("_mark").alias("_last"), F.min("_mark").alias("_first")
        )
        carried = summary.select(
            SEGMENT,
            *by,
            F.max("_last").over(_carry(summary, by)).alias("_before"),
            F.min("_first").over(_carry(summary, by, reverse=True)).alias("_after"),
        )
        rows = (
            attach(rows, carried, [SEGMENT, *by], null_safe=True)
            .withColumn(prev, F.coalesce(prev, "_before"))
            .withColumn(nxt, F.coalesce(nxt, "_after"))
            .drop("_before", "_after")
        )
    return lay.own_rows(rows.drop("_mark"))


_RUNNING = {"sum": (F.sum, F.sum), "count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def with_running(df: DataFrame, by, order_by: Order, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """Running aggregates from the start of each group.

    ``wanted`` maps a new name to ``(function, column)`` with function one of sum,
    count, min, max; values before the first non-null one are null (count: 0).
    """
    return over_groups(df, by, order_by, lambda lay: _running(lay, wanted))


def _running(lay: Layout, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    by = lay.by
    frame = lay.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = lay.rows.withColumns({n: _RUNNING[f][0](c).over(frame) for n, (f, c) in wanted.items()})
    if lay.split:
        summary = rows.groupBy(SEGMENT, *by).agg(
            *[_RUNNING[f][0](c).alias(f"_part_{n}") for n, (f, c) in wanted.items()]
        )
        carried = summary.select(
            SEGMENT,
            *by,
            *[
                _RUNNING[f][1](f"_part_{n}").over(_carry(summary, by)).alias(f"_carry_{n}")
                for n, (f, _) in wanted.items()
            ],
        )
        rows = attach(rows, carried, [SEGMENT, *by], null_safe=True)
        rows = rows.withColumns(
            {n: _merge(f, F.col(n), F.col(f"_carry_{n}")) for n, (f, _) in wanted.items()}
        ).drop(*[f"_carry_{n}" for n in wanted])
    return lay.own_rows(rows)


def _merge(function: str, here: Column, carried: Column) -> Column:
    if function == "min":
        return F.least(here, carried)
    if function == "max":
        return F.greatest(here, carried)
    return F.coalesce(here + carried, here, carried)
