"""Rolling and expanding windows per group, safe for groups of any size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.dates import micros
from ..plans import groups
from ..plans.frames import Finish, merged, over_row_frames, packed, parts_of, running, unpacked, with_carry
from ..plans.groups import as_list, attach, hot_keys, parted
from ..plans.lineage import cut_lineage
from ..plans.order_statistics import frame_quantiles
from ..plans.ordering import POSITION, SEGMENT, Layout, Order, over_groups, with_position, with_running

# A frame of at most so many rows is added up anew for every row; a longer one is merged.
SHORT_FRAME = 32
# Groups above so many rows are cut into segments for quantiles, which hold a segment in memory.
QUANTILE_ROWS = 250_000

_FUNCTIONS: dict[str, Callable[[str], Column]] = {
    "sum": F.sum,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "count": F.count,
}
# New column: a statistic or quantile of the column given, or (statistic, its column).
Wanted = dict[str, str | float | tuple[str | float, str]]
_AT, _SPAN, _OWN, _ASKS, _KEY = "_at", "_span", "_own", "_asks", "_frame_key"
_START, _END, _VALUE = "_frame_start", "_frame_end", "_frame_value"


def _split(wanted: Wanted, col: str | None) -> tuple[dict[str, dict[str, str]], dict[str, dict[str, float]]]:
    """(plain statistics, quantiles), both by column."""
    plain: dict[str, dict[str, str]] = {}
    quantiles: dict[str, dict[str, float]] = {}
    for out, asked in wanted.items():
        f, c = asked if isinstance(asked, tuple) else (asked, col)
        if c is None:
            raise ValueError(f"{out} needs a column")
        if f == "median" or not isinstance(f, str):
            q = 0.5 if f == "median" else float(f)
            if not 0 <= q <= 1:
                raise ValueError("a quantile lies between 0 and 1")
            quantiles.setdefault(c, {})[out] = q
        elif f in _FUNCTIONS:
            plain.setdefault(c, {})[out] = f
        else:
            raise ValueError(f"unknown statistic {f}")
    return plain, quantiles


class _Plain:
    """Statistics without quantiles: what is asked of the frames, and results from their parts."""

    def __init__(self, df: DataFrame, plain: dict[str, dict[str, str]], least: int) -> None:
        self.plain, self.least = plain, least
        self.finish = {c: Finish(df, c, fs.values()) for c, fs in plain.items()}
        self.parts = {c: parts_of(fs.values(), self.finish[c].exact_mean) for c, fs in plain.items()}
        self.held = {c: f"_held{i}" for i, c in enumerate(plain)}

    def results(self, rows: DataFrame) -> DataFrame:
        values = {}
        for c, fs in self.plain.items():
            held = unpacked(self.held[c], self.parts[c])
            values |= {out: F.when(held["n"] >= self.least, self.finish[c].value(f, held)) for out, f in fs.items()}
        return rows.withColumns(values)


def _reach(n: int, center: bool) -> tuple[int, int]:
    """Rows before and after the current one that a window of n rows covers."""
    return (n // 2, (n - 1) // 2) if center else (n - 1, 0)


def rolling_rows(
    df: DataFrame,
    by,
    order_by: Order,
    col: str | None,
    n: int,
    wanted: Wanted,
    min_periods: int | None = None,
    center: bool = False,
) -> DataFrame:
    """Statistics over n rows ending at (or centred on) each row; null with fewer than
    ``min_periods`` (default n) known values. ``wanted`` maps new names to sum, mean, min, max,
    std, var, count, median or a number from 0 to 1, that quantile; each of ``col``, or, as
    (statistic, column), of another column in the same pass. The cost of a row does not grow
    with n (quantiles: with its logarithm), types are Spark's own for the frame, and values
    outside a frame have no influence on it."""
    least = n if min_periods is None else min_periods
    before, after = _reach(n, center)
    plain, quantiles = _split(wanted, col)
    work = _Plain(df, plain, least) if n > SHORT_FRAME else None

    def rolled(lay: Layout) -> DataFrame:
        rows = lay.rows
        if work and plain:
            asked = {work.held[c]: (work.parts[c], F.col(c), None) for c in plain}
            rows = over_row_frames(rows, lay.partition, lay.window(), before, after, asked)
            rows = work.results(rows).drop(*asked)
        elif plain:
            frame = lay.window().rowsBetween(-before, after)
            enough = {c: F.count(c).over(frame) >= least for c in plain}
            rows = rows.withColumns({out: F.when(enough[c], _FUNCTIONS[f](c).over(frame)) for c, fs in plain.items() for out, f in fs.items()})
        if quantiles:
            place = F.row_number().over(lay.window()).cast("long")
            # Ends are cut off where the sequence ends.
            rows = rows.withColumns({_KEY: place, _START: place - before, _END: place + after})
            rows = _with_quantiles(rows, lay.partition, quantiles, least)
        return lay.own_rows(rows)

    df = over_groups(df, by, order_by, rolled, before, after, largest=QUANTILE_ROWS if quantiles else None)
    return df.select(*[c for c in df.columns if c not in wanted], *wanted)


def _with_quantiles(
    rows: DataFrame, partition: list[str], quantiles: dict[str, dict[str, float]], least: int, span_us: int | None = None
) -> DataFrame:
    """Adds quantiles of columns over the rows of a partition whose ``_KEY`` lies between a row's
    ``_START`` and ``_END``, both included; rows without a key have each other. With ``span_us`` one
    row for each ``_AT`` of a row that is ``_OWN``, over the span that ends there."""
    if span_us is not None:
        new = [StructField(out, DoubleType()) for qs in quantiles.values() for out in qs]
        schema = StructType([*rows.select(*partition, _AT).schema, *new])
        return rows.groupBy(*partition).applyInArrow(_quantiles_of_times(partition, span_us, quantiles, least), schema)
    given = [c for c in rows.columns if c not in (_KEY, _START, _END)]
    values = {c: f"{_VALUE}{i}" for i, c in enumerate(quantiles)}
    rows = rows.withColumns({v: F.col(c).cast("double") for c, v in values.items()})
    new = [out for qs in quantiles.values() for out in qs]
    kept = [c for c in given if c not in new]
    schema = StructType([*rows.select(*kept).schema, *[StructField(out, DoubleType()) for out in new]])

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        keyed = ~table[_KEY].is_null().to_numpy(zero_copy_only=False)
        number = lambda c: table[c].fill_null(0).to_numpy()
        key = number(_KEY)
        order = np.lexsort((key, ~keyed))  # rows without a key at the end
        m = int(keyed.sum())
        key = key[order]
        start, end = np.full(len(key), m), np.full(len(key), len(key))
        start[:m] = np.searchsorted(key[:m], number(_START)[order][:m], "left")
        end[:m] = np.searchsorted(key[:m], number(_END)[order][:m], "right")
        places = pa.array(order)
        out = table.select(kept).take(places)
        for c, qs in quantiles.items():
            column = table[values[c]].take(places)
            known = ~column.is_null().to_numpy(zero_copy_only=False)
            found = frame_quantiles(column.fill_null(0.0).to_numpy(), known, start, end, list(qs.values()), least)
            for name, q in zip(qs, found):
                out = out.append_column(name, pa.array(q.data, pa.float64(), mask=np.ma.getmaskarray(q)))
        return out

    return rows.groupBy(*partition).applyInArrow(run, schema)


def rolling_apply(
    df: DataFrame, by, order_by: Order, col: str, n: int, fn: Callable[[Column], Column], out: str
) -> DataFrame:
    """``fn`` maps the array of the last n known values to a value; null before n rows
    are known. The array is made for every row; :func:`rolling_rows` has the usual statistics
    and quantiles without that."""

    def applied(lay: Layout) -> DataFrame:
        frame = lay.window().rowsBetween(-(n - 1), 0)
        rows = lay.rows.withColumn("_frame", F.collect_list(col).over(frame))
        value = F.when(F.size("_frame") >= n, fn(F.col("_frame")))
        return lay.own_rows(rows.withColumn(out, value).drop("_frame"))

    return over_groups(df, by, order_by, applied, before=n - 1)


def rolling_cov_corr(
    df: DataFrame, by, order_by: Order, a: str, b: str, n: int, min_periods: int | None = None
) -> DataFrame:
    """Sample covariance and correlation of two columns over the last n rows (columns
    ``cov`` and ``corr``; at least two pairs are needed, and a constant column has no
    correlation). The cost of a row does not grow with n."""
    least = max(2, n if min_periods is None else min_periods)
    parts, finish, held = parts_of(["cov", "corr"]), Finish(df, a, []), "_held"

    def rolled(lay: Layout) -> DataFrame:
        asked = {held: (parts, F.col(a), F.col(b))}
        if n > SHORT_FRAME:
            rows = over_row_frames(lay.rows, lay.partition, lay.window(), n - 1, 0, asked)
        else:
            frame = lay.window().rowsBetween(-(n - 1), 0)
            rows = lay.rows.withColumn(held, packed(running(parts, frame, F.col(a), F.col(b))))
        found = unpacked(held, parts)
        values = {f: F.when(found["n"] >= least, finish.value(f, found)) for f in ("cov", "corr")}
        return lay.own_rows(rows.withColumns(values).drop(held))

    return over_groups(df, by, order_by, rolled, before=n - 1)


def expanding(
    df: DataFrame, by, order_by: Order, col: str, wanted: dict[str, str], min_periods: int = 1
) -> DataFrame:
    """Running statistics from the start of the group; ``wanted`` maps new names to sum,
    mean, min, max or count."""
    needed = {"_count": ("count", col)}
    for f in wanted.values():
        if f != "count":
            base = "sum" if f == "mean" else f
            needed[f"_{base}"] = (base, col)
    rows = with_running(df, by, order_by, needed)
    enough = F.col("_count") >= min_periods
    mean = F.try_divide(F.col("_sum"), F.col("_count"))
    values = {out: F.when(enough, mean if f == "mean" else F.col(f"_{f}")) for out, f in wanted.items()}
    return rows.withColumns(values).drop(*needed)


def rolling_time(
    df: DataFrame, by, time: str, span_us: int, col: str | None, wanted: Wanted, min_periods: int = 1
) -> DataFrame:
    """Statistics over the span that ends at each row: open on the left, closed on the
    right, rows of equal time included. ``span_us`` is in microseconds and ``wanted`` as in
    :func:`rolling_rows`. A row without a time has the frame of all rows without one.

    The cost of a row does not depend on how many rows its span holds (quantiles: it grows with
    their logarithm, and a task holds the rows of one span), and a busy span is cut into segments
    like any large group.
    """
    by = as_list(by)
    plain, quantiles = _split(wanted, col)
    if plain:
        df = _merged_spans(df, by, time, span_us, _Plain(df, plain, min_periods))
    if quantiles:
        df = _ranked_spans(df, by, time, span_us, quantiles, min_periods)
    return df.select(*[c for c in df.columns if c not in wanted], *wanted)


def _merged_spans(df: DataFrame, by: list[str], time: str, span_us: int, work: _Plain) -> DataFrame:
    """Time is cut into blocks of one span. A frame is the beginning of its own block up to the
    row, and the end of the block before from a span earlier on. For the latter each value is
    lent to the next block, moved by one span: there the frame takes what lies after the row."""
    lent = F.array(F.lit(True), F.lit(False))
    timed = df.withColumn(_AT, micros(F.col(time)))
    records = timed.withColumn(_OWN, F.explode(F.when(F.col(_AT).isNull(), F.array(F.lit(True))).otherwise(lent)))
    own, at = F.col(_OWN), F.when(F.col(_OWN), F.col(_AT)).otherwise(F.col(_AT) + span_us)
    # Of a lent row only its values travel.
    payload = {c: F.when(own, F.col(f"`{c}`")) for c in df.columns if c not in by}
    values = {c: f"{_VALUE}{i}" for i, c in enumerate(work.plain)}
    records = records.withColumn(_AT, at).withColumns({v: F.col(f"`{c}`") for c, v in values.items()}).withColumns(payload)
    records = records.withColumn(_SPAN, F.floor(F.col(_AT) / F.lit(span_us)).cast("long"))
    block = [*by, _SPAN]
    head, tail = ({c: f"_{side}{i}" for i, c in enumerate(work.plain)} for side in ("head", "tail"))

    def result(rows: DataFrame) -> DataFrame:
        parts = work.parts
        both = {work.held[c]: packed(merged(unpacked(tail[c], parts[c]), unpacked(head[c], parts[c]))) for c in parts}
        found = work.results(rows.withColumns(both))
        return found.select(*df.columns, *[out for fs in work.plain.values() for out in fs])

    def plain(rows: DataFrame) -> DataFrame:
        # Rows of one time are peers; a lent row of the same time comes before them.
        rows = rows.withColumn(_KEY, F.col(_AT) * 2 + own.cast("long"))
        upto = (Window.unboundedPreceding, Window.currentRow)
        ahead = Window.partitionBy(*block).orderBy(_KEY).rangeBetween(*upto)
        back = Window.partitionBy(*block).orderBy(F.col(_KEY).desc()).rangeBetween(*upto)
        rows = rows.withColumns({head[c]: packed(running(work.parts[c], ahead, F.when(own, F.col(v)))) for c, v in values.items()})
        rows = rows.withColumns({tail[c]: packed(running(work.parts[c], back, F.when(~own, F.col(v)))) for c, v in values.items()})
        return result(rows.filter(own))

    def cut(rows: DataFrame) -> DataFrame:
        """A block of very many rows: each row counts at its time and asks just after it."""
        asks = F.col(_ASKS)
        twice = F.explode(F.when(own, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
        rows = rows.withColumn(_ASKS, twice)
        rows = rows.withColumns({c: F.when(asks, F.col(f"`{c}`")) for c in df.columns if c not in by})
        rows = rows.withColumns({v: F.when(~asks, F.col(v)) for v in values.values()})
        rows = rows.withColumn(_KEY, F.col(_AT) * 2 + asks.cast("long"))
        placed = with_position(rows, [*block, _KEY, _ASKS])
        placed = placed.withColumn(SEGMENT, F.floor(F.col(POSITION) / F.lit(groups.SEGMENT_ROWS)).cast("long"))
        for c, v in values.items():
            placed = with_carry(placed, block, work.parts[c], F.when(own, F.col(v)), head[c])
            placed = with_carry(placed, block, work.parts[c], F.when(~own, F.col(v)), tail[c], reverse=True)
        return result(placed.filter(asks))

    hot = hot_keys(records, block)
    if hot is None:
        return plain(records)
    cold_records, hot_records = parted(records, hot, block)
    return plain(cold_records).unionByName(cut(hot_records))


def _ranked_spans(df: DataFrame, by: list[str], time: str, span_us: int, quantiles: dict[str, dict[str, float]], least: int) -> DataFrame:
    """Groups that fit a task are worked on whole. Others are cut at times between equally many
    rows; a segment borrows the rows of one span before its cut, so a task holds a segment and
    one frame. A frame follows from its time: only keys, times and values are sent to the tasks,
    and each time's results join the rows."""
    at = F.col(_AT)
    timed = df.withColumn(_AT, micros(F.col(time)))
    values = {c: f"{_VALUE}{i}" for i, c in enumerate(quantiles)}
    sent = timed.select(*by, _AT, *[F.col(c).cast("double").alias(v) for c, v in values.items()])
    new = [out for qs in quantiles.values() for out in qs]

    def ranked(rows: DataFrame, partition: list[str]) -> DataFrame:
        asked = {values[c]: qs for c, qs in quantiles.items()}
        return _with_quantiles(rows, partition, asked, least, span_us).select(*by, _AT, *new)

    def cut(rows: DataFrame) -> DataFrame:
        placed = with_position(rows, [*by, _AT])
        size = min(groups.SEGMENT_ROWS, QUANTILE_ROWS)
        placed = placed.withColumn(SEGMENT, F.floor(F.col(POSITION) / F.lit(size)).cast("long")).drop(POSITION)
        placed = attach(placed, _cuts(placed, by, span_us), [SEGMENT, *by], null_safe=True)
        # Rows of one time stay together: the last cut at or before a time is its segment.
        home = F.array_max(F.filter("_cuts", lambda c: c <= at))
        asked = F.filter("_cuts", lambda c: (c > at) & (c < at + span_us))
        placed = placed.withColumn(_SPAN, home).withColumn(SEGMENT, F.explode(F.concat(F.array(home), F.coalesce(asked, F.array().cast("array<long>"))))).drop("_cuts")
        return ranked(placed.withColumn(_OWN, F.col(SEGMENT).eqNullSafe(F.col(_SPAN))).drop(_SPAN), [SEGMENT, *by])

    if not by:
        found = cut(sent)
    elif (hot := hot_keys(sent, by, QUANTILE_ROWS)) is None:
        found = ranked(sent.withColumn(_OWN, F.lit(True)), by)
    else:
        cold_rows, hot_rows = parted(sent, hot, by)
        found = ranked(cold_rows.withColumn(_OWN, F.lit(True)), by).unionByName(cut(hot_rows))
    return attach(timed.drop(*new), found, [*by, _AT], null_safe=True).drop(_AT)


def _quantiles_of_times(partition: list[str], span_us: int, asked: dict[str, dict[str, float]], least: int):
    """For each time of a row that is ``_OWN``, once, the quantiles of columns over the span that
    ends there; without a time, over all rows without one."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        keyed = ~table[_AT].is_null().to_numpy(zero_copy_only=False)
        own = table[_OWN].to_numpy(zero_copy_only=False).astype(bool)
        key = table[_AT].fill_null(0).to_numpy()
        times = np.unique(key[keyed & own])
        order = np.lexsort((key, ~keyed))  # rows without a time at the end
        m = int(keyed.sum())
        key = key[order][:m]
        start, end = np.searchsorted(key, times - (span_us - 1), "left"), np.searchsorted(key, times, "right")
        timeless = np.zeros(len(times) + int((own & ~keyed).any()), bool)
        if len(timeless) > len(times):
            times, start, end = np.append(times, 0), np.append(start, m), np.append(end, len(order))
            timeless[-1] = True
        out = table.select(partition).take(pa.array(np.zeros(len(times), np.int64)))
        out = out.append_column(_AT, pa.array(times, pa.int64(), mask=timeless))
        for v, qs in asked.items():
            known = ~table[v].is_null().to_numpy(zero_copy_only=False)
            numbers = table[v].fill_null(0.0).to_numpy()
            found = frame_quantiles(numbers[order], known[order], start, end, list(qs.values()), least)
            for name, q in zip(qs, found):
                out = out.append_column(name, pa.array(q.data, pa.float64(), mask=np.ma.getmaskarray(q)))
        return out

    return run


def _cuts(placed: DataFrame, by: list[str], span_us: int) -> DataFrame:
    """For each run of rows (SEGMENT) the cuts that its rows are sent to or lie after: the first
    times of the runs from its own on that begin less than a span after its end."""
    key = [SEGMENT, *by]
    bounds = placed.groupBy(*key).agg(F.min(_AT).alias("_first"), F.max(_AT).alias("_last"))
    bounds = cut_lineage(bounds.filter(F.col("_first").isNotNull()))  # a row per run
    in_order = Window.partitionBy(*by).orderBy("_first")
    starts = bounds.select(*by, "_first").distinct().withColumn("_number", F.row_number().over(in_order).cast("long"))
    # Cuts counted up to each run's first time and up to a span after its last.
    asked = bounds.select(*key, F.explode(F.array("_first", F.col("_last") + (span_us - 1))).alias("_first"))
    both = asked.unionByName(starts, allowMissingColumns=True)
    upto = F.max("_number").over(in_order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    asked = both.withColumn("_upto", upto).filter(F.col(SEGMENT).isNotNull())
    ranges = asked.groupBy(*key).agg(F.min("_upto").alias("_from"), F.max("_upto").alias("_to"))
    listed = ranges.select(*key, F.explode(F.sequence("_from", "_to")).alias("_number"))
    return attach(listed, starts, [*by, "_number"], null_safe=True).groupBy(*key).agg(F.sort_array(F.collect_list("_first")).alias("_cuts"))
