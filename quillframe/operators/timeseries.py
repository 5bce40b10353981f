"""Timestamps, calendar offsets, regular buckets."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import dates
from ..plans.groups import as_list, attach, not_null, scalar_of
from ..plans.ordering import with_known_neighbours

_ORIGIN = "_origin"
# A spine is first cut into blocks of this many buckets, so no row ever holds a long array.
_BLOCK = 10_000


def to_datetime(df: DataFrame, col: str, fmt: str, out: str, errors: str = "raise") -> DataFrame:
    """Text to timestamp; with errors="coerce" unreadable text gives null."""
    parsed = F.to_timestamp_ntz(F.col(col), F.lit(fmt))
    if errors == "coerce":
        parsed = F.when(F.try_to_timestamp(F.col(col), F.lit(fmt)).isNotNull(), parsed)
    return df.withColumn(out, parsed)


def time_difference(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Duration a - b in seconds."""
    gap = dates.micros(F.col(a)) - dates.micros(F.col(b))
    return df.withColumn(out, gap / F.lit(1_000_000))


def period_of(df: DataFrame, col: str, freq: str, out: str) -> DataFrame:
    """The label of the period (bucket) holding each time."""
    return df.withColumn(out, dates.bucket_label(dates.bucket_index(F.col(col), freq), freq))


def add_offset(df: DataFrame, col: str, offset: str, n: int, out: str) -> DataFrame:
    """Calendar-aware shift that keeps the time of day.

    ``offset``: years, months, weeks, days, hours, minutes, seconds (a month too short
    for the day takes its last day), month_end / month_start (the n-th one strictly
    after, or before for negative n) and business_days."""
    ts = F.col(col).cast("timestamp_ntz")
    if offset in ("years", "months", "weeks", "days", "hours", "minutes", "seconds"):
        unit = {"minutes": "mins", "seconds": "secs"}.get(offset, offset)
        return df.withColumn(out, ts + F.make_interval(**{unit: F.lit(n)}))
    day = F.to_date(ts)
    if offset == "business_days":
        target = dates.business_shift(day, n)
    elif offset == "month_end":
        end = F.last_day(day)
        step = F.when(day == end, n).otherwise(n - 1) if n > 0 else F.lit(n)
        target = F.last_day(F.add_months(F.trunc(day, "month"), step))
    elif offset == "month_start":
        start = F.trunc(day, "month")
        step = F.lit(n) if n > 0 else F.when(day == start, n).otherwise(n + 1)
        target = F.add_months(start, step)
    else:
        raise ValueError(f"unknown offset {offset}")
    moved = dates.micros(ts) + F.date_diff(target, day).cast("long") * dates.DAY
    return df.withColumn(out, dates.from_micros(moved))


def date_range(
    spark: SparkSession, start: str, end: str, freq: str = "D", out: str = "ts"
) -> DataFrame:
    """Regular time points from start to end, both included.

    Fixed widths (30s, 15min, 6h, 2D), calendar periods (W, M, MS, Q, QS, Y, YS) and
    B for business days; generated as a distributed range of numbers."""
    lo, hi = datetime.fromisoformat(start), datetime.fromisoformat(end)
    first = F.lit(str(lo)).cast("timestamp_ntz")
    if freq in dates.CALENDAR:
        a, b = _calendar_index(lo, freq), _calendar_index(hi, freq)
        last = F.lit(str(hi)).cast("timestamp_ntz")
        labels = spark.range(a, b + 1).select(dates.bucket_label(F.col("id"), freq).alias(out))
        return labels.filter(F.col(out).between(first, last))
    step = dates.DAY if freq == "B" else dates.width(freq)
    count = (hi - lo) // timedelta(microseconds=step) + 1
    points = spark.range(max(count, 0)).select(
        dates.from_micros(dates.micros(first) + F.col("id") * F.lit(step)).alias(out)
    )
    return points.filter(F.weekday(out) < 5) if freq == "B" else points


def _calendar_index(t: datetime, freq: str) -> int:
    if freq == "W":
        return ((t.date() - date(1970, 1, 1)).days + 3) // 7
    if freq in ("M", "MS"):
        return t.year * 12 + t.month - 1
    if freq in ("Q", "QS"):
        return t.year * 4 + (t.month - 1) // 3
    return t.year


_PARTIAL = re.compile(r"^(\d{4})(?:-(\d{1,2})(?:-(\d{1,2})(?:[ T](\d{1,2})(?::(\d{2})(?::(\d{2}))?)?)?)?)?$")


def period_bounds(text: str) -> tuple[datetime, datetime]:
    """Start of the period a partial date names, and start of the following one."""
    match = _PARTIAL.match(text)
    if not match:
        raise ValueError(f"not a partial date: {text}")
    given = [int(g) for g in match.groups() if g is not None]
    start = datetime(*(given + [1, 1][len(given) - 1 :] if len(given) < 3 else given))
    if len(given) == 1:
        return start, datetime(start.year + 1, 1, 1)
    if len(given) == 2:
        return start, datetime(start.year + start.month // 12, start.month % 12 + 1, 1)
    unit = ["days", "hours", "minutes", "seconds"][len(given) - 3]
    return start, start + timedelta(**{unit: 1})


def time_slice(df: DataFrame, col: str, lo: str | None, hi: str | None) -> DataFrame:
    """Rows from the start of ``lo`` to the end of ``hi`` (partial dates such as 2024-01).

    Plain bounds on the column, so the slice reaches the scan."""
    if lo is not None:
        df = df.filter(F.col(col) >= F.lit(str(period_bounds(lo)[0])).cast("timestamp_ntz"))
    if hi is not None:
        df = df.filter(F.col(col) < F.lit(str(period_bounds(hi)[1])).cast("timestamp_ntz"))
    return df


def time_subset(
    df: DataFrame,
    col: str,
    period: str | None = None,
    months: Sequence[int] | None = None,
    weekdays: Sequence[int] | None = None,
    hours: tuple[int, int] | None = None,
) -> DataFrame:
    """Rows of one period, of some months or weekdays (Monday 0), or between two hours
    of the day (both included)."""
    if period is not None:
        df = time_slice(df, col, period, period)
    if months is not None:
        df = df.filter(F.month(col).isin(list(months)))
    if weekdays is not None:
        df = df.filter(F.weekday(col).isin(list(weekdays)))
    if hours is not None:
        df = df.filter(F.hour(col).between(*hours))
    return df


def time_parts(df: DataFrame, col: str, fmt: str = "yyyy/MM/dd HH:mm") -> DataFrame:
    """Calendar parts of a time and its formatted text."""
    ts = F.col(col)
    return df.withColumns(
        {
            "year": F.year(ts),
            "quarter": F.quarter(ts),
            "month": F.month(ts),
            "week": F.weekofyear(ts),
            "day": F.day(ts),
            "weekday": F.weekday(ts),
            "hour": F.hour(ts),
            "is_month_end": F.to_date(ts) == F.last_day(ts),
            "formatted": F.date_format(ts, fmt),
        }
    )


def _bucket_aggregate(function: str, col: str, order: Column) -> Column:
    known = F.when(F.col(col).isNotNull(), order)
    return {
        "sum": lambda: F.sum(col),
        "mean": lambda: F.avg(col),
        "min": lambda: F.min(col),
        "max": lambda: F.max(col),
        "std": lambda: F.stddev_samp(col),
        "count": lambda: F.count(col),
        "size": lambda: F.count(F.lit(1)),
        "first": lambda: F.min_by(col, known),
        "last": lambda: F.max_by(col, known),
    }[function]()


# The value of a bucket without rows; every other statistic is null there.
_EMPTY = {"sum": 0.0, "count": 0, "size": 0}


def _with_origin(df: DataFrame, by: list[str], col: str, freq: str, origin: str) -> DataFrame:
    """Adds the time (in microseconds) that buckets of a fixed width count from.

    ``start_day``: midnight of the first day, ``start``: the first time, each of the table or
    of the row's group; ``epoch``; or a time. Calendar periods count from themselves, and widths
    that divide a day have the same buckets from any midnight, so these look for no first day.
    """
    fixed = freq not in dates.CALENDAR
    if not fixed or origin == "epoch" or origin == "start_day" and dates.DAY % dates.width(freq) == 0:
        return df.withColumn(_ORIGIN, F.lit(0).cast("long"))
    if origin not in ("start_day", "start"):
        at = datetime.fromisoformat(origin)
        return df.withColumn(_ORIGIN, F.lit((at - datetime(1970, 1, 1)) // timedelta(microseconds=1)))
    first = F.min(col)
    start = dates.micros(F.date_trunc("day", first).cast("timestamp_ntz") if origin == "start_day" else first)
    if not by:
        return df.withColumn(_ORIGIN, scalar_of(df, start))
    return attach(df, df.groupBy(*by).agg(start.alias(_ORIGIN)), by, null_safe=True)


def resample(
    df: DataFrame,
    col: str,
    freq: str,
    spec: dict[str, tuple[str, str]],
    by=None,
    order_by: Sequence[str] = (),
    out: str = "bucket",
    origin: str = "start_day",
) -> DataFrame:
    """Aggregates per regular bucket from each group's first to its last bucket.

    Buckets of a fixed width count from ``origin``: the midnight before the table's (or the
    group's) first time, "start" (that time itself), "epoch", or a time given as text.

    ``spec`` maps a new name to (function, column): sum, mean, min, max, std, count,
    size, first, last. Buckets without rows are listed too (sum and counts 0, the rest
    null). ``order_by`` breaks ties of equal times for first and last."""
    by = as_list(by)
    timed = _with_origin(not_null(df, [*by, col]), by, col, freq, origin)
    index = dates.bucket_index(F.col(col), freq, F.col(_ORIGIN)).alias("_index")
    order = F.struct(col, *order_by)
    aggs = [_bucket_aggregate(f, c, order).alias(n) for n, (f, c) in spec.items()]
    counted = timed.groupBy(*[F.col(b) for b in by], index).agg(F.min(_ORIGIN).alias(_ORIGIN), *aggs)
    filled = {n: _EMPTY[f] for n, (f, _) in spec.items() if f in _EMPTY}
    joined = _spine(counted, by).join(counted.drop(_ORIGIN), [*by, "_index"], "left").na.fill(filled)
    return joined.select(*by, dates.bucket_label(F.col("_index"), freq, F.col(_ORIGIN)).alias(out), *spec)


def _spine(counted: DataFrame, by: list[str]) -> DataFrame:
    """Every bucket number between a group's first and last one."""
    edges = counted.groupBy(*by).agg(F.min("_index").alias("_lo"), F.max("_index").alias("_hi"), F.min(_ORIGIN).alias(_ORIGIN))
    block = F.lit(_BLOCK)
    blocks = F.sequence(F.floor(F.col("_lo") / block), F.floor(F.col("_hi") / block))
    first = F.greatest(F.col("_lo"), F.col("_block") * block)
    last = F.least(F.col("_hi"), F.col("_block") * block + (_BLOCK - 1))
    return (
        edges.filter(F.col("_lo").isNotNull())
        .withColumn("_block", F.explode(blocks))
        .repartition(*by, "_block")  # else one task would list every bucket of a long series
        .select(*by, _ORIGIN, F.explode(F.sequence(first, last)).alias("_index"))
    )


def resample_agg(
    df: DataFrame,
    col: str,
    freq: str,
    spec: dict[str, Sequence[str]],
    by=None,
    order_by: Sequence[str] = (),
    origin: str = "start_day",
) -> DataFrame:
    """Several statistics per column and bucket, named column_function; "ohlc" stands for
    open, high, low and close. ``origin`` as in :func:`resample`."""
    wanted: dict[str, tuple[str, str]] = {}
    for c, functions in spec.items():
        for f in functions:
            if f == "ohlc":
                names = {"open": "first", "high": "max", "low": "min", "close": "last"}
                wanted |= {f"{c}_{n}": (g, c) for n, g in names.items()}
            else:
                wanted[f"{c}_{f}"] = (f, c)
    return resample(df, col, freq, wanted, by, order_by, origin=origin)


def resample_upsample(
    df: DataFrame,
    col: str,
    freq: str,
    value: str,
    method: str | None = None,
    by=None,
    limit: int | None = None,
    origin: str = "start_day",
) -> DataFrame:
    """Finer regular times between a group's first and last time (times are unique), from the
    bucket that holds the first time on; ``origin`` as in :func:`resample`.

    ``method`` None leaves new times null; ffill, bfill and linear (by time) fill them.
    ``limit`` bounds how many new times in a row ffill and bfill reach."""
    by = as_list(by)
    known = not_null(df, [*by, col]).select(*by, F.col(col).cast("timestamp_ntz").alias(col), value)
    known_at = _with_origin(known, by, col, freq, origin)
    index = known_at.select(*by, dates.bucket_index(F.col(col), freq, F.col(_ORIGIN)).alias("_index"), _ORIGIN)
    label = dates.bucket_label(F.col("_index"), freq, F.col(_ORIGIN))
    grid = _spine(index, by).select(*by, label.alias(col), F.lit(True).alias("_grid"))
    both = grid.join(known, [*by, col], "full")
    if method is None:
        return both.filter("_grid").select(*by, col, value)
    at = dates.micros(F.col(col))
    near = with_known_neighbours(both, by, col, value, "_prev", "_next", "_row", at=at)
    before, after = F.col("_prev.value"), F.col("_next.value")
    share = F.try_divide(at - F.col("_prev.at"), F.col("_next.at") - F.col("_prev.at"))
    reach = {"ffill": F.col("_row") - F.col("_prev.pos"), "bfill": F.col("_next.pos") - F.col("_row")}
    filled = {
        "ffill": before,
        "bfill": after,
        "linear": F.coalesce(value, before + (after - before) * share, before),
    }[method]
    if limit is not None and method in reach:
        filled = F.when(reach[method] <= limit, filled)
    return near.filter("_grid").select(*by, col, filled.alias(value))


def bucket_rows(
    df: DataFrame, col: str, freq: str, out: str = "bucket", size: str = "bucket_rows", origin: str = "start_day"
) -> DataFrame:
    """Each row's bucket and how many rows share it (counts are joined back, so a busy
    bucket is not gathered). ``origin`` as in :func:`resample`."""
    timed = _with_origin(df, [], col, freq, origin)
    index = dates.bucket_index(F.col(col), freq, F.col(_ORIGIN))
    placed = timed.withColumn(out, dates.bucket_label(index, freq, F.col(_ORIGIN))).drop(_ORIGIN)
    counts = placed.groupBy(out).agg(F.count(F.lit(1)).alias(size))
    return attach(placed, counts, [out])
