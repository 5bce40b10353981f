"""Timestamp column functions, independent of the session time zone."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

DAY = 86_400_000_000
_UNITS = {"s": 1_000_000, "min": 60_000_000, "h": 3_600_000_000, "D": DAY}
CALENDAR = {"W", "MS", "M", "QS", "Q", "YS", "Y"}


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of the wall-clock time."""
    days = F.unix_date(F.to_date(ts)).cast("long")
    seconds = (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    minutes = (F.hour(ts) * 60 + F.minute(ts)).cast("long")
    return days * DAY + minutes * 60_000_000 + seconds


def from_micros(us: Column) -> Column:
    """Inverse of :func:`micros`, without time zone."""
    days = F.floor(us / F.lit(DAY)).cast("int")
    seconds = F.pmod(us, F.lit(DAY)).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(8,0)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    zero = F.lit(0)
    return epoch + F.make_dt_interval(days, zero, zero, seconds.cast("decimal(18,6)"))


def width(freq: str) -> int:
    """Microseconds of a fixed-width frequency such as 30s, 15min, 6h, 2D."""
    match = re.fullmatch(r"(\d*)(s|min|h|D)", freq)
    if not match:
        raise ValueError(f"not a fixed-width frequency: {freq}")
    return int(match[1] or 1) * _UNITS[match[2]]


def bucket_index(ts: Column, freq: str, origin: Column | None = None) -> Column:
    """Running number of the bucket a time falls into.

    Fixed widths count from ``origin`` (microseconds; 1970-01-01 midnight); W counts weeks
    ending on Sunday, M/MS months, Q/QS quarters and Y/YS years.
    """
    if freq == "W":
        return F.floor((F.unix_date(F.to_date(ts)) + 3) / 7).cast("long")
    if freq in ("M", "MS"):
        return (F.year(ts) * 12 + F.month(ts) - 1).cast("long")
    if freq in ("Q", "QS"):
        return (F.year(ts) * 4 + F.quarter(ts) - 1).cast("long")
    if freq in ("Y", "YS"):
        return F.year(ts).cast("long")
    at = micros(ts) if origin is None else micros(ts) - origin
    return F.floor(at / F.lit(width(freq))).cast("long")


def bucket_label(index: Column, freq: str, origin: Column | None = None) -> Column:
    """The time that names a bucket: its start, or for W, M, Q and Y its last day."""
    if freq == "W":
        return F.date_from_unix_date((index * 7 + 3).cast("int")).cast("timestamp_ntz")
    per_year = {"M": 12, "MS": 12, "Q": 4, "QS": 4, "Y": 1, "YS": 1}.get(freq)
    if per_year is None:
        start = index * F.lit(width(freq))
        return from_micros(start if origin is None else start + origin)
    months = 12 // per_year
    year = F.floor(index / per_year).cast("int")
    month = (F.pmod(index, F.lit(per_year)) * months + 1).cast("int")
    start = F.make_date(year, month, F.lit(1))
    if freq.endswith("S"):
        return start.cast("timestamp_ntz")
    return F.last_day(F.add_months(start, months - 1)).cast("timestamp_ntz")


def business_shift(day: Column, n: int) -> Column:
    """Move a date by n business days (Monday to Friday).

    Going forward a weekend date counts from the Friday before it, going back from
    the Monday after it, so one step always lands on the adjacent business day; n = 0
    rolls a weekend date on to Monday.
    """
    weekday = F.weekday(day)
    if n > 0:
        base = F.date_sub(day, F.greatest(weekday - 4, F.lit(0)))
        wd = F.least(weekday, F.lit(4))
        return F.date_add(base, (n + 2 * F.floor((wd + n) / 5)).cast("int"))
    if n < 0:
        base = F.date_add(day, F.when(weekday > 4, 7 - weekday).otherwise(0))
        wd = F.when(weekday > 4, 0).otherwise(weekday)
        return F.date_add(base, (n + 2 * F.floor((wd + n) / 5)).cast("int"))
    return F.date_add(day, F.when(weekday > 4, 7 - weekday).otherwise(0))
