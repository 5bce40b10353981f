"""Small parts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.lineage import cut_lineage, scratch_path

__all__ = ["SPACES", "cut_lineage", "descending", "fresh", "scratch_path", "text_or_empty"]

# White space as the contracts define it, as a class for regular expressions.
SPACES = r"[\x20\x09-\x0D]+"


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def descending(number: Column) -> Column:
    """A bigint that is larger the smaller the number is; no overflow, nulls stay null."""
    return F.bitwise_not(number.cast("bigint"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of the table has it (case is ignored)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
