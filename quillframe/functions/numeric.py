"""Numeric column functions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def bounded(x: Column, low=None, high=None) -> Column:
    """Clip to [low, high]; null stays null (least/greatest would skip it)."""
    out = x
    if high is not None:
        out = F.when(x > high, F.lit(high)).otherwise(out)
    if low is not None:
        out = F.when(x < low, F.lit(low)).otherwise(out)
    return out


def natural_log(x: Column) -> Column:
    """ln with -infinity at zero and NaN below it, as floating-point log defines."""
    x = x.cast("double")
    return (
        F.when(x == 0, F.lit(float("-inf"))).when(x < 0, F.lit(float("nan"))).otherwise(F.ln(x))
    )


def softmax(scores: list[Column]) -> list[Column]:
    """Probabilities of each score, shifted by the largest so that exp cannot overflow."""
    top = F.greatest(*scores)
    powers = [F.exp(s - top) for s in scores]
    total = reduce(add, powers)
    return [p / total for p in powers]


def floored_log(p: Column, floor: float = -100.0) -> Column:
    """ln(p), never below ``floor``; null stays null."""
    return F.when(p.isNull(), None).when(p <= 0, F.lit(floor)).otherwise(
        F.greatest(F.ln(p), F.lit(floor))
    )


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two equally long arrays."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, s: acc + s))


def mean_vector(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: (x + y) / F.lit(2.0))


def compare(op: str, a: Column, b: Column) -> Column:
    """One of < <= > >= == != by name."""
    return {
        "<": lambda: a < b,
        "<=": lambda: a <= b,
        ">": lambda: a > b,
        ">=": lambda: a >= b,
        "==": lambda: a == b,
        "!=": lambda: a != b,
    }[op]()


def arithmetic(op: str, a: Column, b: Column) -> Column:
    """One of + - * / by name; division by zero gives null."""
    return {
        "+": lambda: a + b,
        "-": lambda: a - b,
        "*": lambda: a * b,
        "/": lambda: F.try_divide(a, b),
    }[op]()
