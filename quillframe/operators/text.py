"""Operators on text columns; null texts give null unless said otherwise."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import text as fn
from ..plans.groups import as_list, largest_group
from ..plans.ordering import Order, as_keys, with_group_position


# A group of more rows than this is not gathered into one string.
ROWS_PER_STRING = 200_000


def to_string(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def split_text(
    df: DataFrame, col: str, pat: str, out: str, n: int = -1, expand: int | None = None
) -> DataFrame:
    """Split at a pattern, at most ``n`` times; ``expand`` spreads the first pieces over
    that many columns out_0, out_1, ... (null where a text has fewer)."""
    pieces = F.split(F.col(col), pat, n + 1 if n >= 0 else -1)
    if expand is None:
        return df.withColumn(out, pieces)
    return df.withColumns({f"{out}_{i}": F.get(pieces, F.lit(i)) for i in range(expand)})


def cat(df: DataFrame, cols: Sequence[str], out: str, sep: str = "", na_rep: str | None = None) -> DataFrame:
    """Concatenate columns; a null makes the result null unless ``na_rep`` replaces it."""
    parts = [F.col(c).cast("string") for c in cols]
    if na_rep is not None:
        parts = [F.coalesce(p, F.lit(na_rep)) for p in parts]
    spaced = [x for p in parts for x in (F.lit(sep), p)][1:]
    return df.withColumn(out, F.concat(*spaced))


def cat_all(
    df: DataFrame, by, col: str, sep: str, order_by: Order, out: str = "text", piece_rows: int | None = None
) -> DataFrame:
    """A whole column joined to one string per group, in order, nulls skipped.

    One string must fit into one row, so a group above ``ROWS_PER_STRING`` rows is
    refused; ``piece_rows`` gives such groups as numbered pieces of that many rows,
    which joined with ``sep`` are the whole string."""
    by = as_list(by)
    known = df.filter(F.col(col).isNotNull())
    if piece_rows is None:
        if largest_group(known, by) > ROWS_PER_STRING:
            raise ValueError("a group is too long for one string; give piece_rows")
        pieces, keys = known, by
    else:
        placed = with_group_position(known, by, order_by, "_at")
        pieces = placed.withColumn("piece", F.floor(F.col("_at") / F.lit(piece_rows)).cast("long"))
        keys = [*by, "piece"]
    names = as_keys(order_by)
    if any(descending for _, descending in names):
        raise ValueError("cat_all joins in ascending order")
    entry = F.struct(*[F.col(n) for n, _ in names], F.col(col).alias("_text"))
    ordered = F.array_sort(F.collect_list(entry))
    return pieces.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda e: e["_text"]), sep).alias(out))


def replace_text(df: DataFrame, col: str, pat: str, repl: str, regex: bool = False) -> DataFrame:
    """Replace every occurrence of a literal text or a pattern."""
    if regex:
        return df.withColumn(col, F.regexp_replace(col, pat, repl))
    return df.withColumn(col, F.replace(F.col(col), F.lit(pat), F.lit(repl)))


def replace_groups(df: DataFrame, col: str, pat: str, repl: str | Callable[[object], str]) -> DataFrame:
    """Replacement built from capture groups: a template with $1, $2, ..., or a
    function of the match, which runs on Arrow batches."""
    if isinstance(repl, str):
        return df.withColumn(col, F.regexp_replace(col, pat, repl))

    def replaced(texts: pd.Series) -> pd.Series:
        return texts.str.replace(pat, repl, regex=True)

    return df.withColumn(col, F.pandas_udf(replaced, T.StringType())(col))


def extract(df: DataFrame, col: str, pat: str, names: Sequence[str]) -> DataFrame:
    """Groups of the first match, one column each; null where nothing matches or the group
    took no part in the match, empty where it matched nothing."""

    def group(i: int) -> Column:
        value = F.regexp_extract(col, pat, i)
        # A reference back to a group that took no part fails; to an empty one it succeeds.
        took_part = F.col(col).rlike(rf"\A(?>[\s\S]*?(?:{pat}))\{i}")
        return F.when(value != "", value).when(took_part, "")

    return df.withColumns({n: group(i) for i, n in enumerate(names, 1)})


def extract_all(df: DataFrame, col: str, pat: str, keep: Sequence[str], out: str = "value", group: int = 0) -> DataFrame:
    """One row per match with its 0-based number."""
    found = F.regexp_extract_all(F.col(col), F.lit(pat), F.lit(group))
    return df.select(*keep, F.posexplode(found).alias("match", out))


def contains(df: DataFrame, col: str, pat: str, out: str, na: bool | None = None) -> DataFrame:
    """Does the pattern occur anywhere? ``na`` is the answer for null texts."""
    return _found(df, F.col(col).rlike(pat), out, na)


def match(df: DataFrame, col: str, pat: str, out: str, na: bool | None = None) -> DataFrame:
    """Does the text start with the pattern?"""
    return _found(df, F.col(col).rlike(rf"\A(?:{pat})"), out, na)


def _found(df: DataFrame, hit: Column, out: str, na: bool | None) -> DataFrame:
    return df.withColumn(out, hit if na is None else F.coalesce(hit, F.lit(na)))


_METHODS: dict[str, Callable[[Column], Column]] = {
    "strip": lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""),
    "lstrip": lambda x: F.regexp_replace(x, r"^\s+", ""),
    "rstrip": lambda x: F.regexp_replace(x, r"\s+$", ""),
    "lower": F.lower,
    "upper": F.upper,
    "swapcase": fn.swap_case,
    "capitalize": fn.capitalised,
}


def text_method(df: DataFrame, col: str, method: str, out: str | None = None) -> DataFrame:
    """strip, lstrip, rstrip, lower, upper, swapcase or capitalize."""
    return df.withColumn(out or col, _METHODS[method](F.col(col)))


def is_numeric(df: DataFrame, col: str, out: str) -> DataFrame:
    """True for a non-empty text of digits 0-9 only."""
    return df.withColumn(out, F.col(col).rlike(r"\A[0-9]+\z"))


def text_length(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, F.length(col).cast("long"))


def normalise_message(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Spaces removed and full-width punctuation folded (see functions.text)."""
    return df.withColumn(out or col, fn.message_text(F.col(col)))


def repair_corpus(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Misread encodings repaired and folded to ASCII; ASCII texts never leave the JVM."""
    return df.withColumn(out or col, fn.repaired(F.col(col)))


def repair_report(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Per group: rows, rows with non-ASCII characters, rows the repair changed."""
    repaired = df.select(*by, col).withColumn("_fixed", fn.repaired(F.col(col)))
    return repaired.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(col).rlike(fn.NON_ASCII)).alias("non_ascii"),
        F.count_if(F.col(col) != F.col("_fixed")).alias("changed"),
    )


def build_example(
    df: DataFrame, type_col: str, text_col: str, context_col: str, sep: str, max_len: int = 512
) -> DataFrame:
    """Model input: type, space, text, separator, context; adds ``text`` whole, its first
    ``max_len`` whitespace ``tokens`` and the ``n_tokens`` before the cut."""
    joined = F.concat(F.col(type_col), F.lit(" "), F.col(text_col), F.lit(sep), F.col(context_col))
    tokens = fn.words(F.col("text"))
    return (
        df.withColumn("text", joined)
        .withColumn("_tokens", tokens)
        .withColumn("n_tokens", F.size("_tokens").cast("long"))
        .withColumn("tokens", F.slice("_tokens", 1, max_len))
        .drop("_tokens")
    )
