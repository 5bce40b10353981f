"""Joins and key-aligned combination of tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.dates import micros
from ..plans.groups import all_of, as_list, attach, kept_or_none
from ..plans.lineage import cut_lineage
from ..plans.ordering import with_position, with_running


# A key of more rows on a side that Spark cannot split is joined apart from the others; there
# are at most so many of them, the most frequent ones.
HOT_JOIN_ROWS = 1_000_000
HOT_JOIN_KEYS = 256
# Pairs of rows and intervals that one task looks at; sorting a row counts as so many of them.
PAIRS_PER_TASK = 10_000_000
PAIRS_PER_ROW = 10
# Meetings of intervals and blocks that one task lists.
PIECES_PER_TASK = 500_000
# Rows of a block that intervals meet; a merge join keeps up to 4,096 rows of a key at hand.
LEAST_BLOCK, LARGEST_BLOCK = 64, 2_048


def merge(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] | None = None,
    how: str = "inner",
    left_on: str | Sequence[str] | None = None,
    right_on: str | Sequence[str] | None = None,
    suffixes: tuple[str, str] = ("_x", "_y"),
    validate: str | None = None,
    indicator: str | None = None,
    nulls_match: bool = False,
) -> DataFrame:
    """Equi-join with table semantics.

    ``on`` keys appear once in the result; with ``left_on``/``right_on`` both sides'
    keys are kept. Other columns of equal name take the suffixes. ``validate`` is
    1:1, 1:m, m:1 or m:m and is checked by grouped counts (an action).
    ``indicator`` names a column holding left_only, right_only or both.

    Spark can split a hot key at run time only on the side an outer join preserves. So a
    sketch of the other side's keys (of both sides for an outer join), unless ``validate``
    proves them unique, names keys that may have more than HOT_JOIN_ROWS rows, at most
    HOT_JOIN_KEYS. All other rows take the plain outer join; those of hot keys an inner join,
    whose two sides can both be split, plus the rows without partner.
    """
    if how not in ("inner", "left", "right", "outer"):
        raise ValueError(f"unknown join {how}")
    keys_l, keys_r = as_list(left_on if on is None else on), as_list(right_on if on is None else on)
    if validate:
        _check(left, keys_l, validate.split(":")[0], "left")
        _check(right, keys_r, validate.split(":")[1], "right")

    shared = set(keys_l) & set(keys_r) if on is not None else set()
    clash = (set(left.columns) & set(right.columns)) - shared
    out_l = {c: c + suffixes[0] if c in clash else c for c in left.columns}
    out_r = {c: c + suffixes[1] if c in clash else c for c in right.columns}
    here = F.lit(True)
    side_l = left.select(*[F.col(c).alias(f"_l_{c}") for c in left.columns], here.alias("_in_l"))
    side_r = right.select(*[F.col(c).alias(f"_r_{c}") for c in right.columns], here.alias("_in_r"))
    names_l, names_r = [f"_l_{k}" for k in keys_l], [f"_r_{k}" for k in keys_r]
    types = [(side_l.schema[a].dataType, side_r.schema[b].dataType) for a, b in zip(names_l, names_r)]
    pairs = [(F.col(a), F.col(b)) for a, b in zip(names_l, names_r)]
    match = all_of([a.eqNullSafe(b) if nulls_match else a == b for a, b in pairs])

    def shaped(joined: DataFrame) -> DataFrame:
        have = set(joined.columns)
        known = {f.name: f.dataType for side in (side_l, side_r) for f in side.schema}
        get = lambda name: F.col(name) if name in have else F.lit(None).cast(known[name])
        cols = []
        for c in left.columns:
            value = get(f"_l_{c}")
            if c in shared:
                value = F.coalesce(value, get(f"_r_{c}"))
            cols.append(value.alias(out_l[c]))
        cols += [get(f"_r_{c}").alias(out_r[c]) for c in right.columns if c not in shared]
        if indicator:
            alone = F.when(get("_in_l").isNull(), "right_only").when(get("_in_r").isNull(), "left_only")
            cols.append(alone.otherwise("both").alias(indicator))
        return joined.select(*cols)

    def parted_join(rows_l: DataFrame, rows_r: DataFrame) -> DataFrame:
        out = shaped(rows_l.join(rows_r, match, "inner"))
        if how in ("left", "outer"):
            out = out.unionByName(shaped(rows_l.join(rows_r.select(*names_r).distinct(), match, "left_anti")))
        if how in ("right", "outer"):
            out = out.unionByName(shaped(rows_r.join(rows_l.select(*names_l).distinct(), match, "left_anti")))
        return out

    hashed = {"l": _key_hash(names_l, [a if a == b else None for a, b in types]), "r": _key_hash(names_r, [b if a == b else None for a, b in types])}
    hot: set[int] = set()
    if how in ("left", "outer") and not (validate or "").endswith("1"):
        hot |= _hot_hashes(side_r, hashed["r"])
    if how in ("right", "outer") and not (validate or "").startswith("1"):
        hot |= _hot_hashes(side_l, hashed["l"])
    if not hot:
        return shaped(side_l.join(side_r, match, "full" if how == "outer" else how))
    cold_l, hot_l = (side_l.filter(c) for c in (~hashed["l"].isin(*hot), hashed["l"].isin(*hot)))
    cold_r, hot_r = (side_r.filter(c) for c in (~hashed["r"].isin(*hot), hashed["r"].isin(*hot)))
    cold = shaped(cold_l.join(cold_r, match, "full" if how == "outer" else how))
    return cold.unionByName(parted_join(hot_l, hot_r))


def _key_hash(names: Sequence[str], types: Sequence[T.DataType | None]) -> Column:
    """The same number for equal keys on both sides; keys of different types count as text of
    doubles, and zeros as one."""

    def plain(name: str, kind: T.DataType | None) -> Column:
        c = F.col(name)
        if kind is None:
            c = F.coalesce(c.try_cast("double").cast("string"), c.cast("string"))
            return F.when(c == "-0.0", "0.0").otherwise(c)
        return c + F.lit(0.0).cast(kind) if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else c

    return F.xxhash64(*[plain(n, t) for n, t in zip(names, types)])


def _hot_hashes(df: DataFrame, hashed: Column) -> set[int]:
    """Hashes of keys that may have more than HOT_JOIN_ROWS rows, from one scan of the keys.

    The sketch counts too many rather than too few, and misses no key with a larger share of the
    rows than one of its counters has.
    """
    top = F.expr(f"approx_top_k(_key_hash, {HOT_JOIN_KEYS}, {64 * HOT_JOIN_KEYS})")
    found = df.select(hashed.alias("_key_hash")).agg(top.alias("top")).first()["top"] or []
    return {r["item"] for r in found if r["count"] > HOT_JOIN_ROWS}


def _check(df: DataFrame, keys: Sequence[str], side: str, name: str) -> None:
    if side != "1":
        return
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    if not repeated.isEmpty():
        raise ValueError(f"keys {list(keys)} of the {name} table are not unique")


def key_join(left: DataFrame, rights: Sequence[tuple[DataFrame, str, str]], how: str = "left") -> DataFrame:
    """Join several tables one after another: (table, key on the left, its own key)."""
    out = left
    for right, left_key, right_key in rights:
        renamed = right.withColumnRenamed(right_key, "_joined_key")
        out = out.join(renamed, out[left_key] == renamed["_joined_key"], how).drop("_joined_key")
    return out


def semi_filter(df: DataFrame, ids: DataFrame, on: str, ids_col: str | None = None) -> DataFrame:
    """Rows whose key occurs in ``ids``."""
    return df.join(_id_set(ids, on, ids_col), on, "left_semi")


def anti_filter(df: DataFrame, ids: DataFrame, on: str, ids_col: str | None = None) -> DataFrame:
    """Rows whose key does not occur in ``ids`` (a null key never occurs)."""
    return df.join(_id_set(ids, on, ids_col), on, "left_anti")


def _id_set(ids: DataFrame, on: str, ids_col: str | None) -> DataFrame:
    return ids.select(F.col(ids_col or on).alias(on)).distinct()


def _measure(kind: T.DataType) -> Callable[[Column], Column]:
    """Numbers, dates and times as doubles, infinite ones as null."""
    if isinstance(kind, T.DateType):
        plain = lambda x: F.unix_date(x).cast("double")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        plain = lambda x: micros(x).cast("double")
    else:
        plain = lambda x: x.cast("double")
    return lambda x: F.when(F.abs(plain(x)) < float("inf"), plain(x))


def _closed_ends(closed: str) -> tuple[bool, bool]:
    if closed not in ("left", "right", "both", "neither"):
        raise ValueError(f"closed is left, right, both or neither, not {closed}")
    return closed in ("left", "both"), closed in ("right", "both")


def interval_lookup(
    df: DataFrame, intervals: DataFrame, col: str, lo: str = "lo", hi: str = "hi", closed: str = "right"
) -> DataFrame:
    """Each row with every interval that holds its value (closed left/right/both/neither).

    Values and bounds are numbers, dates or times; a null or infinite bound leaves that end
    open. A null or infinite value lies in no interval.

    The rows are numbered in the order of their values, so an interval holds a stretch of numbers,
    which :func:`interval_counts` finds too. Numbers are cut into blocks, about as long as half a
    stretch; an interval meets the blocks that it overlaps, and only in the two at its ends are
    there rows that it does not hold. So work grows with rows, intervals and results, however
    wide or alike intervals are. There are as many tasks as that work needs; a block that very
    many intervals overlap is dealt out to several.
    """
    measure = _measure(df.schema[col].dataType)
    valued = df.withColumn("_value", measure(F.col(col))).filter(F.col("_value").isNotNull())
    placed = with_position(valued, ["_value"], "_at").drop("_value")
    held = _stretches(df, intervals, col, lo, hi, closed).filter("_first < _end")
    held = cut_lineage(held.select(*intervals.columns, "_first", "_end"))
    total = held.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("_end") - F.col("_first")), F.lit(0)).alias("pairs")).first()
    half = total["pairs"] // (2 * max(total["n"], 1))
    rows_of_block = min(max(1 << half.bit_length(), LEAST_BLOCK), LARGEST_BLOCK)
    work = total["pairs"] + 2 * rows_of_block * total["n"] + PAIRS_PER_ROW * placed.count()
    tasks = 1 + work // PAIRS_PER_TASK

    block = lambda x: F.floor(x / F.lit(rows_of_block)).cast("long")
    spread = held.repartition(1 + work // rows_of_block // PIECES_PER_TASK) if tasks > 1 else held
    pieces = spread.withColumn("_block", F.explode(F.sequence(block(F.col("_first")), block(F.col("_end") - 1))))
    rows = placed.withColumn("_block", block(F.col("_at")))
    most = max(1, PAIRS_PER_TASK // rows_of_block)
    parts = pieces.groupBy("_block").agg(F.ceil(F.count(F.lit(1)) / F.lit(most)).cast("int").alias("_parts"))
    hot = kept_or_none(parts.filter("_parts > 1")) if total["n"] > most else None
    key = ["_block"]
    if hot is not None:
        key = ["_block", "_part"]
        several = F.coalesce(F.col("_parts"), F.lit(1))
        own = F.pmod(F.xxhash64("_first", "_end", F.monotonically_increasing_id()), several).cast("int")
        pieces = attach(pieces, hot, ["_block"]).withColumn("_part", own).drop("_parts")
        rows = attach(rows, hot, ["_block"]).withColumn("_part", F.explode(F.sequence(F.lit(0), several - 1))).drop("_parts")
    # The rows of a block stand on the right, where a merge join keeps those of one key.
    found = pieces.repartition(tasks, *key).join(rows.repartition(tasks, *key), key)
    found = found.filter((F.col("_at") >= F.col("_first")) & (F.col("_at") < F.col("_end")))
    return found.select(*df.columns, *[c for c in intervals.columns if c not in df.columns])


def _stretches(df: DataFrame, intervals: DataFrame, col: str, lo: str, hi: str, closed: str) -> DataFrame:
    """The intervals with ``_first`` and ``_end``: numbers from 0, in the order of values, of the
    first row that they hold and of the one after the last; not ascending where there is none.

    Values are counted, then values and bounds put in one order. The running count is split like
    any order over a whole table."""
    left_closed, right_closed = _closed_ends(closed)
    measure = _measure(df.schema[col].dataType)
    values = df.select(measure(F.col(col)).alias("_at")).filter(F.col("_at").isNotNull())
    values = values.groupBy("_at").agg(F.count(F.lit(1)).alias("_rows")).withColumn("_side", F.lit(1))
    marked = intervals.withColumns({"_low": measure(F.col(lo)), "_high": measure(F.col(hi))})
    pairs = marked.select("_low", "_high").distinct()
    # A bound stands before (0) or after (2) the values equal to it; an open start before all.
    start = F.struct(F.col("_low").alias("_at"), F.lit(0 if left_closed else 2).alias("_side"), F.lit(True).alias("_starts"))
    end = F.struct(F.coalesce("_high", F.lit(float("inf"))).alias("_at"), F.lit(2 if right_closed else 0).alias("_side"), F.lit(False).alias("_starts"))
    bounds = pairs.select("_low", "_high", F.explode(F.array(start, end)).alias("_bound")).select("_low", "_high", "_bound.*")
    bounds = bounds.filter(F.col("_at").isNotNull()).withColumn("_rows", F.lit(0).cast("long"))
    events = values.unionByName(bounds, allowMissingColumns=True)
    running = with_running(events, None, ["_at", "_side"], {"_upto": ("sum", "_rows")}).filter("_starts IS NOT NULL")
    upto = lambda starts: F.coalesce(F.max(F.when(F.col("_starts") == starts, F.col("_upto"))), F.lit(0))
    found = running.groupBy("_low", "_high").agg(upto(True).alias("_first"), upto(False).alias("_end"))
    return attach(marked, found, ["_low", "_high"], null_safe=True)


def interval_counts(
    df: DataFrame, intervals: DataFrame, col: str, lo: str = "lo", hi: str = "hi", closed: str = "right", out: str = "n"
) -> DataFrame:
    """Each interval with the number of rows whose value it holds, without listing them.

    Bounds and values as in :func:`interval_lookup`. An interval holds as many rows as lie before
    its end and not before its start.
    """
    found = _stretches(df, intervals, col, lo, hi, closed)
    return found.withColumn(out, F.greatest(F.col("_end") - F.col("_first"), F.lit(0))).select(*intervals.columns, out)


def combine(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    func: Callable[[Column, Column], Column],
) -> DataFrame:
    """Column-wise combination over the union of keys and columns; keys are unique."""
    keys = as_list(key)
    names_l = [c for c in left.columns if c not in keys]
    names_r = [c for c in right.columns if c not in keys]
    a = left.select(*keys, *[F.col(c).alias(f"_l_{c}") for c in names_l])
    b = right.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in names_r])
    types = {f.name: f.dataType for f in right.schema} | {f.name: f.dataType for f in left.schema}

    def side(prefix: str, names: list[str], c: str) -> Column:
        return F.col(f"{prefix}{c}") if c in names else F.lit(None).cast(types[c])

    names = names_l + [c for c in names_r if c not in names_l]
    values = [func(side("_l_", names_l, c), side("_r_", names_r, c)).alias(c) for c in names]
    return a.join(b, keys, "full").select(*keys, *values)


def combine_first(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Nulls of the left table filled from the right one, over the union of keys."""
    return combine(left, right, key, lambda a, b: F.coalesce(a, b))


def update(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Left table with its values overwritten by the right table's non-null ones."""
    keys = as_list(key)
    shared = [c for c in right.columns if c not in keys and c in left.columns]
    newer = right.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in shared])
    joined = left.join(newer, keys, "left")
    return joined.select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in shared else F.col(c) for c in left.columns]
    )
