"""Mixing sources to target weights with whole documents, by subset-sum budget fitting."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACES, cut_lineage, text_or_empty

WEIGHTS = (5, 2, 1)
# A source, and so each of its documents, is used at most this many times.
MOST = 3
SEED = 20240601
# Words of a source's budget that the dynamic programme fits exactly; the rest is handed out by share.
FIT_WORDS = 50_000
# Documents of one source and length that one task puts in order.
PART_ROWS = 50_000


def word_count(text: Column) -> Column:
    """Runs of anything but white space: as many as the starts of such runs."""
    squeezed = F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w"), SPACES, "")
    return F.char_length(squeezed).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Rows (source, source_size), one per source, with the words each should give.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all
    sizes; a target stops at ``most`` times its source's size and the excess is shared by
    weight. That is min(most * size, level * weight) at the one level where the sum fits:
    sources are ordered by the level at which they fill up, and the level is read off
    running sums.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")  # one row per source
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    named = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    named = named.withColumn("cap", (F.lit(float(most)) * F.col("source_size")))
    full = named.withColumn("fills", F.col("cap") / F.col("weight"))
    order = Window.orderBy("fills", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = full.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("capped"),
        F.sum("weight").over(onward).alias("open_weight"),
        F.sum(F.col("source_size").cast("double")).over(everything).alias("total"),
    ).withColumn("level", (F.col("total") - F.col("capped")) / F.col("open_weight"))
    # The first source, in that order, that does not fill up sets it; levels fall from there on.
    fits = F.when(F.col("level") <= F.col("fills"), F.col("level"))
    return levels.withColumn("level", F.max(fits).over(everything)).select(
        "source", "source_size", F.least("cap", F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight")).alias("target")
    )


def choose_counts(size: np.ndarray, count: np.ndarray, budget: int, fit_words: int = FIT_WORDS) -> np.ndarray:
    """How many documents of each size to take, so that their words come nearest the budget.

    ``size`` is positive and distinct, ``0 <= budget <= (size * count).sum()``. Every size
    first gives its share of all but ``fit_words`` words, rounded down, and what rounding
    leaves beyond twice as many goes to the largest. The rest is a bounded knapsack over sums
    up to what is left plus the largest size, solved for the nearest reachable sum.
    """
    total = int((size * count).sum())
    if not total or budget <= 0:
        return np.zeros(len(size), np.int64)
    if budget >= total:
        return count.astype(np.int64)
    taken = np.array([int(c) * max(0, budget - fit_words) // total for c in count], np.int64)
    left = budget - int((size * taken).sum())
    order = np.argsort(-size, kind="stable")
    for i in order:
        if left <= 2 * fit_words:
            break
        more = min(int(count[i] - taken[i]), max(0, (left - fit_words) // int(size[i])))
        taken[i] += more
        left -= more * int(size[i])
    # Reachable sums, and the piece that first reached each: pieces are powers of two of a
    # size's free documents, so a sum's earlier pieces never repeat a piece.
    limit = int(left + size.max())
    reached = np.zeros(limit + 1, bool)
    reached[0] = True
    by_piece = np.full(limit + 1, -1, np.int32)
    pieces: list[tuple[int, int]] = []
    for i in order:
        free, step = min(int(count[i] - taken[i]), limit // int(size[i])), 1
        while free > 0 and not reached[left]:
            step = min(step, free)
            weight = step * int(size[i])
            if weight <= limit:
                new = np.flatnonzero(reached[: limit + 1 - weight] & ~reached[weight:]) + weight
                by_piece[new] = len(pieces)
                reached[new] = True
                pieces.append((int(i), step))
            free -= step
            step *= 2
        if reached[left]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - left))])
    while at:
        i, step = pieces[by_piece[at]]
        taken[i] += step
        at -= step * int(size[i])
    return taken


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole rounds and extra documents for each size of one source (rows: its histogram).

    The last full round is left to the knapsack as well, which may take a document once, twice
    or not at all beyond the rounds before.
    """
    rows = rows.sort_values("size", kind="stable").reset_index(drop=True)
    size, count = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    total, most = int(rows["source_size"].iloc[0]), int(rows["most"].iloc[0])
    want = int(round(rows["target"].iloc[0]))
    rounds = max(0, min(want // total, most) - 1) if total else 0
    turns = min(2, most - rounds)
    extra = np.zeros(len(rows), np.int64)
    some = size > 0
    if some.any():
        extra[some] = choose_counts(size[some], count[some] * turns, want - rounds * total)
    return rows.assign(rounds=np.int64(rounds), extra=extra)[["source", "size", "n", "rounds", "extra"]]


def mix_sources(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    row_col: str | None = None,
) -> DataFrame:
    """One row per row of ``df``: the words that the mix takes of it.

    Returns ``id_col`` (and ``row_col``, a number of the caller's for each row), size (words), source, source_size, target and taken. Every document
    of a source is taken ``target // source_size - 1`` times (0 at least); for the remaining
    budget the source's histogram of exact sizes goes through :func:`choose_counts`, and of
    each size the documents that come first in a seeded order are taken once more. Documents are
    taken whole, so a source misses its target by at most what no sum of sizes can reach.

    Null texts and texts without words have size 0 and give 0 words; a null source is a
    source of its own; rows that agree in id and text are told apart by reading order. An
    empty table gives an empty result. Other columns play no part.

    The histogram of a source has a row per distinct size (at most the square root of twice
    its words), which is what one task sees. Numbering inside a size is split by hash, so
    a size shared by a third of all rows is no hot group.
    """
    text = text_or_empty(text_col)
    slim = cut_lineage(
        df.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{source_col}`").cast("string").alias("source"),
            word_count(text).alias("size"),
            F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), text).alias("draw"),
            (F.monotonically_increasing_id() if row_col is None else F.col(f"`{row_col}`")).alias("row"),
        )
    )
    sizes = slim.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = cut_lineage(sizes)
    targets = source_targets(sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most)
    same_source = F.col("h.source").eqNullSafe(F.col("t.source"))
    with_target = (
        sizes.alias("h").join(targets.alias("t"), same_source).select("h.*", "t.source_size", "t.target", F.lit(most).alias("most"))
    )
    quota = with_target.groupBy("source").applyInPandas(_fit_source, "source string, size long, n long, rounds long, extra long")
    quota = quota.withColumn("parts", F.ceil(F.col("n") / PART_ROWS))
    quota = cut_lineage(quota.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s"))

    rows = (
        slim.alias("d")
        .join(quota.alias("q"), F.col("d.source").eqNullSafe(F.col("q.source")) & (F.col("d.size") == F.col("q.size")))
        .select("d.*", "q.rounds", "q.extra", "q.n", "q.source_size", "q.target", F.pmod("d.draw", F.col("q.parts")).alias("part"))
    )
    # Place in the seeded order: by part, then by draw. Only sizes of several parts have offsets.
    parts = (
        slim.alias("d")
        .join(
            quota.filter("parts > 1").alias("q"),
            F.col("d.source").eqNullSafe(F.col("q.source")) & (F.col("d.size") == F.col("q.size")),
        )
        .groupBy("d.source", "d.size", F.pmod("d.draw", F.col("q.parts")).alias("part"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    before = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("source", "size", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("source", "size", "part").orderBy("draw", "id", "row")
    placed = rows.withColumn("place", F.row_number().over(within))
    joined = placed.alias("d").join(
        offsets.alias("o"),
        F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.size") == F.col("o.size")) & (F.col("d.part") == F.col("o.part")),
        "left",
    )
    extra, n = F.col("extra"), F.col("n")
    once_more = F.expr("extra DIV n") + (F.col("place") + F.coalesce(F.col("offset"), F.lit(0)) <= extra % n).cast("bigint")
    return joined.select(
        F.col("d.id").alias(id_col),
        *([] if row_col is None else [F.col("d.row").alias(row_col)]),
        "d.size",
        F.col("d.source").alias("source"),
        "source_size",
        "target",
        (F.col("d.size") * (F.col("rounds") + once_more)).alias("taken"),
    )
