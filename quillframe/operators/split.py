"""Group-wise splits and folds, batches and padding."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans.groups import attach, not_null, scalar_of
from ..plans.ordering import Order, key_names, with_position


def _shuffled(seed: int, group: str):
    """A repeatable random order of the groups."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(group).cast("string")))


def group_split(df: DataFrame, group: str, frac: float, seed: int = 42, out: str = "split") -> DataFrame:
    """Adds valid / train so that int(groups * frac) whole groups are held out.

    Rows without a group stay and get null."""
    names = not_null(df, [group]).select(group).distinct().withColumn("_hash", _shuffled(seed, group))
    placed = with_position(names, ["_hash", group], "_at")
    held = F.floor(scalar_of(placed, F.count(F.lit(1))) * F.lit(frac))
    sides = placed.select(group, F.when(F.col("_at") < held, "valid").otherwise("train").alias(out))
    return attach(df, sides, [group])


def group_kfold(df: DataFrame, group: str, k: int, seed: int = 42, out: str = "fold") -> DataFrame:
    """Adds a fold number such that groups stay whole and folds are of similar size.

    Groups, largest first, are dealt forwards and backwards over the folds. Rows without a
    group stay and get null."""
    sizes = not_null(df, [group]).groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    placed = with_position(sizes.withColumn("_hash", _shuffled(seed, group)), [("_n", "desc"), "_hash", group], "_at")
    step = F.pmod(F.col("_at"), F.lit(k))
    backwards = F.pmod(F.floor(F.col("_at") / F.lit(k)), F.lit(2)) == 1
    fold = F.when(backwards, F.lit(k - 1) - step).otherwise(step)
    return attach(df, placed.select(group, fold.cast("int").alias(out)), [group])


def with_batches(df: DataFrame, size: int, order_by: Order, out: str = "batch") -> DataFrame:
    """Consecutive batches of ``size`` rows in the given order."""
    return with_position(df, order_by, "_at").withColumn(
        out, F.floor(F.col("_at") / F.lit(size)).cast("long")
    ).drop("_at")


def batch_plan(df: DataFrame, length: str, size: int, order_by: Order) -> DataFrame:
    """Per batch: rows, longest row, padding needed to bring all rows to it, and the
    share of the padded batch that is padding."""
    needed = dict.fromkeys([length, *key_names(order_by)])
    batches = with_batches(df.select(*needed), size, order_by)
    padded = F.col("max_length") * F.col("rows")
    return (
        batches.groupBy("batch")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.max(length).alias("max_length"),
            F.sum(length).alias("_used"),
        )
        .withColumn("padding", padded - F.col("_used"))
        .withColumn("wasted", F.try_divide(F.col("padding"), padded))
        .drop("_used")
    )


def pad_sequences(
    df: DataFrame, col: str, batch: str, pad, side: str = "right", mask: str | None = "attention_mask"
) -> DataFrame:
    """Arrays padded to the longest of their batch, with a mask of 1 for real entries."""
    longest = df.groupBy(batch).agg(F.max(F.size(col)).alias("_longest"))
    joined = attach(df, longest, [batch], null_safe=True)
    missing = F.col("_longest") - F.size(col)

    def padded(values, filler):
        fill = F.array_repeat(filler, missing)
        return F.concat(values, fill) if side == "right" else F.concat(fill, values)

    element = df.schema[col].dataType.elementType
    added = {col: padded(F.col(col), F.lit(pad).cast(element))}
    if mask:
        added[mask] = padded(F.transform(col, lambda _: F.lit(1)), F.lit(0))
    return joined.withColumns(added).drop("_longest")
