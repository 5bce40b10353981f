"""Probabilities, losses, ensembling and pooling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import numeric
from ..plans.groups import as_list

# Up to this many dimensions every coordinate is its own sum in one aggregation; both ways
# give the same result.
WIDE_DIMENSIONS = 256


def softmax(df: DataFrame, cols: Sequence[str], outs: Sequence[str] | None = None) -> DataFrame:
    """Class scores to probabilities that add up to 1."""
    values = numeric.softmax([F.col(c) for c in cols])
    return df.withColumns(dict(zip(outs or cols, values)))


def log_loss(
    preds: DataFrame,
    labels: DataFrame,
    id_col: str,
    classes: Sequence[str],
    label: str,
    by=None,
    eps: float = 1e-15,
) -> DataFrame:
    """Mean negative log probability of the true class (``label`` is its position).

    Probabilities are rescaled to add up to 1 and kept within [eps, 1 - eps]. A label
    without a prediction is an error; predictions without a label are not scored."""
    by = as_list(by)
    extra = [c for c in [label, *by] if c not in preds.columns]
    joined = labels.select(id_col, *extra).join(preds.withColumn("_predicted", F.lit(True)), id_col, "left")
    total = sum((F.col(c) for c in classes[1:]), F.col(classes[0]))
    chosen = F.coalesce(*[F.when(F.col(label) == i, F.col(c)) for i, c in enumerate(classes)])
    missing = F.raise_error(F.concat(F.lit("no prediction for "), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    p = F.when(F.col("_predicted"), numeric.bounded(F.try_divide(chosen, total), eps, 1 - eps)).otherwise(missing)
    return joined.groupBy(*by).agg(F.avg(-F.ln(p)).alias("log_loss"), F.count(p).alias("n"))


def balanced_ce(df: DataFrame, id_col: str, target: str, p: str) -> DataFrame:
    """Class-balanced cross-entropy per row vector given as (id, target, p) entries.

    With T positives among n entries beta = 1 - T / n, and the loss is
    -(beta * sum(t ln p) + (1 - beta) * sum((1 - t) ln(1 - p))), logs at least -100; four
    sums per id suffice."""
    t, q = F.col(target), F.col(p)
    sums = df.groupBy(id_col).agg(
        F.sum(t).alias("_t"),
        F.count(F.lit(1)).alias("_n"),
        F.sum(t * numeric.floored_log(q)).alias("_pos"),
        F.sum((1 - t) * numeric.floored_log(1 - q)).alias("_neg"),
    )
    beta = 1 - F.col("_t") / F.col("_n")
    loss = -(beta * F.col("_pos") + (1 - beta) * F.col("_neg"))
    return sums.select(id_col, loss.alias("loss"))


def total_loss(losses: DataFrame) -> DataFrame:
    return losses.agg(F.sum("loss").alias("loss"), F.count("loss").alias("rows"))


def blend_nearest_pair(models: Sequence[DataFrame], id_col: str, scores: str) -> DataFrame:
    """Of three models' score arrays the mean of the two closest ones per id.

    Pairs are tried as first-second, second-third, third-first; the earliest wins ties."""
    named = [m.select(id_col, F.col(scores).alias(f"_m{i}")) for i, m in enumerate(models)]
    joined = named[0].join(named[1], id_col).join(named[2], id_col)
    pairs = [(0, 1), (1, 2), (2, 0)]
    gaps = [numeric.distance(F.col(f"_m{i}"), F.col(f"_m{j}")) for i, j in pairs]
    measured = joined.withColumn("_gaps", F.array(*gaps))
    pair = (F.array_position("_gaps", F.array_min("_gaps")) - 1).cast("int")
    blends = [numeric.mean_vector(F.col(f"_m{i}"), F.col(f"_m{j}")) for i, j in pairs]
    chosen = F.when(F.col("pair") == 0, blends[0]).when(F.col("pair") == 1, blends[1]).otherwise(blends[2])
    return measured.withColumn("pair", pair).select(id_col, "pair", chosen.alias(scores))


def masked_mean_pool(df: DataFrame, id_col: str, vector: str, mask: Column, dim: int, floor: float = 1e-9) -> DataFrame:
    """Mean of the vectors with mask 1 per id: array column ``pooled``.

    Coordinates are summed before the shuffle, so a hot id sends one row per task. A vector
    of more than ``dim`` coordinates is an error."""
    m = mask.cast("double")
    fits = F.col(vector).isNull() | (F.size(vector) <= dim)
    df = df.withColumn(vector, F.when(fits, F.col(vector)).otherwise(F.raise_error(F.lit(f"a vector has more than {dim} coordinates"))))
    weight = F.greatest(F.sum(m), F.lit(floor))
    if dim <= WIDE_DIMENSIONS:
        sums = [F.sum(F.get(F.col(vector), F.lit(i)).cast("double") * m).alias(f"_{i}") for i in range(dim)]
        pooled = F.array(*[F.col(f"_{i}") / F.col("_w") for i in range(dim)])
        return df.groupBy(id_col).agg(*sums, weight.alias("_w")).select(id_col, pooled.alias("pooled"))
    flat = df.select(id_col, m.alias("_m"), F.posexplode(vector).alias("_pos", "_x"))
    mean = F.sum(F.col("_x") * F.col("_m")) / F.greatest(F.sum("_m"), F.lit(floor))
    cells = flat.groupBy(id_col, "_pos").agg(mean.alias("_v"))
    ordered = F.array_sort(F.collect_list(F.struct("_pos", "_v")))  # dim entries per id
    return cells.groupBy(id_col).agg(F.transform(ordered, lambda e: e["_v"]).alias("pooled"))
