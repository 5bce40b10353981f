"""Models fitted by Spark ML; predictions come back as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..session import ensure_checkpoint_dir


def linear_head(
    df: DataFrame,
    id_col: str,
    features: str,
    label: str,
    score_on: DataFrame | None = None,
    max_iter: int = 50,
    reg: float = 0.0,
) -> DataFrame:
    """Multinomial linear classifier on an array column.

    Returns id, label, prediction and the class probabilities (array). The fit sends
    gradients up a tree of partial sums; rows never reach the driver."""

    def vectors(table: DataFrame) -> DataFrame:
        keep = [c for c in (id_col, label) if c in table.columns]
        return table.select(*keep, array_to_vector(F.col(features).cast("array<double>")).alias("_x"))

    model = LogisticRegression(
        featuresCol="_x", labelCol=label, family="multinomial", maxIter=max_iter, regParam=reg, aggregationDepth=3
    ).fit(vectors(df))
    scored = model.transform(vectors(df if score_on is None else score_on))
    return _predictions(scored, id_col, label)


def boosted_trees(
    df: DataFrame,
    id_col: str,
    features: Sequence[str],
    label: str,
    score_on: DataFrame | None = None,
    rounds: int = 20,
    rate: float = 1.0,
    depth: int = 1,
    seed: int = 0,
) -> DataFrame:
    """Boosted trees for a 0/1 label; missing features count as 0 on both sides.

    Rounds are sequential jobs, so the default is small; raise ``rounds`` as needed."""
    ensure_checkpoint_dir(df.sparkSession)  # lets the fit cut its lineage every few rounds
    assembler = VectorAssembler(inputCols=list(features), outputCol="_x")

    def vectors(table: DataFrame) -> DataFrame:
        return assembler.transform(table.na.fill(0, list(features)))

    model = GBTClassifier(
        featuresCol="_x", labelCol=label, maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed
    ).fit(vectors(df))
    scored = model.transform(vectors(df if score_on is None else score_on))
    return _predictions(scored, id_col, label)


def _predictions(scored: DataFrame, id_col: str, label: str) -> DataFrame:
    keep = [c for c in (id_col, label) if c in scored.columns]
    prediction = F.col("prediction").cast("int").alias("prediction")
    return scored.select(*keep, prediction, vector_to_array("probability").alias("probability"))
