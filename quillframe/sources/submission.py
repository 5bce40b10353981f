"""Prediction files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def build_submission(
    template: DataFrame, preds: DataFrame, id_col: str, classes: Sequence[str]
) -> DataFrame:
    """The template with its class columns overwritten by predictions of the same id.

    Matching is by id, never by position; ids without a prediction keep the
    template's values, and the column order is id then classes."""
    given = preds.select(id_col, *[F.col(c).alias(f"_pred_{c}") for c in classes])
    filled = [F.coalesce(f"_pred_{c}", c).alias(c) for c in classes]
    return template.join(given, id_col, "left").select(id_col, *filled)
