"""Cutting lineage so that a lost executor never changes a result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir


def scratch_path(df_or_spark, kind: str) -> str:
    """A new folder below the shared checkpoint folder."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{kind}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows as a table into the shared checkpoint folder and read it back.

    Needed wherever a row carries the partition it happened to be in: after this the
    value is data, and a retried task reads it instead of computing it anew. Unlike a
    row-wise checkpoint the table keeps column pruning, and its known size lets Spark
    pick a broadcast join when it is small.
    """
    path = scratch_path(df, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
