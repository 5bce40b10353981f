"""Comma- and tab-separated files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..plans.groups import all_of, as_list


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    line_breaks: bool = False,
) -> DataFrame:
    """Delimited text with a declared schema; without one, types are inferred by an
    extra pass over the data. Quoted values may hold separators, and with ``line_breaks``
    line breaks too; then a file is read by one task, so keep files small
    (:func:`write_csv` writes one per partition)."""
    reader = spark.read.options(
        header=header, sep=sep, quote='"', escape='"', multiLine=line_breaks, mode="FAILFAST"
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    header: bool = True,
) -> DataFrame:
    """Tab-separated text."""
    return read_csv(spark, path, schema, header, sep="\t")


def with_keys(df: DataFrame, key_cols, verify: bool = True) -> DataFrame:
    """Key columns first; with ``verify`` a repeated or missing key is an error.

    The check is one grouped count over the key columns (an action)."""
    keys = as_list(key_cols)
    if verify:
        missing = F.max(F.when(all_of([F.col(k).isNotNull() for k in keys]), 0).otherwise(1))
        worst = (
            df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.max("_n").alias("repeats"), missing.alias("missing"))
            .first()
        )
        if (worst["repeats"] or 0) > 1 or worst["missing"]:
            raise ValueError(f"{keys} do not identify the rows")
    return df.select(*keys, *[c for c in df.columns if c not in keys])


def read_keyed_csv(spark, path, key_cols, schema=None, header: bool = True) -> DataFrame:
    """:func:`read_csv` followed by :func:`with_keys`."""
    return with_keys(read_csv(spark, path, schema, header), key_cols)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    """Headered files, one per partition, written by the executors in parallel."""
    df.write.mode(mode).options(
        header=True,
        sep=sep,
        quote='"',
        escape='"',
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    ).csv(path)
