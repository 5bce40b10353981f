"""A corpus pipeline of five stages; each is written as Parquet and read by the next.

Every stage takes what its predecessor kept and all but the last return the columns of
documents. Stages work on rows, so null texts and ids, repeated rows and extra columns pass
through as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillframe.llm.common import fresh
from quillframe.llm.jaccard import jaccard_components
from quillframe.llm.line_dedup import drop_repeated_lines
from quillframe.llm.mixing import mix_sources
from quillframe.llm.packing import pack
from quillframe.llm.quality import quality_scores
from quillframe.plans.lineage import cut_lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality_scores(docs, labels, carry=("text", *[c for c in docs.columns if c not in ("doc_id", "text")]))
    return scored.filter(F.col(scored.columns[-1])).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines go, and documents of which nothing is left by that."""
    # Written, or the filter below would be planned into every expression that makes the text.
    cut = cut_lineage(drop_repeated_lines(docs))
    deleted = F.col(cut.columns[-1])
    left = cut.filter((deleted == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    text_length = F.when(deleted > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", text_length).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the rows that links of similar shingle sets connect, one stays: smallest id, nulls last, then row."""
    (row,) = fresh(docs, "row")
    # Written, so that rows keep their numbers in both places where they are used.
    numbered = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
    groups = cut_lineage(jaccard_components(numbered, row_col=row).select(row, "doc_id", "component"))
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    first = groups.filter("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("rows"))
    lost = groups.join(first.filter("rows > 1"), "component").filter(F.col(row) != F.col("first.row")).select(row)
    return numbered.join(lost, row, "left_anti").select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document; documents that it does not take go.

    The mix is made of rows, so rows that share an id, or have none, are taken each on its own.
    """
    row, times, turn = fresh(docs, "row", "times", "turn")
    # Written, so that rows keep their numbers in both places where they are used.
    numbered = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
    mixed = mix_sources(numbered, row_col=row).filter("taken > 0")
    taken = mixed.select(row, (F.col("taken") / F.col("size")).cast("int").alias(times))
    rows = numbered.join(taken, row)
    return rows.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(times)))).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in which sequence."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

# The classifier is trained and the packing is a search: no SQL twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
