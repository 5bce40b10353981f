"""The queries of this package and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, exact_dedup, jaccard, line_dedup, mixing, neighbours, ngram_lm, packing, quality, sharding, spelling, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(run):
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.pages_round_trip(_table(spark, folder, "pages"))


@_query
def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_lm.score_texts(_table(spark, folder, "documents"))


@_query
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents"))


@_query
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.dedup_groups(_table(spark, folder, "documents"))


@_query
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.kd_shards(_table(spark, folder, "documents"))


@_query
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(_table(spark, folder, "documents")).select("doc_id", "text", "lines", "deleted_lines")


@_query
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


@_query
def op9_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, folder, "documents"))


@_query
def op10_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@_query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    white = whitening.whiten(_table(spark, folder, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


@_query
def op12_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.read_back(chat.format_conversations(chat.with_planted(_table(spark, folder, "conversations"))))


@_query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants_of_texts(_table(spark, folder, "documents"))


ORACLES["op2_warc"] = warc.SQL
ORACLES["op5_exact_dedup"] = exact_dedup.SQL
ORACLES["op12_chat_format"] = chat.SQL
