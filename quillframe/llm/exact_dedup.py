"""Exact deduplication with a heavy-hitter split (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACES, cut_lineage, descending, text_or_empty

# Candidates for heavy digests, and the counters of the Misra-Gries sketch that finds
# them. Both bound what is sent to the driver and broadcast, whatever the input.
CANDIDATES = 256
COUNTERS = 2048


def normalised(text: Column) -> Column:
    """The text without white space; equal texts have equal normalised texts."""
    return F.regexp_replace(text, SPACES, "")


def dedup_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    candidates: int = CANDIDATES,
    counters: int = COUNTERS,
) -> DataFrame:
    """One row per row of ``df``: which row of its group of equal texts stays.

    Returns ``id_col``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``. A null
    text is an empty one. Of equal texts the one with the most code points stays, then
    the smallest id; a null id comes last, and of rows that agree in id and length exactly
    one (the first read) stays. Other columns of ``df`` play no part, an empty table gives
    an empty result.

    One pass reads the texts and writes id, digest and length. A frequent-items sketch
    (Misra-Gries counters, merged over tasks) names the digests that may be frequent; these
    are counted exactly and their winners, at most ``candidates`` rows, are broadcast, so
    the rows of large groups are settled without a shuffle. All other groups are smaller
    than the sketch's error bound and take an ordinary shuffle by digest.
    """
    text = text_or_empty(text_col)
    slim = cut_lineage(
        df.select(
            F.col(f"`{id_col}`").alias("id"),
            F.sha2(normalised(text), 256).alias("digest"),
            F.char_length(text).cast("bigint").alias("size"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    found = slim.agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(digest, {candidates}, {counters})").alias("top"),
    ).first()
    # Beyond this many rows a group may fill a task; the sketch misses none of them.
    heavy_rows = max(2, found["n"] // candidates)
    names = [x["item"] for x in found["top"] or () if x["count"] >= heavy_rows]

    rank = F.struct("size", F.col("id").isNotNull().alias("known"), descending(F.col("id")).alias("first"), descending(F.col("row")).alias("top"))
    winners = (
        slim.filter(F.col("digest").isin(names))
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct(rank.alias("rank"), "id", "row")).alias("best"))
        .filter(F.col("group_size") >= heavy_rows)
    )
    hot = slim.join(F.broadcast(winners), "digest")  # at most `candidates` rows
    whole = Window.partitionBy("digest")
    rest = (
        slim.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumn("group_size", F.count(F.lit(1)).over(whole))
        .withColumn("best", F.max(F.struct(rank.alias("rank"), "id", "row")).over(whole))
    )
    columns = ["id", "digest", "row", "group_size", "best"]
    return (
        hot.select(columns)
        .unionByName(rest.select(columns))
        .select(
            F.col("id").alias(id_col),
            F.col("best.id").alias("keep_id"),
            "group_size",
            (F.col("row") == F.col("best.row")).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY size DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
