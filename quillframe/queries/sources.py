"""Readers and writers."""

from pyspark.sql import functions as F

from .. import sources as io
from ..operators import select as sel
from .registry import query


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(t):
    path = t.scratch()
    io.write_csv(t.customer, path)
    return io.read_csv(t.spark, path, t.customer.schema)


@query("SELECT p_partkey, p_name, p_size FROM part")
def tab_separated_columns_by_position(t):
    path = t.scratch()
    io.write_csv(t.part, path, sep="\t")
    return sel.select_positions(io.read_table(t.spark, path, t.part.schema), [0, 1, 4])


@query(
    """
    SELECT 'document' AS kind, doc_id AS id, 0::BIGINT AS turn, md5(text) AS digest FROM documents
    UNION ALL SELECT 'turn', conv_id, turn, md5(text) FROM conversations
    """
)
def csv_of_texts_with_line_breaks(t):
    documents = t.documents.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("turn"), "text")
    texts = documents.unionByName(t.conversations.select(F.lit("turn").alias("kind"), F.col("conv_id").alias("id"), "turn", "text"))
    path = t.scratch()
    io.write_csv(texts, path)
    back = io.read_csv(t.spark, path, texts.schema, line_breaks=True)
    return back.select("kind", "id", "turn", F.md5("text").alias("digest"))


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
)
def csv_with_key_columns(t):
    path = t.scratch()
    io.write_csv(t.orders.select(*reversed(t.orders.columns)), path)
    schema = t.orders.select(*reversed(t.orders.columns)).schema
    keyed = io.read_keyed_csv(t.spark, path, "o_orderkey", schema)
    return keyed.select(*t.orders.columns)


@query("SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, md5(text) AS digest FROM documents")
def corpus_of_text_files(t):
    path = t.scratch()
    io.write_corpus(t.documents, path)
    files = io.read_corpus(t.spark, path, id_pattern=r"doc_id=(\d+)\.txt$")
    text = F.regexp_replace("text", r"\n\z", "")
    return files.select(
        F.col("doc_id").cast("long"), F.length(text).cast("long").alias("n_chars"), F.md5(text).alias("digest")
    )


@query(
    """
    SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 0.5 ELSE 1.0 - l.quality END::DOUBLE AS poor,
           CASE WHEN l.doc_id IS NULL THEN 0.5 ELSE l.quality END::DOUBLE AS good
    FROM documents d LEFT JOIN labels l USING (doc_id)
    """
)
def submission_from_template(t):
    half = F.lit(0.5)
    template = t.documents.select("doc_id", half.alias("poor"), half.alias("good"))
    good = F.col("quality").cast("double")
    preds = t.labels.select("doc_id", good.alias("good"), (1 - good).alias("poor"))
    return io.build_submission(template, preds, "doc_id", ["poor", "good"])


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def records_without_text(t):
    return io.missing_texts(t.documents, t.labels, "doc_id")


@query(
    """
    SELECT l.doc_id, l.quality, l.toxic, CAST(length(d.text) AS BIGINT) AS n_chars, md5(d.text) AS digest
    FROM labels l LEFT JOIN documents d USING (doc_id)
    """
)
def attach_corpus(t):
    joined = io.attach_corpus(t.labels, t.documents, "doc_id")
    return joined.select(
        "doc_id",
        "quality",
        "toxic",
        F.length("full_text").cast("long").alias("n_chars"),
        F.md5("full_text").alias("digest"),
    )
