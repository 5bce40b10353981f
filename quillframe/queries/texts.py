"""Text columns."""

from pyspark.sql import functions as F

from ..functions.text import FULL_WIDTH, HALF_WIDTH
from ..operators import text
from .registry import query


@query("SELECT event_id, user_id::VARCHAR AS user_id, event_type FROM events")
def numbers_to_text(t):
    return text.to_string(t.events.select("event_id", "user_id", "event_type"), ["user_id"])


@query("SELECT doc_id, string_split_regex(text, '[.,]') AS pieces FROM documents")
def split_at_pattern(t):
    return text.split_text(t.documents, "text", "[.,]", "pieces").select("doc_id", "pieces")


@query(
    """
    SELECT page_id, string_split(url, '/')[1] AS part_0, string_split(url, '/')[2] AS part_1,
           string_split(url, '/')[3] AS part_2, string_split(url, '/')[4] AS part_3, string_split(url, '/')[5] AS part_4,
           string_split(url, '/')[6] AS part_5
    FROM pages
    """
)
def split_into_columns(t):
    out = text.split_text(t.pages, "url", "/", "part", expand=6)
    return out.select("page_id", *[f"part_{i}" for i in range(6)])


@query("SELECT p_partkey, p_brand || ' / ' || p_type || ' / ' || p_size::VARCHAR AS label FROM part")
def concatenate_columns(t):
    return text.cat(t.part, ["p_brand", "p_type", "p_size"], "label", sep=" / ").select("p_partkey", "label")


@query(
    """
    SELECT p_partkey, coalesce(CASE WHEN p_size > 10 THEN p_type END, '?') || '-' || p_brand AS filled,
           CASE WHEN p_size > 10 THEN p_type END || '-' || p_brand AS strict FROM part
    """
)
def concatenate_with_nulls(t):
    kind = F.when(F.col("p_size") > 10, F.col("p_type"))
    rows = t.part.select("p_partkey", kind.alias("kind"), "p_brand")
    out = text.cat(rows, ["kind", "p_brand"], "filled", sep="-", na_rep="?")
    return text.cat(out, ["kind", "p_brand"], "strict", sep="-").select("p_partkey", "filled", "strict")


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY 1")
def concatenate_group(t):
    return text.cat_all(t.conversations, "conv_id", "text", "\n", "turn")


@query(
    """
    WITH n AS (SELECT *, (row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1) // 50 AS piece FROM conversations)
    SELECT role, piece, string_agg(text, ' ' ORDER BY conv_id, turn) AS text FROM n GROUP BY 1, 2
    """
)
def concatenate_group_in_pieces(t):
    return text.cat_all(t.conversations, "role", "text", " ", ["conv_id", "turn"], piece_rows=50)


@query("SELECT doc_id, md5(replace(text, 'the', 'THE')) AS digest FROM documents")
def replace_literal(t):
    out = text.replace_text(t.documents, "text", "the", "THE")
    return out.select("doc_id", F.md5("text").alias("digest"))


@query(r"SELECT doc_id, md5(regexp_replace(text, '[0-9]+|\s{2,}', '#', 'g')) AS digest FROM documents")
def replace_pattern(t):
    out = text.replace_text(t.documents, "text", r"[0-9]+|\s{2,}", "#", regex=True)
    return out.select("doc_id", F.md5("text").alias("digest"))


@query(r"SELECT p_partkey, regexp_replace(p_name, '^(\w+) (\w+)$', '\2, \1') AS p_name FROM part")
def swap_captured_groups(t):
    return text.replace_groups(t.part, "p_name", r"^(\w+) (\w+)$", "$2, $1").select("p_partkey", "p_name")


def _initials(match) -> str:
    return match[1].upper() + match[2]


@query(
    r"""
    SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
           lambda w: upper(w[1]) || w[2:]), ' ') AS p_name FROM part
    """
)
def replace_with_function(t):
    return text.replace_groups(t.part, "p_name", r"\b(\w)(\w*)", _initials).select("p_partkey", "p_name")


@query(
    r"""
    SELECT page_id, nullif(regexp_extract(url, '^(https?)://([^/]+)', 1), '') AS scheme,
           nullif(regexp_extract(url, '^(https?)://([^/]+)', 2), '') AS host,
           nullif(regexp_extract(url, '[?&]page=(\d+)', 1), '') AS page FROM pages
    """
)
def extract_groups(t):
    out = text.extract(t.pages, "url", r"^(https?)://([^/]+)", ["scheme", "host"])
    out = text.extract(out, "url", r"[?&]page=(\d+)", ["page"])
    return out.select("page_id", "scheme", "host", "page")


@query(
    """
    SELECT o_orderkey, o_orderpriority[1] AS rank, CASE WHEN o_orderpriority[3] = 'N' THEN 'N' ELSE '' END AS n,
           CASE WHEN o_orderpriority[3:4] = 'NO' THEN 'O' END AS o
    FROM orders
    """
)
def extract_empty_groups(t):
    """A group that matches nothing is empty, one that takes no part is null."""
    out = text.extract(t.orders, "o_orderpriority", r"^(\d)-(N?)(?:(?<=N)(O))?", ["rank", "n", "o"])
    return out.select("o_orderkey", "rank", "n", "o")


@query(
    r"""
    WITH m AS (SELECT doc_id, regexp_extract_all(text, '[0-9]+') AS v FROM documents)
    SELECT doc_id, (i - 1)::INTEGER AS match, v[i] AS value FROM (SELECT doc_id, v, unnest(range(1, len(v) + 1)) AS i FROM m)
    """
)
def extract_all_matches(t):
    return text.extract_all(t.documents, "text", "[0-9]+", ["doc_id"])


@query(r"SELECT doc_id, regexp_matches(text, '[0-9]{3,}') AS has_number, regexp_matches(text, '^[TA][a-z]') AS starts FROM documents")
def contains_and_match(t):
    out = text.contains(t.documents, "text", "[0-9]{3,}", "has_number", na=False)
    return text.match(out, "text", "[TA][a-z]", "starts").select("doc_id", "has_number", "starts")


@query(
    """
    SELECT p_partkey, trim(' ' || p_name || ' ') AS strip, lower(p_brand) AS lower, upper(p_name) AS upper,
           translate(p_brand, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz') AS swapcase,
           upper(p_type[1]) || lower(p_type[2:]) AS capitalize FROM part
    """
)
def change_case_and_strip(t):
    out = t.part.withColumn("padded", F.concat(F.lit(" "), "p_name", F.lit(" ")))
    for col, method in (
        ("padded", "strip"),
        ("p_brand", "lower"),
        ("p_name", "upper"),
        ("p_brand", "swapcase"),
        ("p_type", "capitalize"),
    ):
        out = text.text_method(out, col, method, method)
    return out.select("p_partkey", "strip", "lower", "upper", "swapcase", "capitalize")


@query(r"SELECT doc_id, regexp_full_match(text, '[0-9]+') AS whole, regexp_full_match(source[4:], '[0-9]+') AS source_number FROM documents")
def all_digits(t):
    rows = t.documents.withColumn("number", F.col("source").substr(F.lit(4), F.length("source")))
    out = text.is_numeric(text.is_numeric(rows, "text", "whole"), "number", "source_number")
    return out.select("doc_id", "whole", "source_number")


@query("SELECT doc_id, CAST(length(text) AS BIGINT) AS chars FROM documents")
def text_length(t):
    return text.text_length(t.documents, "text", "chars").select("doc_id", "chars")


_FROM, _TO = FULL_WIDTH, HALF_WIDTH.replace("'", "''")


@query(
    rf"""
    SELECT doc_id, md5(translate(regexp_replace(replace(text || '，ok！（1）【a】', ' ', ''), '^\s+|\s+$', '', 'g'),
                       '{_FROM}', '{_TO}')) AS digest FROM documents
    """
)
def normalise_messages(t):
    marked = t.documents.withColumn("text", F.concat("text", F.lit("，ok！（1）【a】")))
    return text.normalise_message(marked, "text").select("doc_id", F.md5("text").alias("digest"))


# The documents hold no misread bytes and, beyond accents, only one letter to spell out.
@query(
    """
    WITH r AS (SELECT doc_id, strip_accents(replace(text, 'ß', 'ss')) AS repaired FROM documents)
    SELECT doc_id, md5(repaired) AS digest, length(repaired)::INTEGER AS chars FROM r
    """
)
def repair_encoding(t):
    out = text.repair_corpus(t.documents, "text", "repaired")
    return out.select("doc_id", F.md5("repaired").alias("digest"), F.length("repaired").alias("chars"))


@query(
    r"""
    SELECT lang, source, count(*) AS rows, count(*) FILTER (regexp_matches(text, '[^\x00-\x7F]')) AS non_ascii,
           count(*) FILTER (regexp_matches(text, '[^\x00-\x7F]')) AS changed
    FROM documents GROUP BY 1, 2
    """
)
def repair_report(t):
    return text.repair_report(t.documents, "text", ["lang", "source"])


@query(
    r"""
    WITH j AS (SELECT doc_id, lang || ' ' || source || '[SEP]' || text AS text FROM documents),
    w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '\s+'), lambda x: length(x) > 0) AS w FROM j)
    SELECT doc_id, md5(text) AS digest, CAST(len(w) AS BIGINT) AS n_tokens, w[1:512] AS tokens FROM w
    """
)
def build_model_input(t):
    rows = t.documents.select("doc_id", "lang", "source", F.col("text").alias("context"))
    out = text.build_example(rows, "lang", "source", "context", "[SEP]")
    return out.select("doc_id", F.md5("text").alias("digest"), "n_tokens", "tokens")
