"""Sorting, limits, duplicates, sampling, stacking tables."""

from pyspark.sql import functions as F

from ..operators import order
from .registry import query, rnd


@query(
    """
    SELECT o_orderkey, o_orderpriority, o_totalprice,
           row_number() OVER (ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey) AS rank FROM orders
    """
)
def sort_by_values(t):
    keys = [("o_orderpriority", "desc"), "o_totalprice", "o_orderkey"]
    return order.sort_rank(t.orders, keys).select("o_orderkey", "o_orderpriority", "o_totalprice", "rank")


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM orders ORDER BY 1, 2")
def sort_by_key(t):
    return order.sort_key(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey", "o_orderkey"])


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 25")
def first_rows(t):
    return order.head(t.orders, 25, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_orderdate")


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 25")
def last_rows(t):
    return order.tail(t.orders, 25, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_orderdate")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def largest_values(t):
    return order.nlargest(t.orders, 50, "o_totalprice", ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50")
def smallest_values(t):
    return order.nsmallest(t.orders, 50, "o_totalprice", ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query(
    """
    SELECT event_id, event_id <> min(event_id) OVER w AS repeat_of_first, event_id <> max(event_id) OVER w AS repeat_of_last,
           count(*) OVER w > 1 AS not_single
    FROM events WINDOW w AS (PARTITION BY user_id, event_type, CAST(ts AS DATE))
    """
)
def flag_duplicates(t):
    rows = t.events.withColumn("day", F.to_date("ts"))
    subset = ["user_id", "event_type", "day"]
    for keep, name in (("first", "repeat_of_first"), ("last", "repeat_of_last"), (None, "not_single")):
        rows = order.duplicated(rows, subset, ["event_id"], keep, name)
    return rows.select("event_id", "repeat_of_first", "repeat_of_last", "not_single")


@query("SELECT min(doc_id) AS doc_id, text, lang FROM documents GROUP BY text, lang")
def drop_duplicate_texts(t):
    rows = t.documents.select("doc_id", "text", "lang")
    return order.drop_duplicates(rows, ["text", "lang"], "doc_id")


@query("SELECT max(doc_id) AS doc_id, md5(text) AS digest, lang FROM documents GROUP BY text, lang")
def keep_last_duplicate(t):
    kept = order.drop_duplicates(t.documents.select("doc_id", "text", "lang"), ["text", "lang"], "doc_id", "last")
    return kept.select("doc_id", F.md5("text").alias("digest"), "lang")


@query("SELECT min(doc_id) AS doc_id, md5(text) AS digest FROM documents GROUP BY text HAVING count(*) = 1")
def drop_all_duplicates(t):
    kept = order.drop_duplicates(t.documents.select("doc_id", "text"), ["text"], "doc_id", keep=None)
    return kept.select("doc_id", F.md5("text").alias("digest"))


@query("SELECT event_id, value FROM events ORDER BY md5('7:' || event_id::VARCHAR), event_id LIMIT 500")
def sample_rows(t):
    return order.sample(t.events, ["event_id"], n=500, seed=7).select("event_id", "value")


@query(
    """
    WITH d AS (
        SELECT CAST(floor(((('0x' || substr(md5('7draw:' || i::VARCHAR), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0)
               * (SELECT count(*) FROM events)) AS BIGINT) AS pos
        FROM (SELECT unnest(range((SELECT CAST(round(0.25 * count(*)) AS BIGINT) FROM events))) AS i)),
    e AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events)
    SELECT event_id, value FROM d JOIN e USING (pos)
    """
)
def sample_with_replacement(t):
    drawn = order.sample(t.events, ["event_id"], frac=0.25, replace=True, seed=7)
    return drawn.select("event_id", "value")


@query("SELECT count(*) AS rows, true AS near_share, true AS drawn_once FROM events")
def sample_by_fraction(t):
    """What is certain of a random sample: a tenth of the rows within five standard deviations, none twice."""
    drawn = order.sample_fraction(t.events, 0.1, seed=11).groupBy("event_id").agg(F.count(F.lit(1)).alias("times"))
    rows = t.events.select("event_id").join(drawn, "event_id", "left")
    n, hits = F.count(F.lit(1)), F.count("times")
    return rows.agg(
        n.alias("rows"),
        (F.abs(hits - 0.1 * n) <= 5 * F.sqrt(0.09 * n)).alias("near_share"),
        (F.coalesce(F.max("times"), F.lit(1)) == 1).alias("drawn_once"),
    )


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY ln((('0x' || substr(md5('3:' || o_orderkey::VARCHAR), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0) / o_totalprice DESC,
             o_orderkey LIMIT 300
    """
)
def sample_by_weight(t):
    drawn = order.sample_weighted(t.orders, ["o_orderkey"], 300, "o_totalprice", seed=3)
    return drawn.select("o_orderkey", "o_totalprice")


_OLD_NEW = """
    WITH a AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
    b AS (SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01')
"""


def _old_new(t):
    cut_a, cut_b = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1995-01-01"))
    a = t.orders.filter(F.col("o_orderdate") < cut_a).select("o_orderkey", "o_totalprice", "o_orderstatus")
    b = t.orders.filter(F.col("o_orderdate") >= cut_b).select("o_orderkey", "o_totalprice", "o_orderpriority")
    return a, b


@query(_OLD_NEW + "SELECT * FROM a UNION ALL BY NAME SELECT * FROM b")
def append_rows(t):
    return order.append(*_old_new(t))


@query(
    _OLD_NEW
    + """SELECT 'old' AS part, o_orderkey, o_totalprice FROM a UNION ALL SELECT 'new', o_orderkey, o_totalprice FROM b"""
)
def concat_common_columns(t):
    old, new = _old_new(t)
    return order.concat({"old": old, "new": new}, join="inner", label="part")


@query(_OLD_NEW + "SELECT *, 'old' AS part FROM a UNION ALL BY NAME SELECT *, 'new' AS part FROM b")
def concat_all_columns(t):
    old, new = _old_new(t)
    return order.concat({"old": old, "new": new}, label="part")


@query(
    """
    WITH n AS (SELECT o_custkey AS k, count(*) AS orders FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
    m AS (SELECT o_custkey AS k, round(max(o_totalprice), 2) AS top FROM orders WHERE o_totalprice > 300000 GROUP BY 1),
    c AS (SELECT c_custkey AS k, c_name FROM customer)
    SELECT k, orders, top, c_name FROM n FULL JOIN m USING (k) FULL JOIN c USING (k)
    """
)
def concat_side_by_side(t):
    k = F.col("o_custkey").alias("k")
    n = t.orders.filter("o_orderstatus = 'O'").groupBy(k).agg(F.count(F.lit(1)).alias("orders"))
    m = t.orders.filter("o_totalprice > 300000").groupBy(k).agg(rnd(F.max("o_totalprice"), 2).alias("top"))
    c = t.customer.select(F.col("c_custkey").alias("k"), "c_name")
    return order.concat_columns([n, m, c], ["k"])
