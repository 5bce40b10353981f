"""Projections, filters and element-wise operations."""

from pyspark.sql import functions as F

from ..functions.text import words
from ..operators import select as sel
from .registry import query, rnd


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def select_columns(t):
    return sel.select_cols(t.orders, ["o_orderkey", "o_orderdate", "o_totalprice"])


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def select_column_positions(t):
    return sel.select_positions(t.orders, [0, 2, -1])


@query(
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1995-03-01' AND TIMESTAMP '1996-09-30'
    """
)
def label_range(t):
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in ("1995-03-01", "1996-09-30"))
    return sel.loc_range(t.orders, "o_orderdate", lo, hi).select("o_orderkey", "o_orderdate")


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey
    LIMIT 900 OFFSET 100
    """
)
def position_range(t):
    placed = sel.iloc_range(t.orders, ["o_totalprice", "o_orderkey"], 100, 1000)
    return placed.select("o_orderkey", "o_totalprice")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
    WHERE (l_returnflag IN ('A', 'R') AND l_discount > 0.05) OR NOT (l_quantity < 45)
    """
)
def filter_by_mask(t):
    cond = (F.col("l_returnflag").isin("A", "R") & (F.col("l_discount") > 0.05)) | ~(F.col("l_quantity") < 45)
    kept = sel.filter_where(t.lineitem, cond)
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@query(
    """
    SELECT l_orderkey, l_partkey, l_tax FROM lineitem
    WHERE l_tax >= 0.06 AND l_quantity * 2 < 30 AND l_linestatus = 'O'
    """
)
def filter_by_expression(t):
    kept = sel.query(t.lineitem, "l_tax >= 0.06D AND l_quantity * 2 < 30 AND l_linestatus = 'O'")
    return kept.select("l_orderkey", "l_partkey", "l_tax")


@query("SELECT event_id, CASE WHEN event_type = 'purchase' THEN value END AS value FROM events")
def where_values(t):
    return sel.where(t.events, F.col("event_type") == "purchase", ["value"]).select("event_id", "value")


@query("SELECT event_id, CASE WHEN value > 100 THEN -1.0::DOUBLE ELSE value END AS value FROM events")
def mask_values(t):
    return sel.mask(t.events, F.col("value") > 100, ["value"], -1.0).select("event_id", "value")


@query(
    """
    SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net,
           round(l_extendedprice * l_tax, 4) AS tax, l_quantity + 1 AS l_quantity
    FROM lineitem
    """
)
def assign_columns(t):
    price = F.col("l_extendedprice")
    out = sel.assign(
        t.lineitem,
        net=rnd(price * (1 - F.col("l_discount"))),
        tax=rnd(price * F.col("l_tax")),
        l_quantity=F.col("l_quantity") + 1,
    )
    return out.select("l_orderkey", "l_linenumber", "net", "tax", "l_quantity")


@query("SELECT c_custkey AS id, c_name AS name, c_nationkey, c_acctbal, c_mktsegment AS segment FROM customer")
def rename_columns(t):
    return sel.rename_cols(t.customer, {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"})


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def drop_columns(t):
    return sel.drop_cols(t.orders, ["o_orderstatus", "o_orderpriority"])


@query(
    """
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS o_orderstatus,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '5-LOW' THEN 'later'
                ELSE o_orderpriority END AS o_orderpriority
    FROM orders
    """
)
def replace_values(t):
    mapping = {
        "o_orderstatus": {"F": 0, "O": 1, "P": 2},
        "o_orderpriority": {"1-URGENT": "now", "5-LOW": "later"},
    }
    out = sel.replace_values(t.orders, mapping)
    return out.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("SELECT c_custkey, least(greatest(c_acctbal, 0.0), 5000.0)::DOUBLE AS c_acctbal FROM customer")
def clip_values(t):
    return sel.clip(t.customer, "c_acctbal", 0.0, 5000.0).select("c_custkey", "c_acctbal")


@query(
    r"""
    SELECT doc_id, CAST(len(list_filter(string_split_regex(text, '\s+'), lambda w: length(w) > 0)) AS BIGINT) AS n_words
    FROM documents
    """
)
def row_function(t):
    out = sel.row_apply(t.documents, "n_words", lambda x: F.size(words(x)).cast("long"), ["text"])
    return out.select("doc_id", "n_words")


@query("SELECT o_orderkey, round(ln(o_totalprice), 9) AS log_price FROM orders")
def log_transform(t):
    out = sel.log_transform(t.orders, "o_totalprice", "log_price")
    return out.select("o_orderkey", rnd("log_price", 9).alias("log_price"))


_DAILY = """
    WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL),
    a AS (SELECT user_id, day, n FROM d WHERE event_type = 'view'),
    b AS (SELECT user_id, day, n FROM d WHERE event_type = 'purchase')
"""


@query(_DAILY + "SELECT user_id, day, a.n - b.n AS n FROM a FULL JOIN b USING (user_id, day)")
def aligned_difference(t):
    views, buys = (_daily_counts(t, kind) for kind in ("view", "purchase"))
    return sel.align_arith(views, buys, ["user_id", "day"], "-", ["n"])


@query(
    _DAILY
    + "SELECT user_id, day, coalesce(a.n, 0) + coalesce(b.n, 0) AS n FROM a FULL JOIN b USING (user_id, day)"
)
def aligned_sum_with_fill(t):
    views, buys = (_daily_counts(t, kind) for kind in ("view", "purchase"))
    return sel.align_arith(views, buys, ["user_id", "day"], "+", ["n"], fill=0)


def _daily_counts(t, kind):
    of_kind = t.events.filter(F.col("event_type") == kind)
    return of_kind.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
