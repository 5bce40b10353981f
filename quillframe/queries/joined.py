"""Joins and key-aligned combination."""

from pyspark.sql import functions as F

from ..operators import joins
from .registry import query, rnd

# Keys moved by 40 leave rows without partner on both sides.
_SIDES = """
    WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders),
    c AS (SELECT c_custkey + 40 AS c_custkey, c_name FROM customer)
"""


def _sides(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return o, t.customer.select((F.col("c_custkey") + 40).alias("c_custkey"), "c_name")


def _merged(t, how, **more):
    o, c = _sides(t)
    return joins.merge(o, c, how=how, left_on="o_custkey", right_on="c_custkey", **more)


_PICK = "SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_name FROM o {} JOIN c ON o_custkey = c_custkey"


@query(_SIDES + _PICK.format("INNER"))
def merge_inner(t):
    return _merged(t, "inner")


@query(_SIDES + _PICK.format("LEFT"))
def merge_left(t):
    return _merged(t, "left", validate="m:1")


@query(_SIDES + _PICK.format("RIGHT"))
def merge_right(t):
    return _merged(t, "right")


@query(_SIDES + _PICK.format("FULL"))
def merge_outer(t):
    return _merged(t, "outer")


@query(
    """
    WITH f AS (SELECT o_custkey AS key, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders GROUP BY 1),
    p AS (SELECT l_orderkey AS key, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1)
    SELECT key, f.total AS total_f, n, p.total AS total_p FROM f JOIN p USING (key)
    """
)
def merge_with_suffixes(t):
    def totals(rows, key, price, *more):
        return rows.groupBy(F.col(key).alias("key")).agg(rnd(F.sum(price), 2).alias("total"), *more)

    full = totals(t.orders, "o_custkey", "o_totalprice", F.count(F.lit(1)).alias("n"))
    part = totals(t.lineitem, "l_orderkey", "l_extendedprice")
    return joins.merge(full, part, on="key", suffixes=("_f", "_p"), validate="1:1")


@query(
    "SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey"
)
def merge_validated(t):
    out = joins.merge(
        t.orders, t.customer, how="left", left_on="o_custkey", right_on="c_custkey", validate="m:1"
    )
    return out.select("o_orderkey", "o_custkey", "c_name", "c_mktsegment")


@query(
    _SIDES
    + """
    SELECT o_orderkey, c_custkey,
           CASE WHEN c_custkey IS NULL THEN 'left_only' WHEN o_orderkey IS NULL THEN 'right_only' ELSE 'both' END AS side
    FROM o FULL JOIN c ON o_custkey = c_custkey
    """
)
def merge_with_indicator(t):
    return _merged(t, "outer", indicator="side").select("o_orderkey", "c_custkey", "side")


@query(
    """
    WITH e AS (SELECT CASE WHEN event_type <> 'error' THEN user_id END AS who, event_type, value FROM events),
    a AS (SELECT who, count(*) AS n FROM e GROUP BY 1),
    b AS (SELECT CASE WHEN who % 2 = 0 THEN who END AS who, max(value) AS top FROM e GROUP BY 1)
    SELECT a.who, n, top FROM a LEFT JOIN b ON a.who IS NOT DISTINCT FROM b.who
    """
)
def merge_matching_null_keys(t):
    who = F.when(F.col("event_type") != "error", F.col("user_id")).alias("who")
    e = t.events.select(who, "value")
    a = e.groupBy("who").agg(F.count(F.lit(1)).alias("n"))
    even = F.when(F.col("who") % 2 == 0, F.col("who")).alias("who")
    b = e.groupBy(even).agg(F.max("value").alias("top"))
    return joins.merge(a, b, on="who", how="left", nulls_match=True)


@query(
    """
    SELECT c_custkey, n_name, r_name, c_acctbal FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    """
)
def join_several_tables(t):
    out = joins.key_join(
        t.customer, [(t.nation, "c_nationkey", "n_nationkey"), (t.region, "n_regionkey", "r_regionkey")]
    )
    return out.select("c_custkey", "n_name", "r_name", "c_acctbal")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def semi_filter(t):
    large = t.orders.filter("o_totalprice > 450000")
    return joins.semi_filter(t.customer, large, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query(
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)"
)
def anti_filter(t):
    large = t.orders.filter("o_totalprice > 450000")
    return joins.anti_filter(t.customer, large, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query(
    """
    WITH i AS (SELECT p_partkey, (p_retailprice - 900) * 2000 AS lo, (p_retailprice - 900) * 2000 + p_size * 10 AS hi
               FROM part)
    SELECT o_orderkey, p_partkey, o_totalprice FROM orders JOIN i ON o_totalprice > lo AND o_totalprice <= hi
    """
)
def interval_lookup(t):
    lo = (F.col("p_retailprice") - 900) * 2000
    bands = t.part.select("p_partkey", lo.alias("lo"), (lo + F.col("p_size") * 10).alias("hi"))
    found = joins.interval_lookup(t.orders.select("o_orderkey", "o_totalprice"), bands, "o_totalprice")
    return found.select("o_orderkey", "p_partkey", "o_totalprice")


_SPANS = """
    WITH c AS (SELECT c_custkey, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
    i AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN NULL ELSE a END AS lo, CASE c_custkey % 3 WHEN 1 THEN NULL ELSE b END AS hi FROM c)
"""


@query(
    _SPANS
    + """
    SELECT i.c_custkey, count(*) AS orders FROM i JOIN orders ON (lo IS NULL OR o_orderdate >= lo) AND (hi IS NULL OR o_orderdate <= hi)
    GROUP BY 1
    """
)
def interval_lookup_in_time_with_open_ends(t):
    """Each customer has the time from the first to the last order, a third without start, a third without end."""
    own = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    spans = own.groupBy("c_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    third = F.col("c_custkey") % 3
    spans = spans.select("c_custkey", F.when(third != 0, F.col("a")).alias("lo"), F.when(third != 1, F.col("b")).alias("hi"))
    return joins.interval_counts(t.orders, spans, "o_orderdate", closed="both", out="orders").select("c_custkey", "orders")


@query(
    """
    WITH i AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN NULL ELSE s_acctbal END AS lo,
                      CASE s_suppkey % 3 WHEN 1 THEN NULL ELSE s_acctbal + s_suppkey % 7 * 500 END AS hi FROM supplier)
    SELECT c_custkey, s_suppkey FROM customer JOIN i ON (lo IS NULL OR c_acctbal >= lo) AND (hi IS NULL OR c_acctbal < hi)
    """
)
def interval_lookup_with_open_ends(t):
    third = F.col("s_suppkey") % 3
    high = F.col("s_acctbal") + F.col("s_suppkey") % 7 * 500
    bands = t.supplier.select("s_suppkey", F.when(third != 0, F.col("s_acctbal")).alias("lo"), F.when(third != 1, high).alias("hi"))
    found = joins.interval_lookup(t.customer, bands, "c_acctbal", closed="left")
    return found.select("c_custkey", "s_suppkey")


_TWO = """
    WITH g AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, max(value) AS high, min(value) AS low
               FROM events GROUP BY ALL),
    a AS (SELECT user_id, day, CASE WHEN high > 50 THEN high END AS high, low FROM g WHERE event_type = 'click'),
    b AS (SELECT user_id, day, high, low AS low FROM g WHERE event_type = 'signup')
"""


def _two(t):
    def daily(kind):
        rows = t.events.filter(F.col("event_type") == kind)
        return rows.groupBy("user_id", F.to_date("ts").alias("day")).agg(
            F.max("value").alias("high"), F.min("value").alias("low")
        )

    a = daily("click").withColumn("high", F.when(F.col("high") > 50, F.col("high")))
    return a, daily("signup")


@query(_TWO + "SELECT user_id, day, greatest(a.high, b.high) AS high, greatest(a.low, b.low) AS low FROM a FULL JOIN b USING (user_id, day)")
def combine_tables(t):
    return joins.combine(*_two(t), ["user_id", "day"], lambda x, y: F.greatest(x, y))


@query(_TWO + "SELECT user_id, day, coalesce(a.high, b.high) AS high, coalesce(a.low, b.low) AS low FROM a FULL JOIN b USING (user_id, day)")
def combine_first_tables(t):
    return joins.combine_first(*_two(t), ["user_id", "day"])


@query(_TWO + "SELECT user_id, day, coalesce(b.high, a.high) AS high, coalesce(b.low, a.low) AS low FROM a LEFT JOIN b USING (user_id, day)")
def update_table(t):
    return joins.update(*_two(t), ["user_id", "day"])
