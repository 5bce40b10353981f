"""Row keys."""

from pyspark.sql import functions as F

from ..operators import keys, timeseries
from .registry import query, rnd


@query(
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) - 1 AS row_id FROM orders
    """
)
def row_numbers(t):
    return keys.add_row_id(t.orders, [("o_orderdate", "desc"), "o_orderkey"]).select("o_orderkey", "row_id")


_HOURS = """
    WITH have AS (
        SELECT date_trunc('hour', ts) AS hour, round(sum(value), 4) AS total, count(*) AS n
        FROM events WHERE event_type = 'purchase' GROUP BY 1),
    wanted AS (
        SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-02-01', INTERVAL 1 HOUR)) AS hour)
"""


def _hourly(t):
    bought = t.events.filter(F.col("event_type") == "purchase")
    placed = timeseries.period_of(bought, "ts", "h", "hour")
    return placed.groupBy("hour").agg(rnd(F.sum("value")).alias("total"), F.count(F.lit(1)).alias("n"))


def _wanted(t):
    return timeseries.date_range(t.spark, "2023-12-31", "2024-02-01", "h", "hour")


@query(_HOURS + "SELECT hour, coalesce(total, 0) AS total, coalesce(n, 0) AS n FROM wanted LEFT JOIN have USING (hour)")
def reindex_with_fill(t):
    return keys.reindex(_hourly(t), _wanted(t), ["hour"], fill=0)


@query(
    _HOURS
    + """
    SELECT hour, last_value(total IGNORE NULLS) OVER w AS total, last_value(n IGNORE NULLS) OVER w AS n
    FROM wanted LEFT JOIN have USING (hour) WINDOW w AS (ORDER BY hour)
    """
)
def reindex_carried_forward(t):
    return keys.reindex(_hourly(t), _wanted(t), ["hour"], method="ffill")


@query(
    _HOURS
    + """
    SELECT hour, last_value(total IGNORE NULLS) OVER w AS total, last_value(n IGNORE NULLS) OVER w AS n
    FROM wanted LEFT JOIN have USING (hour) WINDOW w AS (ORDER BY hour DESC)
    """
)
def reindex_carried_back(t):
    return keys.reindex(_hourly(t), _wanted(t), ["hour"], method="bfill")


@query(
    """
    SELECT c_custkey AS id, s_name AS s_name, NULL::DOUBLE AS c_acctbal
    FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey
    """
)
def reindex_like_other(t):
    have = t.supplier.select(F.col("s_suppkey").alias("id"), "s_name", "s_acctbal")
    like = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("s_name"), "c_acctbal")
    return keys.reindex_like(have, like, ["id"])


@query(
    """
    SELECT c_mktsegment, o_orderpriority, p_brand
    FROM (SELECT DISTINCT c_mktsegment FROM customer), (SELECT DISTINCT o_orderpriority FROM orders),
         (SELECT DISTINCT p_brand FROM part)
    """
)
def product_of_levels(t):
    return keys.key_product(
        [t.customer.select("c_mktsegment"), t.orders.select("o_orderpriority"), t.part.select("p_brand")]
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
    WHERE (l_returnflag > 'A' OR (l_returnflag = 'A' AND (l_linestatus > 'O' OR (l_linestatus = 'O' AND l_linenumber >= 3))))
      AND (l_returnflag < 'N' OR (l_returnflag = 'N' AND l_linestatus <= 'F'))
    """
)
def lexicographic_slice(t):
    kept = keys.key_slice(
        t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"], ("A", "O", 3), ("N", "F")
    )
    return kept.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
    WHERE l_returnflag IN ('A', 'R') AND l_linenumber BETWEEN 2 AND 4 AND l_linestatus IN ('O')
    """
)
def select_by_level(t):
    kept = keys.level_select(
        t.lineitem, {"l_returnflag": ["A", "R"], "l_linenumber": (2, 4), "l_linestatus": ["O"]}
    )
    return kept.select("l_orderkey", "l_linenumber", "l_returnflag")
