"""Wide and long tables."""

from pyspark.sql import functions as F

from ..operators import reshape
from .registry import query, rnd

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]


def _wide(value: str, by: str = "o_orderpriority", names=None, otherwise: str = "") -> str:
    return ", ".join(
        f"{value.format(cond=f"{by} = '{p}'")} AS \"{p}\"" for p in (names or PRIORITIES)
    )


def _monthly(t):
    month = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month")
    totals = t.orders.groupBy(month, "o_orderpriority").agg(F.sum("o_totalprice").alias("total"))
    return totals.withColumn("total", rnd("total", 2))


_MONTHLY = """
    WITH m AS (SELECT (year(o_orderdate) * 100 + month(o_orderdate))::INTEGER AS month, o_orderpriority,
                      round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2)
"""


@query(_MONTHLY + f"SELECT month, {_wide('max(total) FILTER ({cond})')} FROM m GROUP BY 1")
def pivot_long_to_wide(t):
    return reshape.pivot(_monthly(t), "month", "o_orderpriority", "total")


@query(
    f"SELECT o_custkey, {_wide('coalesce(round(sum(o_totalprice) FILTER ({cond}), 2), 0)')} FROM orders GROUP BY 1"
)
def pivot_table_sums(t):
    out = reshape.pivot_table(t.orders, "o_custkey", "o_orderpriority", "o_totalprice", "sum", fill_value=0.0)
    return out.withColumns({p: rnd(F.col(f"`{p}`"), 2) for p in PRIORITIES})


@query(
    f"""
    WITH a AS (SELECT CASE WHEN grouping(o_orderstatus) = 1 THEN 'All' ELSE o_orderstatus END AS o_orderstatus,
                      {_wide('round(sum(o_totalprice) FILTER ({cond}), 2)')}, round(sum(o_totalprice), 2) AS "All"
               FROM orders GROUP BY ROLLUP (o_orderstatus))
    SELECT * FROM a
    """
)
def pivot_table_with_margins(t):
    out = reshape.pivot_table_margins(t.orders, "o_orderstatus", "o_orderpriority", "o_totalprice")
    return out.withColumns({p: rnd(F.col(f"`{p}`"), 2) for p in [*PRIORITIES, "All"]})


@query(f"SELECT o_orderstatus, {_wide('count(*) FILTER ({cond})')} FROM orders GROUP BY 1")
def crosstab_counts(t):
    return reshape.crosstab(t.orders, "o_orderstatus", "o_orderpriority")


@query(f"SELECT o_orderstatus, {_wide('max(o_totalprice) FILTER ({cond})')} FROM orders GROUP BY 1")
def crosstab_of_values(t):
    return reshape.crosstab(t.orders, "o_orderstatus", "o_orderpriority", "o_totalprice", "max")


@query(
    f"SELECT o_orderstatus, {_wide('count(*) FILTER ({cond}) / (SELECT count(*) FROM orders)')} FROM orders GROUP BY 1"
)
def crosstab_share_of_all(t):
    return reshape.crosstab_share(t.orders, "o_orderstatus", "o_orderpriority", "all")


@query(f"SELECT o_orderstatus, {_wide('count(*) FILTER ({cond}) / count(*)')} FROM orders GROUP BY 1")
def crosstab_share_of_row(t):
    return reshape.crosstab_share(t.orders, "o_orderstatus", "o_orderpriority", "index")


@query(
    "SELECT o_orderstatus, "
    + _wide("count(*) FILTER ({cond}) / (SELECT count(*) FROM orders WHERE {cond})")
    + " FROM orders GROUP BY 1"
)
def crosstab_share_of_column(t):
    return reshape.crosstab_share(t.orders, "o_orderstatus", "o_orderpriority", "columns")


@query(
    """
    SELECT c_custkey, 'c_name' AS variable, c_name AS value FROM customer
    UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer
    """
)
def melt_wide_to_long(t):
    return reshape.melt(t.customer, ["c_custkey"], ["c_name", "c_mktsegment"])


@query(
    """
    SELECT c_custkey, 'debt' AS level, -c_acctbal AS value FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT c_custkey, 'balance', c_acctbal FROM customer WHERE c_acctbal >= 0
    """
)
def stack_columns(t):
    balance = F.col("c_acctbal")
    wide = t.customer.select(
        "c_custkey", F.when(balance < 0, -balance).alias("debt"), F.when(balance >= 0, balance).alias("balance")
    )
    return reshape.stack(wide, ["c_custkey"])


@query(
    "WITH n AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2) SELECT o_custkey, "
    + ", ".join(f"coalesce(max(n) FILTER (o_orderstatus = '{s}'), 0) AS \"{s}\"" for s in STATUSES)
    + " FROM n GROUP BY 1"
)
def unstack_level(t):
    counts = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return reshape.unstack(counts, ["o_custkey"], "o_orderstatus", "n", fill=0)


@query(
    "SELECT event_id, "
    + ", ".join(f"(event_type = '{k}')::INTEGER AS is_{k}" for k in ("error", "purchase", "signup", "view"))
    + " FROM events"
)
def one_hot_columns(t):
    return reshape.dummies(t.events.select("event_id", "event_type"), "event_type", "is", drop_first=True)


_KIND = """
    WITH e AS (SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN event_type || user_id::VARCHAR END AS kind FROM events),
    f AS (SELECT kind, row_number() OVER (ORDER BY min(event_id)) - 1 AS code FROM e WHERE kind IS NOT NULL GROUP BY 1)
"""


def _kinds(t):
    kind = F.when(F.col("event_type") != "error", F.concat("event_type", F.col("user_id").cast("string")))
    return t.events.select("event_id", kind.alias("kind"))


@query(_KIND + "SELECT event_id, e.kind, coalesce(code, -1) AS code FROM e LEFT JOIN f ON e.kind = f.kind")
def codes_by_first_appearance(t):
    return reshape.factorize(_kinds(t), "kind", "event_id")[0]


@query(_KIND + "SELECT kind, code FROM f")
def table_of_codes(t):
    return reshape.factorize(_kinds(t), "kind", "event_id")[1]


@query(
    """
    WITH c AS (SELECT l_suppkey, l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS v FROM lineitem GROUP BY ALL)
    SELECT l_suppkey, count(*) AS n, string_agg(l_orderkey || '=' || v, ' ' ORDER BY l_orderkey) AS cells FROM c GROUP BY 1
    """
)
def pivot_over_any_number_of_values(t):
    """A column for each order, of which there are as many as the table has."""
    sparse = reshape.pivot_sparse(t.lineitem, "l_suppkey", "l_orderkey", "l_quantity", "sum")
    cell = F.zip_with("labels", "cells", lambda k, v: F.concat_ws("=", k.cast("string"), v.cast("long").cast("string")))
    return sparse.select("l_suppkey", F.size("labels").cast("long").alias("n"), F.array_join(cell, " ").alias("cells"))


@query(
    """
    SELECT o_custkey, coalesce(round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2), 0) AS "F",
           coalesce(round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2), 0) AS "O"
    FROM orders GROUP BY 1
    """
)
def pivot_sparse_to_columns(t):
    sparse = reshape.pivot_sparse(t.orders, "o_custkey", "o_orderstatus", "o_totalprice", "sum")
    wide = reshape.sparse_columns(sparse, ["F", "O"], fill_value=0.0)
    return wide.select("o_custkey", rnd("F", 2).alias("F"), rnd("O", 2).alias("O"))
