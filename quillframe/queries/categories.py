"""Categories and labels."""

from pyspark.sql import functions as F

from ..operators import category as cat
from .registry import query, rnd

PRIORITY = cat.Categories(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"), ordered=True)
MAIN = cat.Categories(("2-HIGH", "1-URGENT", "9-NONE"))

_CODE = "CAST(left({}, 1) AS INTEGER) - 1"


@query(
    "SELECT o_orderkey, CASE WHEN o_orderpriority IN ('2-HIGH', '1-URGENT') THEN o_orderpriority END AS o_orderpriority FROM orders"
)
def cast_to_category(t):
    return cat.to_category(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", MAIN)


@query(
    """
    SELECT o_orderkey, CASE WHEN o_totalprice > 0 AND o_totalprice <= 100000 THEN 'small'
        WHEN o_totalprice > 100000 AND o_totalprice <= 300000 THEN 'medium'
        WHEN o_totalprice > 300000 AND o_totalprice <= 450000 THEN 'large' END AS size,
        CASE WHEN o_totalprice >= 0 AND o_totalprice < 250000 THEN '[0, 250000)'
        WHEN o_totalprice >= 250000 AND o_totalprice < 600000 THEN '[250000, 600000)' END AS half FROM orders
    """
)
def cut_into_bins(t):
    edges, labels = [0, 100000, 300000, 450000], ["small", "medium", "large"]
    out = cat.cut(t.orders, "o_totalprice", edges, "size", labels)
    out = cat.cut(out, "o_totalprice", [0, 250000, 600000], "half", right=False)
    return out.select("o_orderkey", "size", "half")


@query(
    """
    SELECT o_orderpriority, code, coalesce(n, 0) AS n
    FROM (VALUES ('2-HIGH', 0), ('1-URGENT', 1), ('9-NONE', 2)) c(o_orderpriority, code)
    LEFT JOIN (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1) USING (o_orderpriority)
    """
)
def category_counts(t):
    return cat.category_info(t.orders, "o_orderpriority", MAIN)


_EDIT = """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'now'
           ELSE o_orderpriority END AS o_orderpriority FROM orders"""


@query(_EDIT)
def edit_categories(t):
    df, c = cat.remove_categories(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", PRIORITY, "5-LOW")
    df, c = cat.rename_categories(df, "o_orderpriority", c, {"1-URGENT": "now"})
    df, c = cat.add_categories(df, "o_orderpriority", c, "6-NEVER")
    return cat.to_category(df, "o_orderpriority", c)


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('3-MEDIUM', '2-HIGH') THEN o_orderpriority END AS o_orderpriority,
       CASE o_orderpriority WHEN '3-MEDIUM' THEN 0 WHEN '2-HIGH' THEN 1 END AS code FROM orders"""
)
def set_categories_and_drop_unused(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    df, c = cat.set_categories(rows, "o_orderpriority", PRIORITY, "0-NEW", "3-MEDIUM", "2-HIGH")
    df, c = cat.drop_unused(df, "o_orderpriority", c)
    return cat.order_category(df, "o_orderpriority", c, "code")


@query(
    f"""SELECT o_orderkey, o_orderpriority, ({_CODE.format('o_orderpriority')})::INTEGER AS rank FROM orders"""
)
def sort_by_category(t):
    rows = cat.order_category(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", PRIORITY)
    return cat.sort_category(rows, "o_orderpriority", PRIORITY, ["o_orderkey"])


@query(
    f"""
    SELECT o_orderkey, {_CODE.format('o_orderpriority')} < 2 AS before_medium,
           o_orderpriority = '5-LOW' AS is_low, o_orderpriority <> '5-LOW' AS not_low FROM orders
    """
)
def compare_category_with_value(t):
    out = cat.compare_category(t.orders, "o_orderpriority", "<", "3-MEDIUM", PRIORITY, "before_medium")
    out = cat.compare_category(out, "o_orderpriority", "==", "5-LOW", PRIORITY, "is_low")
    out = cat.compare_category(out, "o_orderpriority", "!=", "5-LOW", PRIORITY, "not_low")
    return out.select("o_orderkey", "before_medium", "is_low", "not_low")


@query(
    """
    WITH b AS (SELECT o_custkey, min(o_orderpriority) AS best, max(o_orderpriority) AS worst,
                      max_by(o_orderpriority, (o_orderdate, o_orderkey)) AS latest FROM orders GROUP BY 1)
    SELECT o_custkey, latest > best AS above_best, latest = worst AS is_worst FROM b
    """
)
def compare_two_categories(t):
    latest = F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey"))
    rows = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderpriority").alias("best"), F.max("o_orderpriority").alias("worst"), latest.alias("latest")
    )
    out = cat.compare_categories(rows, "latest", "best", ">", PRIORITY, PRIORITY, "above_best")
    out = cat.compare_categories(out, "latest", "worst", "==", PRIORITY, PRIORITY, "is_worst")
    return out.select("o_custkey", "above_best", "is_worst")


@query("SELECT p_partkey, p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS code FROM part")
def codes_of_sorted_labels(t):
    return cat.label_encode_sorted(t.part.select("p_partkey", "p_brand"), "p_brand", "code")


@query("SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 0 END AS label FROM orders")
def codes_from_mapping(t):
    out = cat.label_encode_map(t.orders, "o_orderstatus", {"F": 2, "O": 0}, "label")
    return out.select("o_orderkey", "o_orderstatus", "label")


@query(
    """
    WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1)
    SELECT quality, n, round((SELECT sum(n) / count(*) FROM c) / n, 9) AS weight FROM c
    """
)
def class_balance(t):
    return cat.class_balance(t.labels, "quality").withColumn("weight", rnd("weight", 9))
