"""Whole-table and grouped aggregation."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..functions.numeric import natural_log
from ..operators import aggregate as agg
from ..operators.mergeable import Mergeable
from .registry import GAPS, query, rnd, with_gaps


@query("SELECT DISTINCT o_orderpriority FROM orders")
def unique_values(t):
    return agg.unique(t.orders, "o_orderpriority")


@query(
    """
    SELECT 'o_custkey' AS column, count(DISTINCT o_custkey) AS n_unique FROM orders
    UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate) FROM orders
    UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders
    """
)
def distinct_counts(t):
    return agg.nunique(t.orders, ["o_custkey", "o_orderdate", "o_orderstatus"])


@query(
    f"WITH {GAPS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, count({c}) AS n FROM ev"
        for c in ("event_id", "ts", "user_id", "event_type", "value", "props", "v")
    )
)
def non_null_counts(t):
    return agg.count_non_null(with_gaps(t))


@query("SELECT event_type, count(*) AS n, count(*) / (SELECT count(*) FROM events) AS share FROM events GROUP BY 1")
def value_counts(t):
    return agg.value_counts(t.events, "event_type", normalize=True)


_STATS = """count({0}) AS n, round(avg({0}), 9) AS mean, round(stddev_samp({0}), 9) AS std, min({0}) AS min,
    round(quantile_cont({0}, 0.25), 9) AS q25, round(quantile_cont({0}, 0.5), 9) AS q50,
    round(quantile_cont({0}, 0.75), 9) AS q75, max({0}) AS max"""
_ROUNDED = ("mean", "std", "q25", "q50", "q75")


def _rounded(df):
    return df.withColumns({c: rnd(c, 9) for c in _ROUNDED})


@query(f"WITH {GAPS} SELECT event_type, 'value' AS column, {_STATS.format('value')} FROM ev GROUP BY event_type")
def describe_numbers_by_group(t):
    return _rounded(agg.describe_numeric(t.events, ["value"], by="event_type"))


@query(
    f"WITH {GAPS} SELECT 'v' AS column, {_STATS.format('v')} FROM ev"
    f" UNION ALL SELECT 'value', {_STATS.format('value')} FROM ev"
)
def describe_numbers(t):
    return _rounded(agg.describe_numeric(with_gaps(t), ["v", "value"]))


@query(
    """
    WITH c AS (SELECT o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1)
    SELECT CAST(sum(n) AS BIGINT) AS count, count(*) AS unique, (SELECT v FROM c ORDER BY n DESC, v LIMIT 1) AS top,
           max(n) AS freq FROM c
    """
)
def describe_text(t):
    return agg.describe_text(t.orders, "o_orderpriority")


_PROFILE = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "props": "string",
    "v": "double",
}


@query(
    f"WITH {GAPS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, '{k}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls FROM ev"
        for c, k in _PROFILE.items()
    )
)
def profile_table(t):
    return agg.profile(with_gaps(t))


@query(
    """
    SELECT user_id, event_id AS idxmax, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1
    """
)
def key_of_maximum(t):
    return agg.idxmax(t.events, "value", "event_id", "event_id", by="user_id")


@query(
    """
    SELECT user_id, event_id AS idxmax, ts AS value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1
    """
)
def latest_event_of_user(t):
    return agg.idxmax(t.events, "ts", "event_id", "event_id", by="user_id")


@query("SELECT event_id AS idxmin, value FROM events ORDER BY value, event_id LIMIT 1")
def key_of_minimum(t):
    return agg.idxmin(t.events, "value", "event_id", "event_id")


@query(
    """
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS l_quantity_sum, round(avg(l_quantity), 9) AS l_quantity_mean,
           count(*) AS l_quantity_size, count(DISTINCT l_quantity) AS l_quantity_nunique,
           min(l_extendedprice) AS l_extendedprice_min, max(l_extendedprice) AS l_extendedprice_max,
           round(stddev_samp(l_extendedprice), 4) AS l_extendedprice_std,
           round(var_samp(l_discount), 9) AS l_discount_var, median(l_extendedprice) AS l_extendedprice_median,
           first(l_tax ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS l_tax_first,
           last(l_tax ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS l_tax_last
    FROM lineitem GROUP BY 1, 2
    """
)
def grouped_statistics(t):
    out = agg.group_agg(
        t.lineitem,
        ["l_returnflag", "l_linestatus"],
        {
            "l_quantity": ["sum", "mean", "size", "nunique"],
            "l_extendedprice": ["min", "max", "std", "median"],
            "l_discount": ["var"],
            "l_tax": ["first", "last"],
        },
        order_by=["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
    )
    places = {"l_quantity_mean": 9, "l_extendedprice_std": 4, "l_discount_var": 9}
    return out.withColumns({c: rnd(c, p) for c, p in places.items()})


@query("SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def group_by_expression(t):
    return agg.group_by_expr(
        t.orders,
        F.year("o_orderdate"),
        "year",
        [F.count(F.lit(1)).alias("n"), rnd(F.sum("o_totalprice"), 2).alias("total")],
    )


@query(
    """
    SELECT o_custkey, o_orderkey, o_orderdate FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 3
    """
)
def nth_row_of_group(t):
    out = agg.group_nth(t.orders, "o_custkey", 2, ["o_orderdate", "o_orderkey"])
    return out.select("o_custkey", "o_orderkey", "o_orderdate")


@query(
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3
    """
)
def head_of_group(t):
    out = agg.group_nth(t.orders, "o_custkey", 3, [("o_totalprice", "desc"), "o_orderkey"], head=True)
    return out.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 10 AND max(o_totalprice) > 490000)
    """
)
def filter_groups(t):
    cond = (F.count(F.lit(1)) > 10) & (F.max("o_totalprice") > 490000)
    return agg.group_filter(t.orders, "o_custkey", cond).select("o_orderkey", "o_custkey")


@query(
    """
    SELECT event_id, round(value - avg(value) OVER w, 9) AS demeaned,
           round((value - avg(value) OVER w) / stddev_samp(value) OVER w, 9) AS z
    FROM events WINDOW w AS (PARTITION BY user_id)
    """
)
def standardise_within_group(t):
    out = agg.group_transform(t.events, "user_id", "value", {"demeaned": "demean", "z": "zscore"})
    return out.select("event_id", rnd("demeaned", 9).alias("demeaned"), rnd("z", 9).alias("z"))


@query(
    f"WITH {GAPS} SELECT event_id, round(coalesce(v, avg(v) OVER (PARTITION BY user_id)), 9) AS v FROM ev"
)
def fill_with_group_mean(t):
    out = agg.group_transform(with_gaps(t), "user_id", "v", {"v": "fill_mean"})
    return out.select("event_id", rnd("v", 9).alias("v"))


def _mean_deviation(values: pd.Series) -> float:
    return (values - values.median()).abs().mean()


@query(
    """
    WITH m AS (SELECT user_id, value, median(value) OVER (PARTITION BY user_id) AS m FROM events)
    SELECT user_id, round(avg(abs(value - m)), 6) AS deviation FROM m GROUP BY 1
    """
)
def custom_aggregate(t):
    out = agg.group_custom(t.events, "user_id", {"deviation": (_mean_deviation, "value")})
    return out.withColumn("deviation", rnd("deviation", 6))


_GEOMETRIC = Mergeable(
    update=lambda values: {"n": len(values), "logs": float(np.log(values).sum())},
    merge=lambda states: {"n": int(states["n"].sum()), "logs": float(states["logs"].sum())},
    finish=lambda state: float(np.exp(state["logs"] / state["n"])) if state["n"] else None,
    state="n long, logs double",
)
_RANGE = Mergeable(
    update=lambda values: {"low": values.min(), "high": values.max()},
    merge=lambda states: {"low": states["low"].min(), "high": states["high"].max()},
    finish=lambda state: state["high"] - state["low"],
    state="low double, high double",
)


@query(
    """
    SELECT l_returnflag, round(exp(avg(ln(l_extendedprice))), 3) AS geometric, max(l_quantity) - min(l_quantity) AS spread
    FROM lineitem GROUP BY 1
    """
)
def custom_aggregate_of_any_size(t):
    wanted = {"geometric": (_GEOMETRIC, "l_extendedprice"), "spread": (_RANGE, "l_quantity")}
    return agg.group_custom(t.lineitem, "l_returnflag", wanted).withColumn("geometric", rnd("geometric", 3))


@query("SELECT round(exp(avg(ln(o_totalprice))), 3) AS geometric FROM orders")
def custom_aggregate_of_table(t):
    return agg.group_custom(t.orders, [], {"geometric": (_GEOMETRIC, "o_totalprice")}).select(rnd("geometric", 3).alias("geometric"))


def _spread(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(
        {"user_id": [pdf["user_id"].iloc[0]], "low": [pdf["value"].min()], "high": [pdf["value"].max()]}
    )


def _merged_spread(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(
        {"user_id": [pdf["user_id"].iloc[0]], "low": [pdf["low"].min()], "high": [pdf["high"].max()]}
    )


_SPREAD = "user_id long, low double, high double"


@query("SELECT user_id, min(value) AS low, max(value) AS high FROM events GROUP BY 1")
def function_per_group(t):
    return agg.group_apply(t.events.select("user_id", "value"), "user_id", _spread, _SPREAD)


@query("SELECT user_id, min(value) AS low, max(value) AS high FROM events GROUP BY 1")
def function_per_group_in_slices(t):
    rows = t.events.select("user_id", "event_id", "value")
    return agg.group_apply(
        rows, "user_id", _spread, _SPREAD, merge=_merged_spread, slice_key="event_id", slice_rows=20_000
    )


@query(
    """
    SELECT l_suppkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
           round(sum(l_extendedprice * l_discount) / sum(l_extendedprice), 6) AS discount_rate,
           max(l_quantity) - min(l_quantity) AS quantity_range, count(*) FILTER (l_returnflag = 'R') AS returned
    FROM lineitem GROUP BY 1
    """
)
def group_indicators(t):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return agg.group_metrics(
        t.lineitem,
        "l_suppkey",
        {
            "revenue": rnd(F.sum(price * (1 - discount)), 2),
            "discount_rate": rnd(F.sum(price * discount) / F.sum(price), 6),
            "quantity_range": F.max("l_quantity") - F.min("l_quantity"),
            "returned": F.count_if(F.col("l_returnflag") == "R"),
        },
    )


@query(
    f"""
    WITH {GAPS} SELECT user_id, event_type, round(coalesce(sum(v), 0), 4) AS sum FROM ev GROUP BY 1, 2
    """
)
def sum_of_missing_is_zero(t):
    out = agg.na_sum(with_gaps(t), ["user_id", "event_type"], "v")
    return out.withColumn("sum", rnd("sum"))


@query(
    """
    WITH e AS (SELECT user_id, event_type, CASE WHEN event_type <> 'error' THEN 1 + value / 1000 END AS g FROM events)
    SELECT user_id, event_type, round(coalesce(product(g), 1), 6) AS prod FROM e GROUP BY 1, 2
    """
)
def product_of_missing_is_one(t):
    growth = F.when(F.col("event_type") != "error", 1 + F.col("value") / 1000)
    out = agg.na_prod(t.events.withColumn("g", growth), ["user_id", "event_type"], "g")
    return out.withColumn("prod", rnd("prod", 6))


def _histogram_sql(table: str, by: str, value: str) -> str:
    return f"""
    WITH x AS (SELECT {by}, ({value})::DOUBLE AS x FROM {table}),
    e AS (SELECT {by}, min(x) AS lo, max(x) AS hi FROM x GROUP BY 1),
    b AS (SELECT x.{by}, lo, hi,
                 CAST(least(floor(coalesce((x - lo) / nullif(hi - lo, 0), 0) * 20), 19) AS BIGINT) AS bin
          FROM x JOIN e USING ({by}))
    SELECT {by}, bin, round(lo + bin * ((hi - lo) / 20), 6) AS lo, round(lo + (bin + 1) * ((hi - lo) / 20), 6) AS hi,
           count(*) AS n FROM b GROUP BY {by}, bin, b.lo, b.hi
    """


def _edges(df):
    return df.withColumns({c: rnd(c, 6) for c in ("lo", "hi")})


@query(_histogram_sql("orders", "o_orderstatus", "o_totalprice"))
def histogram_of_numbers(t):
    return _edges(agg.histogram(t.orders, F.col("o_totalprice"), by="o_orderstatus"))


@query(_histogram_sql("orders", "o_orderstatus", "ln(o_totalprice)"))
def histogram_of_logs(t):
    return _edges(agg.histogram(t.orders, natural_log(F.col("o_totalprice")), by="o_orderstatus"))


@query(_histogram_sql("documents", "lang", "length(text)"))
def histogram_of_text_lengths(t):
    return _edges(agg.histogram(t.documents, F.length("text"), by="lang"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def histogram_of_categories(t):
    return agg.category_histogram(t.orders, "o_orderpriority", "o_orderstatus")


@query(
    """
    WITH x AS (SELECT l_returnflag, l_linestatus, l_suppkey, sum(l_extendedprice * (1 - l_discount)) AS x
               FROM lineitem GROUP BY 1, 2, 3),
    p AS (SELECT l_returnflag, l_linestatus, x / sum(x) OVER (PARTITION BY l_returnflag, l_linestatus) AS p FROM x)
    SELECT l_returnflag, l_linestatus, round(-sum(p * log2(p)), 6) AS entropy FROM p GROUP BY 1, 2
    """
)
def entropy_of_revenue(t):
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    out = agg.entropy_index(t.lineitem, ["l_returnflag", "l_linestatus"], "l_suppkey", revenue)
    return out.withColumn("entropy", rnd("entropy", 6))


@query(
    """
    SELECT l_partkey, CASE WHEN count(*) > 2 THEN round((sum(l_quantity) - max(l_quantity) - min(l_quantity)) / (count(*) - 2), 9) END AS score,
           count(*) AS judges FROM lineitem GROUP BY 1
    """
)
def trimmed_judge_score(t):
    return agg.judge_score(t.lineitem, "l_partkey", "l_quantity").withColumn("score", rnd("score", 9))
