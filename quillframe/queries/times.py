"""Dates, resampling and rolling windows."""

from pyspark.sql import functions as F

from ..functions.dates import DAY
from ..operators import rolling, timeseries as ts
from .registry import GAPS, query, rnd, with_gaps


@query(
    """
    SELECT o_orderkey, o_orderdate AS parsed, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS coerced FROM orders
    """
)
def parse_dates(t):
    text = F.date_format("o_orderdate", "dd.MM.yyyy HH:mm")
    rows = t.orders.select(
        "o_orderkey", text.alias("a"), F.when(F.col("o_orderstatus") == "P", "soon").otherwise(text).alias("b")
    )
    out = ts.to_datetime(rows, "a", "dd.MM.yyyy HH:mm", "parsed")
    out = ts.to_datetime(out, "b", "dd.MM.yyyy HH:mm", "coerced", errors="coerce")
    return out.select("o_orderkey", "parsed", "coerced")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, epoch(l_shipdate) - epoch(o_orderdate) AS waited,
           date_trunc('month', l_shipdate)::TIMESTAMP AS month, last_day(l_shipdate)::TIMESTAMP AS month_end,
           date_trunc('quarter', l_shipdate)::TIMESTAMP AS quarter
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """
)
def durations_and_periods(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    out = ts.time_difference(rows, "l_shipdate", "o_orderdate", "waited")
    for freq, name in (("MS", "month"), ("M", "month_end"), ("QS", "quarter")):
        out = ts.period_of(out, "l_shipdate", freq, name)
    return out.select("l_orderkey", "l_linenumber", "l_shipdate", "waited", "month", "month_end", "quarter")


@query(
    """
    WITH d AS (SELECT unnest(generate_series(TIMESTAMP '1992-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS day)
    SELECT day, coalesce(n, 0) AS n
    FROM d LEFT JOIN (SELECT o_orderdate AS day, count(*) AS n FROM orders GROUP BY 1) USING (day)
    WHERE isodow(day) < 6
    """
)
def business_days_with_orders(t):
    days = ts.date_range(t.spark, "1992-01-01", "2001-12-31", "B", "day")
    counts = t.orders.groupBy(F.col("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(counts, "day", "left").na.fill(0, ["n"])


@query(
    """
    WITH d AS (SELECT unnest(generate_series(TIMESTAMP '1992-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH)) AS m)
    SELECT last_day(m)::TIMESTAMP AS month, count(o_orderkey) AS n
    FROM d LEFT JOIN orders ON date_trunc('month', o_orderdate) = m GROUP BY 1
    """
)
def month_ends_with_orders(t):
    months = ts.date_range(t.spark, "1992-01-01", "2001-12-31", "M", "month")
    counts = ts.period_of(t.orders, "o_orderdate", "M", "month").groupBy("month").agg(F.count("o_orderkey").alias("n"))
    return months.join(counts, "month", "left").na.fill(0, ["n"])


@query(
    """
    WITH o AS (SELECT o_orderkey, o_orderdate AS d, isodow(o_orderdate) - 1 AS wd FROM orders)
    SELECT o_orderkey, (d + INTERVAL 1 MONTH)::TIMESTAMP AS next_month,
           CASE WHEN d::DATE = last_day(d) THEN last_day(d + INTERVAL 1 DAY) ELSE last_day(d) END::TIMESTAMP AS month_end,
           date_trunc('month', d + INTERVAL 1 MONTH)::TIMESTAMP AS month_start,
           (d + INTERVAL 1 DAY * (CASE WHEN wd >= 4 THEN 7 - wd ELSE 1 END))::TIMESTAMP AS next_business,
           (d - INTERVAL 1 DAY * (CASE wd WHEN 0 THEN 3 WHEN 6 THEN 2 ELSE 1 END))::TIMESTAMP AS last_business
    FROM o
    """
)
def calendar_offsets(t):
    out = t.orders
    for offset, n, name in (
        ("months", 1, "next_month"),
        ("month_end", 1, "month_end"),
        ("month_start", 1, "month_start"),
        ("business_days", 1, "next_business"),
        ("business_days", -1, "last_business"),
    ):
        out = ts.add_offset(out, "o_orderdate", offset, n, name)
    return out.select("o_orderkey", "next_month", "month_end", "month_start", "next_business", "last_business")


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-09' AND ts < TIMESTAMP '2024-01-17 13:00:00'")
def slice_by_partial_date(t):
    return ts.time_slice(t.events, "ts", "2024-01-09", "2024-01-17 12").select("event_id", "ts")


@query(
    """
    SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'
      AND hour(ts) BETWEEN 8 AND 16 AND isodow(ts) IN (1, 3, 5)
    """
)
def subset_by_time_of_day(t):
    kept = ts.time_subset(t.events, "ts", period="2024-01", weekdays=[0, 2, 4], hours=(8, 16))
    return kept.select("event_id", "ts")


@query(
    """
    SELECT event_id, year(ts)::INTEGER AS year, quarter(ts)::INTEGER AS quarter, month(ts)::INTEGER AS month,
           week(ts)::INTEGER AS week, day(ts)::INTEGER AS day, (isodow(ts) - 1)::INTEGER AS weekday,
           hour(ts)::INTEGER AS hour, ts::DATE = last_day(ts) AS is_month_end, strftime(ts, '%Y/%m/%d %H:%M') AS formatted
    FROM events
    """
)
def parts_of_time(t):
    names = ["year", "quarter", "month", "week", "day", "weekday", "hour", "is_month_end", "formatted"]
    return ts.time_parts(t.events, "ts").select("event_id", *names)


def _buckets(step: str, by: str = "") -> str:
    key = f"{by}, " if by else ""
    first = f"(min(ts) OVER (PARTITION BY {by}))" if by else "(min(ts) OVER ())"
    using = f"({key}bucket)"
    group = f"GROUP BY {by}" if by else ""
    return f"""
    WITH {GAPS}, b AS (SELECT *, time_bucket(INTERVAL '{step}', ts, date_trunc('day', {first})::TIMESTAMP) AS bucket FROM ev),
    e AS (SELECT {key}min(bucket) AS lo, max(bucket) AS hi FROM b {group}),
    s AS (SELECT {key}unnest(generate_series(lo, hi, INTERVAL '{step}')) AS bucket FROM e),
    a AS (SELECT {key}bucket, sum(v) AS total, avg(v) AS mean, max(v) AS top, count(v) AS known, count(*) AS size
          FROM b GROUP BY {key}bucket)
    SELECT {key}bucket, round(coalesce(total, 0), 4) AS total, round(mean, 9) AS mean, top, coalesce(known, 0) AS known,
           coalesce(size, 0) AS size FROM s LEFT JOIN a USING {using}
    """


_SPEC = {
    "total": ("sum", "v"),
    "mean": ("mean", "v"),
    "top": ("max", "v"),
    "known": ("count", "v"),
    "size": ("size", "v"),
}


def _rounded(df):
    return df.withColumn("total", rnd("total")).withColumn("mean", rnd("mean", 9))


@query(_buckets("15 minutes"))
def resample_quarter_hours(t):
    return _rounded(ts.resample(with_gaps(t), "ts", "15min", _SPEC))


@query(_buckets("6 hours", "user_id"))
def resample_by_user(t):
    return _rounded(ts.resample(with_gaps(t), "ts", "6h", _SPEC, by="user_id"))


@query(_buckets("7 hours"))
def resample_seven_hours(t):
    return _rounded(ts.resample(with_gaps(t), "ts", "7h", _SPEC))


@query(_buckets("2 days", "user_id"))
def resample_two_days_by_user(t):
    return _rounded(ts.resample(with_gaps(t), "ts", "2D", _SPEC, by="user_id"))


@query(
    """
    WITH b AS (SELECT *, time_bucket(INTERVAL '50 minutes', ts, min(ts) OVER (PARTITION BY event_type)) AS bucket FROM events),
    e AS (SELECT event_type, min(bucket) AS lo, max(bucket) AS hi FROM b GROUP BY 1),
    s AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 50 MINUTE)) AS bucket FROM e)
    SELECT event_type, bucket, min(value) AS value_min, count(event_id) AS event_id_count
    FROM s LEFT JOIN b USING (event_type, bucket) GROUP BY 1, 2
    """
)
def resample_from_first_event(t):
    return ts.resample_agg(t.events, "ts", "50min", {"value": ["min"], "event_id": ["count"]}, by="event_type", origin="start")


@query(
    """
    WITH e AS (SELECT min(date_trunc('month', o_orderdate)) AS lo, max(date_trunc('month', o_orderdate)) AS hi FROM orders),
    s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS m FROM e)
    SELECT last_day(m)::TIMESTAMP AS bucket, round(coalesce(sum(o_totalprice), 0), 2) AS total
    FROM s LEFT JOIN orders ON date_trunc('month', o_orderdate) = m GROUP BY 1
    """
)
def resample_months(t):
    out = ts.resample(t.orders, "o_orderdate", "M", {"total": ("sum", "o_totalprice")})
    return out.withColumn("total", rnd("total", 2))


@query(
    """
    SELECT (date_trunc('week', ts) + INTERVAL 6 DAY)::TIMESTAMP AS bucket, count(*) AS n, round(avg(value), 9) AS mean
    FROM events GROUP BY 1
    """
)
def resample_weeks(t):
    out = ts.resample(t.events, "ts", "W", {"n": ("size", "value"), "mean": ("mean", "value")})
    return out.withColumn("mean", rnd("mean", 9))


@query(
    """
    WITH b AS (SELECT *, date_trunc('hour', ts) AS bucket FROM events),
    s AS (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 HOUR)) AS bucket FROM b)
    SELECT bucket, first(value ORDER BY ts, event_id) AS value_open, max(value) AS value_high, min(value) AS value_low,
           last(value ORDER BY ts, event_id) AS value_close, round(stddev_samp(value), 6) AS value_std, count(event_id) AS event_id_count
    FROM s LEFT JOIN b USING (bucket) GROUP BY 1
    """
)
def resample_open_high_low_close(t):
    out = ts.resample_agg(
        t.events, "ts", "h", {"value": ["ohlc", "std"], "event_id": ["count"]}, order_by=["event_id"]
    )
    return out.withColumn("value_std", rnd("value_std", 6))


_DAYS = """
    WITH d AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS ts, round(sum(value), 4) AS total FROM events GROUP BY 1, 2),
    e AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM d GROUP BY 1),
    s AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 6 HOUR)) AS ts FROM e),
    j AS (SELECT user_id, ts, total FROM s LEFT JOIN d USING (user_id, ts)),
    n AS (SELECT *, last_value(total IGNORE NULLS) OVER f AS pv, last_value(CASE WHEN total IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER f AS pt,
          last_value(total IGNORE NULLS) OVER b AS nv, last_value(CASE WHEN total IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER b AS nt,
          FROM j WINDOW f AS (PARTITION BY user_id ORDER BY ts), b AS (PARTITION BY user_id ORDER BY ts DESC))
"""


def _days(t):
    day = F.to_date("ts").cast("timestamp_ntz").alias("ts")
    return t.events.groupBy("user_id", day).agg(rnd(F.sum("value")).alias("total"))


@query(_DAYS + "SELECT user_id, ts, pv AS total FROM n")
def upsample_forward(t):
    return ts.resample_upsample(_days(t), "ts", "6h", "total", "ffill", by="user_id")


@query(_DAYS + "SELECT user_id, ts, nv AS total FROM n")
def upsample_backward(t):
    return ts.resample_upsample(_days(t), "ts", "6h", "total", "bfill", by="user_id")


@query(
    _DAYS
    + """SELECT user_id, ts, round(CASE WHEN total IS NOT NULL THEN total
         ELSE pv + (nv - pv) * ((epoch_us(ts) - pt) / (nt - pt)) END, 6) AS total FROM n"""
)
def upsample_linear(t):
    out = ts.resample_upsample(_days(t), "ts", "6h", "total", "linear", by="user_id")
    return out.withColumn("total", rnd("total", 6))


@query(
    """
    WITH d AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS ts, round(sum(value), 4) AS total FROM events GROUP BY 1, 2),
    s AS (SELECT user_id, unnest(generate_series(min(ts), max(ts), INTERVAL 7 HOUR)) AS ts FROM d GROUP BY 1),
    j AS (SELECT user_id, ts, total, s.ts IS NOT NULL AS listed FROM d FULL JOIN s USING (user_id, ts))
    SELECT user_id, ts, total FROM (
        SELECT user_id, ts, listed, last_value(total IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts) AS total FROM j
    ) WHERE listed
    """
)
def upsample_seven_hours(t):
    return ts.resample_upsample(_days(t), "ts", "7h", "total", "ffill", by="user_id")


@query(
    """
    SELECT event_id, date_trunc('day', ts)::TIMESTAMP AS bucket, count(*) OVER (PARTITION BY CAST(ts AS DATE)) AS bucket_rows
    FROM events
    """
)
def rows_with_bucket(t):
    return ts.bucket_rows(t.events, "ts", "D").select("event_id", "bucket", "bucket_rows")


_BY_USER = "PARTITION BY user_id ORDER BY ts, event_id"
_ORDER = ["ts", "event_id"]


@query(
    f"""
    WITH {GAPS}
    SELECT event_id, round(CASE WHEN count(v) OVER a >= 5 THEN avg(v) OVER a END, 9) AS mean,
           round(CASE WHEN count(v) OVER a >= 2 THEN stddev_samp(v) OVER a END, 6) AS std,
           CASE WHEN count(v) OVER c >= 1 THEN max(v) OVER c END AS centred_max
    FROM ev WINDOW a AS ({_BY_USER} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
                   c AS ({_BY_USER} ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING)
    """
)
def rolling_rows(t):
    out = rolling.rolling_rows(with_gaps(t), "user_id", _ORDER, "v", 5, {"mean": "mean"})
    out = rolling.rolling_rows(out, "user_id", _ORDER, "v", 5, {"std": "std"}, min_periods=2)
    out = rolling.rolling_rows(
        out, "user_id", _ORDER, "v", 6, {"centred_max": "max"}, min_periods=1, center=True
    )
    return out.select(
        "event_id", rnd("mean", 9).alias("mean"), rnd("std", 6).alias("std"), "centred_max"
    )


@query(
    f"""
    WITH {GAPS}
    SELECT event_id, round(sum(v) OVER w, 6) AS total, count(v) OVER w AS n FROM ev
    WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN {2 * DAY - 1} PRECEDING AND CURRENT ROW)
    """
)
def rolling_two_days(t):
    out = rolling.rolling_time(
        with_gaps(t), "user_id", "ts", 2 * DAY, "v", {"total": "sum", "n": "count"}, min_periods=0
    )
    return out.select("event_id", rnd("total", 6).alias("total"), "n")


@query(
    f"""
    SELECT event_id, round(avg(value) OVER w, 9) AS mean, max(value) OVER w AS top, min(value) OVER w AS low,
           round(stddev_samp(value) OVER w, 6) AS std
    FROM events WINDOW w AS (ORDER BY epoch_us(ts) RANGE BETWEEN {6 * 3_600_000_000 - 1} PRECEDING AND CURRENT ROW)
    """
)
def rolling_hours_whole_table(t):
    wanted = {"mean": "mean", "top": "max", "low": "min", "std": "std"}
    out = rolling.rolling_time(t.events, None, "ts", 6 * 3_600_000_000, "value", wanted)
    return out.select("event_id", rnd("mean", 9).alias("mean"), "top", "low", rnd("std", 6).alias("std"))


@query(
    f"""
    SELECT event_id, round(quantile_cont(value, 0.5) OVER w, 6) AS middle, round(quantile_cont(value, 0.9) OVER w, 6) AS high
    FROM events WINDOW w AS (ORDER BY epoch_us(ts) RANGE BETWEEN {DAY - 1} PRECEDING AND CURRENT ROW)
    """
)
def rolling_day_quantiles_whole_table(t):
    out = rolling.rolling_time(t.events, None, "ts", DAY, "value", {"middle": "median", "high": 0.9})
    return out.select("event_id", rnd("middle", 6).alias("middle"), rnd("high", 6).alias("high"))


@query(
    f"""
    WITH {GAPS}
    SELECT event_id, CASE WHEN count(v) OVER w >= 3 THEN round(quantile_cont(v, 0.5) OVER w, 6) END AS middle
    FROM ev WINDOW w AS (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN {2 * DAY - 1} PRECEDING AND CURRENT ROW)
    """
)
def rolling_two_day_median_by_type(t):
    out = rolling.rolling_time(with_gaps(t), "event_type", "ts", 2 * DAY, "v", {"middle": "median"}, min_periods=3)
    return out.select("event_id", rnd("middle", 6).alias("middle"))


_LINES = ["l_orderkey", "l_linenumber"]
_BY_LINE = "ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"
_LINE_ORDER = [*_LINES, "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
_200 = "ROWS BETWEEN 199 PRECEDING AND CURRENT ROW"
_LONG = """
    SELECT l_orderkey, l_linenumber, CASE WHEN count(*) OVER w >= 200 THEN (sum(l_partkey) OVER w)::BIGINT END AS total,
           round(CASE WHEN count(*) OVER w >= 200 THEN avg(l_quantity) OVER w END, 6) AS mean,
           round(CASE WHEN count(*) OVER w >= 200 THEN var_samp(l_quantity) OVER w END, 6) AS var,
           CASE WHEN count(*) OVER w >= 200 THEN max(l_extendedprice) OVER w END AS top
    FROM lineitem WINDOW w AS ({} {} {})
"""


def _long_frames(t, by):
    wanted = {"total": ("sum", "l_partkey"), "mean": ("mean", "l_quantity"), "var": ("var", "l_quantity"), "top": ("max", "l_extendedprice")}
    out = rolling.rolling_rows(t.lineitem.select(*_LINE_ORDER, "l_quantity"), by, _LINE_ORDER, None, 200, wanted)
    return out.select(*_LINES, "total", rnd("mean", 6).alias("mean"), rnd("var", 6).alias("var"), "top")


@query(_LONG.format("PARTITION BY l_suppkey", _BY_LINE, _200))
def rolling_200_rows_by_group(t):
    return _long_frames(t, "l_suppkey")


@query(
    f"""
    SELECT l_orderkey, l_linenumber, CASE WHEN count(*) OVER w >= 200 THEN (sum(l_partkey) OVER w)::BIGINT END AS total,
           CASE WHEN count(*) OVER w >= 200 THEN quantile_cont(l_quantity, 0.5) OVER w END AS middle
    FROM lineitem WINDOW w AS ({_BY_LINE} {_200})
    """
)
def rolling_200_rows_whole_table(t):
    wanted = {"total": ("sum", "l_partkey"), "middle": ("median", "l_quantity")}
    out = rolling.rolling_rows(t.lineitem.select(*_LINE_ORDER, "l_quantity"), None, _LINE_ORDER, None, 200, wanted)
    return out.select(*_LINES, "total", "middle")


@query(
    f"""
    WITH f AS (SELECT event_id, list(value) OVER ({_BY_USER} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS f FROM events)
    SELECT event_id, CASE WHEN len(f) >= 4 THEN round(list_max(f) - list_min(f), 6) END AS span FROM f
    """
)
def rolling_custom_function(t):
    spread = lambda values: rnd(F.array_max(values) - F.array_min(values), 6)
    out = rolling.rolling_apply(t.events, "user_id", _ORDER, "value", 4, spread, "span")
    return out.select("event_id", "span")


@query(
    """
    WITH s AS (SELECT l_suppkey, l_shipdate, sum(l_quantity) AS q, sum(l_extendedprice) AS p FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey, l_shipdate, CASE WHEN count(*) OVER w >= 10 THEN round(covar_samp(q, p) OVER w, 4) END AS cov,
           CASE WHEN count(*) OVER w >= 10 THEN round(corr(q, p) OVER w, 6) END AS corr
    FROM s WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
    """
)
def rolling_covariance(t):
    daily = t.lineitem.groupBy("l_suppkey", "l_shipdate").agg(
        F.sum("l_quantity").alias("q"), F.sum("l_extendedprice").alias("p")
    )
    out = rolling.rolling_cov_corr(daily, "l_suppkey", "l_shipdate", "q", "p", 10)
    return out.select("l_suppkey", "l_shipdate", rnd("cov", 4).alias("cov"), rnd("corr", 6).alias("corr"))


@query(
    f"""
    WITH {GAPS}
    SELECT event_id, round(sum(v) OVER w, 6) AS total, round(avg(v) OVER w, 9) AS mean, min(v) OVER w AS low,
           max(v) OVER w AS high, count(v) OVER w AS n
    FROM ev WINDOW w AS ({_BY_USER} ROWS UNBOUNDED PRECEDING)
    """
)
def expanding_statistics(t):
    wanted = {"total": "sum", "mean": "mean", "low": "min", "high": "max", "n": "count"}
    out = rolling.expanding(with_gaps(t), "user_id", _ORDER, "v", wanted, min_periods=0)
    return out.select("event_id", rnd("total", 6).alias("total"), rnd("mean", 9).alias("mean"), "low", "high", "n")
