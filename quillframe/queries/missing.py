"""Missing data."""

from pyspark.sql import functions as F

from ..operators import missing
from .registry import GAPS, query, rnd, with_gaps

_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props", "v")


def _gaps(t, *cols):
    return with_gaps(t).select("event_id", "user_id", "ts", "v", *cols)


@query(
    f"WITH {GAPS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, count(*) - count({c}) AS nulls, (count(*) - count({c})) / count(*) AS share FROM ev"
        for c in _COLUMNS
    )
)
def null_report(t):
    return missing.null_report(with_gaps(t))


@query(f"WITH {GAPS} SELECT event_id, event_type FROM ev WHERE v IS NULL")
def rows_with_nulls(t):
    return missing.rows_with_nulls(with_gaps(t)).select("event_id", "event_type")


@query(
    """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
           CASE WHEN event_type NOT IN ('view', 'click') THEN event_type END AS kind
    FROM events
    """
)
def unify_missing_markers(t):
    kind = F.col("event_type")
    marked = t.events.select(
        "event_id",
        F.when(kind == "error", float("nan")).otherwise(F.col("value")).alias("value"),
        F.when(kind == "view", "").when(kind == "click", "n/a").otherwise(kind).alias("kind"),
    )
    return missing.unify_missing(marked, markers=["", "n/a"])


@query(
    """
    SELECT event_id, user_id, value, CAST(ts AS DATE) AS day, event_type, event_type = 'error' AS failed,
           CASE WHEN event_type <> 'error' THEN CAST(round(value) AS BIGINT) END AS whole
    FROM events
    """
)
def convert_to_narrowest_types(t):
    failed = F.col("event_type") == "error"
    texts = t.events.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.col("value").cast("string").alias("value"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        "event_type",
        failed.cast("string").alias("failed"),
        F.when(~failed, F.round("value")).alias("whole"),
    )
    return missing.convert_types(texts)


@query(
    """
    SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind, count(*) AS n, max(value) AS top FROM events
    WHERE event_type <> 'error' GROUP BY 1
    """
)
def group_without_null_keys(t):
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind")
    rows = t.events.select(kind, "value")
    return missing.group_drop_null_keys(
        rows, "kind", [F.count(F.lit(1)).alias("n"), F.max("value").alias("top")]
    )


@query(f"WITH {GAPS} SELECT event_id, coalesce(v, 0.0)::DOUBLE AS v FROM ev")
def fill_constant(t):
    return missing.fillna(_gaps(t), {"v": 0.0}).select("event_id", "v")


_RANKED = f"""
    WITH {GAPS},
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM ev),
    n AS (SELECT *,
        last_value(v IGNORE NULLS) OVER f AS pv, last_value(CASE WHEN v IS NOT NULL THEN rn END IGNORE NULLS) OVER f AS pr,
        last_value(CASE WHEN v IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER f AS pt,
        last_value(v IGNORE NULLS) OVER b AS nv, last_value(CASE WHEN v IS NOT NULL THEN rn END IGNORE NULLS) OVER b AS nr,
        last_value(CASE WHEN v IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER b AS nt
        FROM r WINDOW f AS (PARTITION BY user_id ORDER BY rn), b AS (PARTITION BY user_id ORDER BY rn DESC))
"""
_ORDER = ["ts", "event_id"]


@query(_RANKED + "SELECT event_id, pv AS v FROM n")
def fill_forward(t):
    return missing.fill_forward(_gaps(t), "user_id", _ORDER, "v").select("event_id", "v")


@query(_RANKED + "SELECT event_id, CASE WHEN rn - pr <= 1 THEN pv END AS v FROM n")
def fill_forward_one_row(t):
    return missing.fill_forward(_gaps(t), "user_id", _ORDER, "v", limit=1).select("event_id", "v")


@query(_RANKED + "SELECT event_id, nv AS v FROM n")
def fill_backward(t):
    return missing.fill_backward(_gaps(t), "user_id", _ORDER, "v").select("event_id", "v")


@query(
    f"""
    WITH {GAPS} SELECT event_id, last_value(v IGNORE NULLS) OVER (ORDER BY ts, event_id) AS v FROM ev
    """
)
def fill_forward_whole_table(t):
    return missing.fill_forward(_gaps(t), None, _ORDER, "v").select("event_id", "v")


@query(f"WITH {GAPS} SELECT event_id, round(coalesce(v, (SELECT avg(v) FROM ev)), 9) AS v FROM ev")
def fill_mean(t):
    return missing.fill_stat(_gaps(t), "v", "mean").select("event_id", rnd("v", 9).alias("v"))


@query(
    f"""
    WITH {GAPS}, m AS (SELECT user_id, median(v) AS m FROM ev WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1)
    SELECT event_id, round(coalesce(v, m), 9) AS v FROM ev LEFT JOIN m USING (user_id)
    """
)
def fill_group_median_fitted_before(t):
    rows = _gaps(t)
    train = rows.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    out = missing.fill_stat(rows, "v", "median", by="user_id", fit_on=train)
    return out.select("event_id", rnd("v", 9).alias("v"))


_SPARSE = """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS a, CASE WHEN value < 100 THEN value END AS b,
           CASE WHEN event_type IN ('view', 'click') THEN user_id END AS c FROM events
"""


def _sparse(t):
    return t.events.select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("a"),
        F.when(F.col("value") < 100, F.col("value")).alias("b"),
        F.when(F.col("event_type").isin("view", "click"), F.col("user_id")).alias("c"),
    )


@query(f"SELECT * FROM ({_SPARSE}) WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL")
def drop_rows_with_any_null(t):
    return missing.dropna(_sparse(t))


@query(f"SELECT * FROM ({_SPARSE}) WHERE a IS NOT NULL OR c IS NOT NULL")
def drop_rows_all_null(t):
    return missing.dropna(_sparse(t), how="all", subset=["a", "c"])


@query(
    f"""SELECT * FROM ({_SPARSE})
    WHERE (a IS NOT NULL)::INTEGER + (b IS NOT NULL)::INTEGER + (c IS NOT NULL)::INTEGER >= 2"""
)
def drop_rows_below_threshold(t):
    return missing.dropna(_sparse(t), thresh=2, subset=["a", "b", "c"])


@query(f"SELECT event_id, a, b FROM ({_SPARSE})")
def drop_sparse_columns(t):
    return missing.drop_null_columns(_sparse(t), 0.3)


_LINE = "pv + (nv - pv) * ((rn - pr) / (nr - pr))"


@query(
    _RANKED
    + f"SELECT event_id, round(CASE WHEN v IS NOT NULL THEN v WHEN nv IS NULL THEN pv ELSE {_LINE} END, 9) AS v FROM n"
)
def interpolate_by_position(t):
    out = missing.interpolate_linear(_gaps(t), "user_id", _ORDER, "v")
    return out.select("event_id", rnd("v", 9).alias("v"))


@query(
    _RANKED
    + """SELECT event_id, round(CASE WHEN v IS NOT NULL THEN v WHEN nv IS NULL THEN pv
         ELSE pv + (nv - pv) * ((epoch_us(ts) - pt) / (nt - pt)) END, 9) AS v FROM n"""
)
def interpolate_by_time(t):
    out = missing.interpolate_time(_gaps(t), "user_id", _ORDER, "v")
    return out.select("event_id", rnd("v", 9).alias("v"))


@query(
    _RANKED
    + """SELECT event_id, CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL OR nv IS NULL THEN NULL
         WHEN epoch_us(ts) - pt <= nt - epoch_us(ts) THEN pv ELSE nv END AS v FROM n"""
)
def interpolate_nearest(t):
    return missing.interpolate_nearest(_gaps(t), "user_id", _ORDER, "v").select("event_id", "v")


@query(
    _RANKED
    + f"""SELECT event_id, round(CASE WHEN v IS NOT NULL THEN v
          WHEN pv IS NOT NULL AND nv IS NOT NULL AND (rn - pr <= 1 OR nr - rn <= 1) THEN {_LINE} END, 9) AS v FROM n"""
)
def interpolate_inside_from_both_ends(t):
    out = missing.interpolate(
        _gaps(t), "user_id", _ORDER, "v", limit=1, limit_direction="both", limit_area="inside"
    )
    return out.select("event_id", rnd("v", 9).alias("v"))


@query(
    _RANKED
    + """SELECT event_id, CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL AND nr - rn <= 2 THEN nv
         WHEN nv IS NULL AND rn - pr <= 2 THEN pv END AS v FROM n"""
)
def interpolate_outside_only(t):
    out = missing.interpolate(
        _gaps(t), "user_id", _ORDER, "v", limit=2, limit_direction="both", limit_area="outside"
    )
    return out.select("event_id", "v")


@query(
    _RANKED
    + f"""SELECT event_id, round(CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN NULL
          ELSE {_LINE} END, 9) AS v FROM n"""
)
def interpolate_backward(t):
    out = missing.interpolate(_gaps(t), "user_id", _ORDER, "v", limit_direction="backward")
    return out.select("event_id", rnd("v", 9).alias("v"))
