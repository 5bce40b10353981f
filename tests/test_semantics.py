"""Small hand-written cases, most of them compared with pandas."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillframe import sources as io
from quillframe.functions.text import repair_text
from quillframe.operators import (
    aggregate,
    category,
    joins,
    keys,
    metrics,
    missing,
    models,
    order,
    reshape,
    rolling,
    select,
    split,
    text,
    timeseries,
)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def column(df, name, by="id"):
    return [r[0] for r in df.orderBy(by).select(name).collect()]


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        if w is None or (isinstance(w, float) and math.isnan(w)):
            assert g is None or (isinstance(g, float) and math.isnan(g))
        else:
            assert g == pytest.approx(w)


@pytest.fixture(scope="module")
def gaps(spark):
    values = [None, None, 1.0, None, None, None, 5.0, 7.0, None, None]
    return spark.createDataFrame(list(enumerate(values)), "id long, v double").withColumn("g", F.lit("a"))


SERIES = pd.Series([np.nan, np.nan, 1, np.nan, np.nan, np.nan, 5, 7, np.nan, np.nan])


@pytest.mark.parametrize("direction", ["forward", "backward", "both"])
@pytest.mark.parametrize("limit", [None, 1, 2])
@pytest.mark.parametrize("area", [None, "inside", "outside"])
def test_interpolate_like_pandas(gaps, direction, limit, area):
    got = missing.interpolate(gaps, "g", "id", "v", limit=limit, limit_direction=direction, limit_area=area)
    want = SERIES.interpolate(limit=limit, limit_direction=direction, limit_area=area)
    same(column(got, "v"), list(want))


@pytest.mark.parametrize("limit", [None, 1, 2])
def test_fill_like_pandas(gaps, limit):
    same(column(missing.fill_forward(gaps, "g", "id", "v", limit), "v"), list(SERIES.ffill(limit=limit)))
    same(column(missing.fill_backward(gaps, "g", "id", "v", limit), "v"), list(SERIES.bfill(limit=limit)))


def test_interpolate_all_null_and_single(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", 1, 3.0)], "g string, id long, v double")
    assert rows(missing.interpolate_linear(df, "g", "id", "v")) == [("a", 1, None), ("a", 2, None), ("b", 1, 3.0)]


def test_nearest_prefers_the_earlier_on_ties(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None), (2, None), (3, None), (4, 9.0)], "id long, v double")
    out = missing.interpolate_nearest(df.withColumn("g", F.lit(1)), "g", "id", "v")
    assert column(out, "v") == [1.0, 1.0, 1.0, 9.0, 9.0]


@pytest.fixture(scope="module")
def sides(spark):
    left = [(1, "a", 10), (2, "b", 20), (2, "c", 30), (None, "d", 40)]
    right = [(2, "x", 1), (2, "y", 2), (3, "z", 3), (None, "n", 4)]
    return (
        spark.createDataFrame(left, "k int, p string, v int"),
        spark.createDataFrame(right, "k int, q string, v int"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_merge_like_pandas(sides, how):
    left, right = sides
    got = joins.merge(left, right, on="k", how=how, nulls_match=True, indicator="side")
    pl = pd.DataFrame([(1, "a", 10), (2, "b", 20), (2, "c", 30), (None, "d", 40)], columns=["k", "p", "v"])
    pr = pd.DataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 3), (None, "n", 4)], columns=["k", "q", "v"])
    want = pl.merge(pr, on="k", how=how, indicator="side").astype(object)
    want = want.where(want.notna(), None)
    assert got.columns == ["k", "p", "v_x", "q", "v_y", "side"]
    assert rows(got) == sorted([tuple(r) for r in want.values.tolist()], key=str)


def test_merge_sql_nulls_do_not_match(sides):
    left, right = sides
    got = joins.merge(left, right, on="k", how="outer")
    assert got.count() == 4 + 1 + 1 + 2  # matches, key 1, key 3, one null row per side


def test_merge_validate(sides):
    left, right = sides
    for kind in ("1:1", "1:m", "m:1"):
        with pytest.raises(ValueError):
            joins.merge(left, right, on="k", validate=kind)
    joins.merge(left, right, on="k", validate="m:m")


def test_merge_how_with_unique_side(sides):
    left, right = sides
    unique = right.filter("q != 'y'")
    expected = rows(joins.merge(left, unique, on="k", how="left"))
    assert rows(joins.merge(left, unique, on="k", how="left", validate="m:1")) == expected


@pytest.mark.parametrize("closed", ["left", "right", "both", "neither"])
def test_interval_lookup_by_hand(spark, closed):
    points = [(i, x) for i, x in enumerate([-5.0, 0.0, 1.0, 2.5, 10.0, 100.0, 1e6])]
    bands = [(0, 0.0, 1.0), (1, 1.0, 10.0), (2, -10.0, 1e7), (3, 10.0, 10.0), (4, 2.5, 2.75)]
    p = spark.createDataFrame(points, "id int, x double")
    b = spark.createDataFrame(bands, "band int, lo double, hi double")
    low = closed in ("left", "both")
    high = closed in ("right", "both")
    want = [
        (i, k)
        for i, x in points
        for k, lo, hi in bands
        if (x > lo or low and x == lo) and (x < hi or high and x == hi)
    ]
    assert rows(joins.interval_lookup(p, b, "x", closed=closed), "id", "band") == sorted(want, key=str)


def test_update_and_combine_first(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, 2.0, None)], "k int, v double, s string")
    b = spark.createDataFrame([(1, 9.0), (3, 7.0)], "k int, v double")
    assert rows(joins.update(a, b, ["k"])) == [(1, 9.0, "x"), (2, 2.0, None)]
    assert rows(joins.combine_first(a, b, ["k"])) == [(1, 9.0, "x"), (2, 2.0, None), (3, 7.0, None)]


def test_where_and_mask_with_unknown_condition(spark):
    df = spark.createDataFrame([(1, 5.0, None), (2, 6.0, 1), (3, 7.0, 0)], "id int, v double, c int")
    assert column(select.where(df, F.col("c") == 1, ["v"]), "v") == [None, 6.0, None]
    assert column(select.mask(df, F.col("c") == 1, ["v"], 0.0), "v") == [5.0, 0.0, 7.0]


def test_clip_and_log(spark):
    df = spark.createDataFrame([(1, None), (2, -3.0), (3, 0.0), (4, 9.0)], "id int, v double")
    assert column(select.clip(df, "v", -1.0, 5.0), "v") == [None, -1.0, 0.0, 5.0]
    got = column(select.log_transform(df, "v", "l"), "l")
    assert got[0] is None and math.isnan(got[1]) and got[2] == -math.inf and got[3] == pytest.approx(math.log(9))


def test_row_apply_on_columns_and_on_batches(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 5.0)], "id int, v double")
    assert column(select.row_apply(df, "o", lambda a, b: a * b, ["id", "v"]), "o") == [2.0, 10.0]
    assert column(select.row_apply(df, "o", lambda a, b: a + b, ["id", "v"], "double"), "o") == [3.0, 7.0]


def test_group_custom_refuses_hot_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", 2.0)], "g string, v double")
    got = aggregate.group_custom(df, "g", {"spread": (lambda x: x.max() - x.min(), "v")})
    assert rows(got) == [("a", 3.0), ("b", 0.0)]
    with pytest.raises(ValueError):
        aggregate.group_custom(df, "g", {"n": (len, "v")}, largest=1)


def test_replace_keeps_unlisted_values(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    assert rows(select.replace_values(df, {"s": {"a": "x", None: "none"}})) == [("b",), ("none",), ("x",)]
    with pytest.raises(Exception, match="not listed"):
        select.replace_values(df, {"s": {"a": 1}}).collect()
    numbers = spark.createDataFrame([("a",), ("7",), (None,)], "s string")
    assert rows(select.replace_values(numbers, {"s": {"a": 1}})) == [(1,), (7,), (None,)]


@pytest.mark.parametrize("limit", [0, 100_000])
def test_position_slice_both_ways(spark, limit, monkeypatch):
    monkeypatch.setattr(select, "TOP_K_ROWS", limit)
    df = spark.range(50).withColumn("x", 50 - F.col("id"))
    assert column(select.iloc_range(df, "x", 3, 7), "x") == [7, 6, 5, 4]


@pytest.mark.parametrize("limit", [0, 100_000])
def test_samples_do_not_depend_on_layout(spark, limit, monkeypatch):
    monkeypatch.setattr(order, "TOP_K_ROWS", limit)
    df = spark.range(200).withColumn("w", F.col("id") + 1.0)
    a = rows(order.sample(df, ["id"], n=30, seed=1))
    assert len(a) == 30 and a == rows(order.sample(df.repartition(7), ["id"], n=30, seed=1))
    assert len(rows(order.sample(df, ["id"], frac=0.25, seed=2))) == 50
    assert len(rows(order.sample(df, ["id"], n=300, replace=True, seed=3))) == 300
    w = rows(order.sample_weighted(df, ["id"], 20, "w", seed=4))
    assert w == rows(order.sample_weighted(df.repartition(3), ["id"], 20, "w", seed=4)) and len(set(w)) == 20


def test_all_null_group_sums_to_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2.0), (None, 5.0)], "g string, v double")
    assert rows(aggregate.na_sum(df, "g", "v")) == [("a", 0.0), ("b", 2.0)]
    assert rows(aggregate.na_prod(df, "g", "v")) == [("a", 1.0), ("b", 2.0)]
    assert rows(aggregate.na_sum(df, "g", "v", min_count=1)) == [("a", None), ("b", 2.0)]


@pytest.mark.parametrize("limit", [0, 1000])
def test_nth_and_head(spark, limit, monkeypatch):
    monkeypatch.setattr(aggregate, "GROUP_LIMIT_ROWS", limit)
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 9), (None, 1)], "g string, x int")
    assert rows(aggregate.group_nth(df, "g", 1, "x")) == [("a", 2)]
    assert rows(aggregate.group_nth(df, "g", 2, "x", head=True)) == [("a", 1), ("a", 2), ("b", 9)]


def test_describe_like_pandas(spark):
    values = [3.0, 1.0, None, 4.0, 1.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = pd.Series(values).describe()
    got = aggregate.describe_numeric(df, ["v"]).first()
    names = {"n": "count", "q25": "25%", "q50": "50%", "q75": "75%"}
    for f in ("n", "mean", "std", "min", "q25", "q50", "q75", "max"):
        assert got[f] == pytest.approx(want[names.get(f, f)])


def test_describe_text_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    assert rows(aggregate.describe_text(df, "s")) == [(4, 2, "a", 2)]


def test_idxmax_ties_take_the_first(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0), (4, None)], "id int, v double")
    assert rows(aggregate.idxmax(df, "v", "id", "id")) == [(2, 7.0)]
    assert rows(aggregate.idxmin(df, "v", "id", "id")) == [(1, 5.0)]


def test_histogram_edges(spark):
    values = [0.0, 1.0, 2.0, 10.0, None, float("nan"), float("-inf")]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 3.0)], "g string, v double")
    got = {(r.g, r.bin): r.n for r in aggregate.histogram(df, F.col("v"), 5, "g").collect()}
    assert got == {("a", 0): 2, ("a", 1): 1, ("a", 4): 1, ("b", 0): 1}
    assert sum(r.n for r in aggregate.histogram(df, F.col("v"), 4).collect()) == 5


def test_group_apply_refuses_hot_groups(spark):
    df = spark.range(40).withColumn("g", F.lit("a"))
    top = lambda p: pd.DataFrame({"g": [p["g"].iloc[0]], "id": [p["id"].max()]})
    with pytest.raises(ValueError):
        aggregate.group_apply(df, "g", top, "g string, id long", largest=10)
    got = aggregate.group_apply(df, "g", top, "g string, id long", merge=top, slice_key="id", slice_rows=10)
    assert rows(got) == [("a", 39)]


def test_entropy_and_judges(spark):
    df = spark.createDataFrame([("x", e, 1.0) for e in "abcd"], "g string, e string, v double")
    assert aggregate.entropy_index(df, "g", "e", F.col("v")).first().entropy == pytest.approx(2.0)
    scores = spark.createDataFrame([("i", s) for s in (1.0, 2.0, 3.0, 9.0)] + [("j", 1.0), ("j", 2.0)], "i string, s double")
    assert rows(aggregate.judge_score(scores, "i", "s"), "i", "score") == [("i", 2.5), ("j", None)]


def test_pivot_refuses_duplicates_and_melt_undoes_it(spark):
    data = [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0)]
    df = spark.createDataFrame(data, "k int, c string, v double")
    wide = reshape.pivot(df, "k", "c", "v")
    assert rows(wide) == [(1, 1.0, 2.0), (2, 3.0, None)]
    assert rows(reshape.stack(wide, ["k"], "c", "v")) == sorted(data, key=str)
    with pytest.raises(ValueError):
        reshape.pivot(df.union(df), "k", "c", "v")


def test_crosstab_shares_add_up(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "x")], "p string, q string")
    shares = reshape.crosstab_share(df, "p", "q", "index").collect()
    assert all(r.x + r.y == pytest.approx(1) for r in shares)
    assert sum(r.x + r.y for r in reshape.crosstab_share(df, "p", "q", "all").collect()) == pytest.approx(1)
    assert rows(reshape.crosstab(df, "p", "q")) == [("a", 1, 1), ("b", 1, 0)]


def test_dummies_and_factorize_with_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "id int, s string")
    assert rows(reshape.dummies(df, "s")) == [(1, 0, 1), (2, 0, 0), (3, 1, 0), (4, 0, 1)]
    coded, table = reshape.factorize(df, "s", "id")
    assert column(coded, "code") == [0, -1, 1, 0]
    assert rows(table) == [("a", 1), ("b", 0)]


@pytest.mark.parametrize("keep", ["first", "last", None])
def test_duplicates_like_pandas(spark, keep):
    data = [(1, "a", None), (2, "a", None), (3, "b", 1), (4, "a", 1), (5, "b", 1)]
    df = spark.createDataFrame(data, "id int, s string, n int")
    p = pd.DataFrame(data, columns=["id", "s", "n"])
    flags = p.duplicated(["s", "n"], keep=keep or False)
    assert column(order.duplicated(df, ["s", "n"], ["id"], keep), "duplicated") == list(flags)
    kept = order.drop_duplicates(df, ["s", "n"], "id", keep)
    assert column(kept, "id") == list(p[~flags]["id"])


def test_reindex_variants(spark):
    df = spark.createDataFrame([(1, 10.0), (3, None), (5, 50.0)], "k long, v double")
    wanted = spark.createDataFrame([(0,), (1,), (4,), (6,)], "k long")
    p = pd.DataFrame({"v": [10.0, np.nan, 50.0]}, index=[1, 3, 5])
    for method in (None, "ffill", "bfill"):
        got = keys.reindex(df, wanted, ["k"], method=method)
        same(column(got, "v", "k"), list(p.reindex([0, 1, 4, 6], method=method)["v"]))
    same(column(keys.reindex(df, wanted, ["k"], fill=0.0), "v", "k"), [0.0, 10.0, 0.0, 0.0])


def test_key_product_counts(spark):
    a = spark.createDataFrame([("x",), ("y",), ("x",)], "a string")
    b = spark.range(3).withColumnRenamed("id", "b")
    assert rows(keys.key_product([a, b])) == [(p, q) for p in "xy" for q in range(3)]


def test_keys_must_identify_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    with pytest.raises(ValueError):
        io.with_keys(df, "k")
    with pytest.raises(ValueError):
        io.with_keys(df.filter("v != 'b'"), "k")


def test_corpus_ids_come_from_file_names(spark, tmp_path):
    (tmp_path / "AB 12.txt").write_text("one\ntwo\n")
    (tmp_path / "CD34.txt").write_text("né")
    assert rows(io.read_corpus(spark, str(tmp_path))) == [("AB 12", "one\ntwo\n"), ("CD34", "né")]


def test_corpus_is_written_as_files_in_few_folders(spark, tmp_path):
    texts = [(f"{i}", f"text {i}\n" * 2) for i in range(60)] + [("a/b", None), ("7", "again"), (None, "no id")]
    path = tmp_path / "corpus"
    io.write_corpus(spark.createDataFrame(texts, "doc_id string, text string"), str(path))
    want = {f"doc_id={i}": f"text {i}\n" * 2 + "\n" for i in range(60)}
    want |= {"doc_id=a%2Fb": "\n", "doc_id=7": "again\ntext 7\ntext 7\n\n", "doc_id=__HIVE_DEFAULT_PARTITION__": "no id\n"}
    assert {f.stem: f.read_text() for f in path.rglob("*.txt")} == want
    assert dict(rows(io.read_corpus(spark, str(path)))) == want
    assert len(list(path.iterdir())) <= 8  # a folder for each task, not for each document
    with pytest.raises(FileExistsError):
        io.write_corpus(spark.createDataFrame(texts, "doc_id string, text string"), str(path))


def test_csv_keeps_quotes_and_separators(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", you', None), (2, "b", 2.5)], "id int, s string, v double")
    io.write_csv(df, str(tmp_path / "out"))
    assert rows(io.read_csv(spark, str(tmp_path / "out"), df.schema)) == rows(df)


def test_convert_types(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "true", "2024-01-31", "x", None), (None, "2", "FALSE", "2024-02-29", "1", None)],
        "a string, b string, c string, d string, e string, f string",
    )
    kinds = {f.name: f.dataType.simpleString() for f in missing.convert_types(df).schema}
    assert kinds == {"a": "bigint", "b": "double", "c": "boolean", "d": "date", "e": "string", "f": "string"}


def test_dropna_then_report_shows_none(gaps):
    report = missing.null_report(missing.dropna(gaps)).collect()
    assert all(r.nulls == 0 for r in report)
    assert missing.drop_null_columns(gaps, 0.5).columns == ["id", "g"]


def test_repair_text():
    assert repair_text("donâ€™t stop cafÃ©") == "don't stop cafe"
    assert repair_text("\x93quoted\x94 – “fine”") == '"quoted" - "fine"'
    assert repair_text("plain ASCII") == "plain ASCII"
    assert repair_text("naïve Ã") == "naive A"  # a lone lead byte is left alone
    assert repair_text("1 2") == "1 2"


def test_repair_leaves_null_and_ascii(spark):
    df = spark.createDataFrame([(1, None), (2, "abc"), (3, "é")], "id int, t string")
    assert column(text.repair_corpus(df, "t"), "t") == [None, "abc", "e"]


def test_normalise_message(spark):
    df = spark.createDataFrame([(1, " 【通知】 你好 ， 世界！ ")], "id int, t string")
    assert column(text.normalise_message(df, "t"), "t") == ["【通知】你好,世界!"]


def test_text_null_rules(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "c")], "id int, x string, y string")
    assert column(text.cat(df, ["x", "y"], "z", "-"), "z") == [None, "b-c"]
    assert column(text.cat(df, ["x", "y"], "z", "-", na_rep="?"), "z") == ["a-?", "b-c"]
    assert column(text.contains(df, "y", "c", "z"), "z") == [None, True]
    assert column(text.contains(df, "y", "c", "z", na=False), "z") == [False, True]


def test_category_rules(spark):
    df = spark.createDataFrame([(1, "lo", "hi"), (2, "hi", "lo"), (3, "??", "lo"), (4, None, "hi")], "id int, a string, b string")
    levels = category.Categories(("lo", "mid", "hi"), ordered=True)
    assert column(category.to_category(df, "a", levels), "a") == ["lo", "hi", None, None]
    assert column(category.compare_category(df, "a", ">=", "mid", levels, "r"), "r") == [False, True, False, False]
    assert column(category.compare_categories(df, "a", "b", "!=", levels, levels, "r"), "r") == [True] * 4
    with pytest.raises(TypeError):
        category.compare_categories(df, "a", "b", "<", levels, levels.add("top"), "r")
    with pytest.raises(TypeError):
        category.compare_category(df, "a", "<", "mid", category.Categories(("lo", "mid")), "r")
    assert rows(category.category_info(df, "a", levels)) == [("hi", 2, 1), ("lo", 0, 1), ("mid", 1, 0)]
    assert category.drop_unused(df, "a", levels)[1].values == ("lo", "hi")


def test_cut_like_pandas(spark):
    values = [0.0, 1.0, 5.0, 10.0, 11.0]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    for right in (True, False):
        want = pd.cut(pd.Series(values), [0, 5, 10], labels=["a", "b"], right=right).astype(object)
        same(column(category.cut(df, "v", [0, 5, 10], "c", ["a", "b"], right), "c"), [None if pd.isna(w) else w for w in want])


@pytest.mark.parametrize("n", [-7, -5, -2, -1, 0, 1, 3, 5, 12])
def test_business_days_like_pandas(spark, n):
    days = [dt.datetime(2024, 2, 1, 13, 30) + dt.timedelta(days=i) for i in range(14)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, d timestamp_ntz")
    got = column(timeseries.add_offset(df, "d", "business_days", n, "out"), "out")
    assert got == [(pd.Timestamp(d) + pd.offsets.BDay(n)).to_pydatetime() for d in days]


@pytest.mark.parametrize("n", [-2, -1, 1, 2])
def test_month_offsets_like_pandas(spark, n):
    days = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 31), dt.datetime(2023, 2, 28, 5)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, d timestamp_ntz")
    offsets = {
        "month_end": pd.offsets.MonthEnd(n),
        "month_start": pd.offsets.MonthBegin(n),
        "months": pd.DateOffset(months=n),
    }
    for name, step in offsets.items():
        got = column(timeseries.add_offset(df, "d", name, n, "out"), "out")
        assert got == [(pd.Timestamp(d) + step).to_pydatetime() for d in days]


@pytest.mark.parametrize("freq,alias", [("D", "D"), ("B", "B"), ("M", "ME"), ("MS", "MS"), ("W", "W"), ("Q", "QE"), ("6h", "6h")])
def test_date_range_like_pandas(spark, freq, alias):
    got = column(timeseries.date_range(spark, "2023-11-29", "2024-03-02", freq), "ts", "ts")
    assert got == list(pd.date_range("2023-11-29", "2024-03-02", freq=alias).to_pydatetime())


def test_partial_dates():
    assert timeseries.period_bounds("2023-12") == (dt.datetime(2023, 12, 1), dt.datetime(2024, 1, 1))
    assert timeseries.period_bounds("2024") == (dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1))
    assert timeseries.period_bounds("2024-02-29 23") == (dt.datetime(2024, 2, 29, 23), dt.datetime(2024, 3, 1))


def test_resample_lists_empty_buckets(spark):
    at = [dt.datetime(2024, 1, 1, 0, 5), dt.datetime(2024, 1, 1, 3, 10), dt.datetime(2024, 1, 1, 3, 20)]
    df = spark.createDataFrame(list(zip(at, [1.0, 2.0, 4.0])), "ts timestamp_ntz, v double")
    out = timeseries.resample(df, "ts", "h", {"s": ("sum", "v"), "m": ("mean", "v"), "n": ("count", "v")})
    got = [tuple(r) for r in out.orderBy("bucket").collect()]
    assert [r[0].hour for r in got] == [0, 1, 2, 3]
    assert [r[1:] for r in got] == [(1.0, 1.0, 1), (0.0, None, 0), (0.0, None, 0), (6.0, 3.0, 2)]


def test_to_datetime_errors(spark):
    df = spark.createDataFrame([("01/02/2024",), ("nonsense",)], "s string")
    out = timeseries.to_datetime(df, "s", "dd/MM/yyyy", "t", errors="coerce")
    assert rows(out, "t") == [(None,), (dt.datetime(2024, 2, 1),)]
    with pytest.raises(Exception):
        timeseries.to_datetime(df, "s", "dd/MM/yyyy", "t").collect()


@pytest.mark.parametrize("center", [False, True])
@pytest.mark.parametrize("n,least", [(3, None), (4, 1), (5, 2)])
def test_rolling_like_pandas(gaps, n, least, center):
    roll = SERIES.rolling(n, min_periods=least, center=center)
    got = rolling.rolling_rows(gaps, "g", "id", "v", n, {"a": "sum", "b": "max"}, least, center)
    same(column(got, "a"), list(roll.sum()))
    same(column(got, "b"), list(roll.max()))


def test_rolling_correlation_of_constants_is_null(spark):
    df = spark.createDataFrame([(i, "a", 1.0, float(i)) for i in range(4)], "id int, g string, x double, y double")
    out = rolling.rolling_cov_corr(df, "g", "id", "x", "y", 3)
    assert column(out, "cov")[2:] == [0.0, 0.0] and column(out, "corr") == [None] * 4


def test_group_split_and_folds(spark):
    df = spark.range(300).withColumn("g", F.when(F.col("id") < 100, 0).otherwise(F.col("id") % 23))
    got = split.group_split(df, "g", 0.2).groupBy("g").agg(F.collect_set("split").alias("s")).collect()
    assert all(len(r.s) == 1 for r in got)
    assert sum(r.s == ["valid"] for r in got) == int(len(got) * 0.2)
    folds = split.group_kfold(df, "g", 4)
    assert folds.count() == 300
    assert folds.groupBy("g").agg(F.count_distinct("fold").alias("n")).filter("n > 1").isEmpty()
    assert {r.fold for r in folds.select("fold").distinct().collect()} == {0, 1, 2, 3}


@pytest.mark.parametrize("side", ["right", "left"])
def test_padding(spark, side):
    df = spark.createDataFrame([(1, 0, [1, 2]), (2, 0, [3]), (3, 1, [4])], "id int, b int, a array<int>")
    out = split.pad_sequences(df, "a", "b", 0, side)
    short = ([3, 0], [1, 0]) if side == "right" else ([0, 3], [0, 1])
    assert [(r.a, r.attention_mask) for r in out.orderBy("id").collect()] == [([1, 2], [1, 1]), short, ([4], [1])]


def test_softmax_survives_large_scores(spark):
    df = spark.createDataFrame([(1000.0, 1000.0, -1000.0)], "a double, b double, c double")
    assert metrics.softmax(df, ["a", "b", "c"]).first()[:3] == pytest.approx((0.5, 0.5, 0.0))


def test_log_loss_clips(spark):
    preds = spark.createDataFrame([(1, 1.0, 0.0), (2, 0.25, 0.75)], "id int, a double, b double")
    labels = spark.createDataFrame([(1, 1), (2, 1)], "id int, y int")
    got = metrics.log_loss(preds, labels, "id", ["a", "b"], "y").first()
    assert got.log_loss == pytest.approx((-math.log(1e-15) - math.log(0.75)) / 2)


def test_balanced_ce_by_hand(spark):
    p, t = [0.9, 0.0, 0.3], [1, 1, 0]
    df = spark.createDataFrame([(7, float(a), float(b)) for a, b in zip(t, p)], "id int, t double, p double")
    beta = 1 - 2 / 3
    want = -(beta * (math.log(0.9) - 100) + (1 - beta) * math.log(0.7))
    assert metrics.balanced_ce(df, "id", "t", "p").first().loss == pytest.approx(want)


def test_blend_takes_the_closest_pair(spark):
    def model(*scores):
        return spark.createDataFrame([(1, list(scores))], "id int, s array<double>")

    a, b, c = model(0.0, 0.0), model(5.0, 5.0), model(1.0, 1.0)
    got = metrics.blend_nearest_pair([a, b, c], "id", "s").first()
    assert (got.pair, got.s) == (2, [0.5, 0.5])
    assert metrics.blend_nearest_pair([a, a, a], "id", "s").first().pair == 0


@pytest.mark.parametrize("wide", [256, 1])
def test_pooling_both_ways(spark, wide, monkeypatch):
    monkeypatch.setattr(metrics, "WIDE_DIMENSIONS", wide)
    df = spark.createDataFrame([("a", [1.0, 2.0], 1), ("a", [3.0, 6.0], 1), ("a", [9.0, 9.0], 0), ("b", [1.0, 1.0], 0)], "k string, v array<double>, m int")
    got = {r.k: r.pooled for r in metrics.masked_mean_pool(df, "k", "v", F.col("m"), 2).collect()}
    assert got == {"a": [2.0, 4.0], "b": [0.0, 0.0]}


def test_models_learn_a_simple_rule(spark):
    df = spark.range(200).select(
        "id",
        F.array(F.col("id") / 200, F.lit(1.0)).alias("x"),
        F.when(F.col("id") % 10 != 9, F.col("id").cast("double")).alias("f"),
        (F.col("id") >= 100).cast("double").alias("y"),
    )
    linear = models.linear_head(df, "id", "x", "y")
    assert linear.filter("prediction = y").count() > 190
    trees = models.boosted_trees(df, "id", ["f"], "y", rounds=3)
    assert trees.filter("prediction = y").count() > 180


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, g string, ts timestamp_ntz, v double")
    assert missing.fill_forward(df, "g", "id", "v").count() == 0
    assert rolling.expanding(df, None, "id", "v", {"s": "sum"}).count() == 0
    assert timeseries.resample(df, "ts", "h", {"s": ("sum", "v")}).count() == 0
    assert split.group_split(df, "g", 0.5).count() == 0
    assert aggregate.group_agg(df, "g", {"v": ["sum", "median"]}).count() == 0


def test_rows_without_group_stay(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), (None, 4)], "g string, v int")
    for got in (split.group_split(df, "g", 0.5), split.group_kfold(df, "g", 2)):
        assert got.count() == 4 and {r[2] for r in got.collect() if r.g is None} == {None}


def test_log_loss_needs_every_prediction(spark):
    preds = spark.createDataFrame([(1, 0.2, 0.8)], "id int, p0 double, p1 double")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "id int, y int")
    assert metrics.log_loss(preds, labels.limit(1), "id", ["p0", "p1"], "y").first().n == 1
    with pytest.raises(Exception, match="no prediction for 2"):
        metrics.log_loss(preds, labels, "id", ["p0", "p1"], "y").collect()


@pytest.mark.parametrize("dim", [64, 300])
def test_pooling_never_cuts_vectors(spark, dim):
    df = spark.createDataFrame([("a", [1.0] * (dim + 6), 1)], "k string, v array<double>, m int")
    with pytest.raises(Exception, match="more than"):
        metrics.masked_mean_pool(df, "k", "v", F.col("m"), dim).collect()


def test_leading_zeros_are_no_numbers(spark):
    df = spark.createDataFrame([("007", "0", "0.5", "00.5"), ("12", "-3", "10", "1")], "a string, b string, c string, d string")
    assert missing.narrowest_types(df) == {"b": "bigint", "c": "double"}


def test_repair_keeps_other_scripts():
    assert repair_text("Привет мир, 你好 abc, café – naïve") == "Привет мир, 你好 abc, cafe - naive"


def test_csv_with_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'two\nlines, "quoted"'), (2, "one")], "id int, s string")
    io.write_csv(df, str(tmp_path / "x"))
    assert rows(io.read_csv(spark, str(tmp_path / "x"), df.schema, line_breaks=True)) == rows(df)


def test_open_and_timed_intervals(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (float("inf"),)], "x double")
    spans = spark.createDataFrame([("low", None, 2.0), ("mid", 1.0, 5.0), ("high", 4.0, float("inf")), ("all", None, None)], "n string, lo double, hi double")
    got = rows(joins.interval_lookup(df.filter("x < 9"), spans, "x").select("n", "x"))
    assert got == [("all", 1.0), ("all", 5.0), ("high", 5.0), ("low", 1.0), ("mid", 5.0)]
    day = spark.createDataFrame([(dt.date(2020, 1, 5),), (dt.date(2021, 1, 5),)], "x date")
    years = spark.createDataFrame([("20", dt.date(2020, 1, 1), dt.date(2020, 12, 31)), ("on", dt.date(2020, 6, 1), None)], "n string, lo date, hi date")
    assert rows(joins.interval_lookup(day, years, "x").select("n", "x")) == [("20", dt.date(2020, 1, 5)), ("on", dt.date(2021, 1, 5))]


def test_extremes_of_times_and_text(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "z", 2), ("a", "z", 3), ("b", None, 4)], "g string, s string, id int")
    assert rows(aggregate.idxmax(df, "s", "id", "id", by="g")) == [("a", 2, "z"), ("b", None, None)]
    assert rows(aggregate.idxmin(df, "s", "id", "id")) == [(1, "x")]


def test_median_of_the_whole_table_with_other_statistics(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (6.0,)], "v double")
    assert aggregate.group_agg(df, None, {"v": ["sum", "median"]}).first().asDict() == {"v_sum": 9.0, "v_median": 2.0}


@pytest.mark.parametrize("limit", [0, 100_000])
def test_ends_of_the_order_both_ways(spark, limit, monkeypatch):
    monkeypatch.setattr(order, "TOP_K_ROWS", limit)
    df = spark.range(50).withColumn("x", 50 - F.col("id"))
    assert sorted(r.x for r in order.head(df, 20, "x").collect()) == list(range(1, 21))
    assert sorted(r.x for r in order.tail(df, 20, "x").collect()) == list(range(31, 51))
    assert sorted(r.x for r in order.nlargest(df, 3, "x").collect()) == [48, 49, 50]


@pytest.mark.parametrize("closed", ["left", "right", "both", "neither"])
@pytest.mark.parametrize("ranges", [1, 7])
def test_intervals_by_hand_over_several_ranges(spark, closed, ranges, tiny_segments):
    import random

    rng = random.Random(3)
    inf = float("inf")
    values = [rng.choice([0.0, 1.5, 7.0, rng.uniform(-50, 50), 1e9, -1e12]) for _ in range(150)] + [None, inf]
    bound = lambda: rng.choice([None, -inf, inf, 0.0, 1.5, 7.0, rng.uniform(-60, 60), 1e9, 2e9, -1e12])
    bands = [(i, bound(), bound()) for i in range(60)] + [(60, None, None), (61, 7.0, 7.0), (62, 60.0, 1e8), (61, 7.0, 7.0)]
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(ranges == 1).lower())
    rows = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    intervals = spark.createDataFrame(bands, "band int, lo double, hi double")

    def holds(v, lo, hi):
        lo, hi = (None if x is None or abs(x) == inf else x for x in (lo, hi))
        if v is None or v == inf:
            return False
        above = lo is None or v > lo or v == lo and closed in ("left", "both")
        return above and (hi is None or v < hi or v == hi and closed in ("right", "both"))

    want = sorted((i, b) for i, v in enumerate(values) for b, lo, hi in bands if holds(v, lo, hi))
    got = joins.interval_lookup(rows, intervals, "v", closed=closed)
    assert got.columns == ["id", "v", "band", "lo", "hi"]
    assert sorted((r.id, r.band) for r in got.collect()) == want
    counts = joins.interval_counts(rows, intervals, "v", closed=closed).collect()
    assert sorted((r.band, r.n) for r in counts) == sorted((b, sum(holds(v, lo, hi) for v in values)) for b, lo, hi in bands)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert joins.interval_lookup(rows.filter("id < 0"), intervals, "v").count() == 0
    assert {r.n for r in joins.interval_counts(rows.filter("id < 0"), intervals, "v").collect()} == {0}


def test_extract_tells_empty_from_missing_groups(spark):
    df = spark.createDataFrame([("b",), ("ab",), ("xxb ab",), ("z",), (None,), ("aab",), ("c",)], "t string")
    got = [(r.t, r.one, r.two) for r in text.extract(df, "t", r"(a?)b|(?i:(C))", ["one", "two"]).collect()]
    assert got == [("b", "", None), ("ab", "a", None), ("xxb ab", "", None), ("z", None, None), (None, None, None), ("aab", "a", None), ("c", None, "c")]


def test_buckets_count_from_the_first_day_like_pandas(spark):
    times = pd.to_datetime(["2024-01-02 03:10", "2024-01-02 09:00", "2024-01-05 23:59", "2024-01-06 00:00"])
    frame = pd.DataFrame({"ts": times, "g": ["a", "a", "b", "b"], "v": [1.0, 2.0, 3.0, 4.0]})
    df = spark.createDataFrame([(str(t), g, v) for t, g, v in zip(times, frame.g, frame.v)], "s string, g string, v double")
    df = df.select(F.col("s").cast("timestamp_ntz").alias("ts"), "g", "v")
    for freq in ("7h", "2D", "5h", "6h", "50min"):
        for origin in ("start_day", "start", "epoch"):
            got = timeseries.resample(df, "ts", freq, {"v": ("sum", "v")}, origin=origin).orderBy("bucket").collect()
            want = frame.set_index("ts")["v"].resample(freq, origin=origin).sum()
            assert [(r.bucket, r.v) for r in got] == [(t.to_pydatetime(), v) for t, v in want.items()]
        got = timeseries.resample(df, "ts", freq, {"v": ("sum", "v")}, by="g").orderBy("g", "bucket").collect()
        for g, part in frame.groupby("g"):
            want = part.set_index("ts")["v"].resample(freq).sum()
            assert [(r.bucket, r.v) for r in got if r.g == g] == [(t.to_pydatetime(), v) for t, v in want.items()]
    given = timeseries.resample(df, "ts", "7h", {"v": ("count", "v")}, origin="2024-01-02T01:00:00").agg(F.min("bucket")).first()[0]
    assert str(given) == "2024-01-02 01:00:00"


@pytest.mark.parametrize("hot_rows", [0, 3, 1_000_000])  # only hot keys, some, none
@pytest.mark.parametrize("how", ["left", "right", "outer"])
@pytest.mark.parametrize("nulls_match", [False, True])
def test_outer_joins_with_hot_keys(spark, how, hot_rows, nulls_match, monkeypatch):
    monkeypatch.setattr(joins, "HOT_JOIN_ROWS", hot_rows)
    a = [(k, i) for i, k in enumerate([1, 1, 1, 1, 1, 2, 3, None, None, None, None, 9, 0])]
    b = [(k, i) for i, k in enumerate([1, 1, 2, 4, 4, 4, 4, None, None, 0])]
    left, right = spark.createDataFrame(a, "k long, x int"), spark.createDataFrame(b, "k long, y int")
    same = lambda p, q: p == q if p is not None and q is not None else nulls_match and p is q
    want = [(k, x, y, "both") for k, x in a for j, y in b if same(k, j)]
    if how != "right":
        want += [(k, x, None, "left_only") for k, x in a if not any(same(k, j) for j, _ in b)]
    if how != "left":
        want += [(k, None, y, "right_only") for k, y in b if not any(same(k, j) for j, _ in a)]
    got = joins.merge(left, right, "k", how, indicator="side", nulls_match=nulls_match)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    other = joins.merge(left, right.withColumn("k", F.col("k").cast("double")), "k", how, nulls_match=nulls_match)
    assert sorted((r.x, r.y) for r in other.fillna(-1).collect()) == sorted((-1 if x is None else x, -1 if y is None else y) for _, x, y, _ in want)


def test_zeros_of_either_sign_are_one_hot_key(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_JOIN_ROWS", 1)
    left = spark.createDataFrame([(0.0, 1), (-0.0, 2), (1.0, 3)], "k double, x int")
    right = spark.createDataFrame([(-0.0, 1), (0.0, 2), (0.0, 3)], "k double, y int")
    assert joins.merge(left, right, "k", "outer").count() == 7


def test_outer_join_without_hot_keys_reads_each_table_once(spark):
    plan = joins.merge(spark.range(50), spark.range(20, 90), "id", "outer", indicator="side")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 2 and plan.count("Join FullOuter") == 1


# ---------------------------------------------------------------- own aggregates in parts, sparse pivots


def _mean_in_parts():
    return aggregate.Mergeable(
        update=lambda v: {"n": len(v), "total": float(v.sum())},
        merge=lambda s: {"n": int(s["n"].sum()), "total": float(s["total"].sum())},
        finish=lambda s: s["total"] / s["n"] if s["n"] else None,
        state="n long, total double",
    )


def test_group_custom_in_parts_takes_any_group(spark, monkeypatch):
    from quillframe.operators import mergeable

    monkeypatch.setattr(mergeable, "FAN_IN", 3)  # several rounds of merging
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        df = spark.range(3000).select(
            F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "cold").alias("g"),
            F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("v"),
        )
        df = df.unionByName(spark.createDataFrame([("none", None)], "g string, v double"))
        got = {r["g"]: r["m"] for r in aggregate.group_custom(df, "g", {"m": (_mean_in_parts(), "v")}, largest=1).collect()}
        want = {r["g"]: r["m"] for r in df.filter("g IS NOT NULL").groupBy("g").agg(F.avg("v").alias("m")).collect()}
        assert set(got) == {"hot", "cold", "none"} and got["none"] is None
        assert all(abs(got[g] - want[g]) < 1e-9 for g in ("hot", "cold"))
        whole = aggregate.group_custom(df, [], {"m": (_mean_in_parts(), "v")}).first()["m"]
        assert abs(whole - df.agg(F.avg("v")).first()[0]) < 1e-9
        assert aggregate.group_custom(df.limit(0), "g", {"m": (_mean_in_parts(), "v")}).count() == 0
        assert aggregate.group_custom(df.limit(0), [], {"m": (_mean_in_parts(), "v")}).count() == 0
        with pytest.raises(ValueError):
            aggregate.group_custom(df, "g", {"m": (_mean_in_parts(), "v"), "n": (len, "v")})
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_group_apply_merges_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(aggregate, "FAN_IN", 2)
    df = spark.range(200).select(F.lit("a").alias("g"), "id")
    top = lambda pdf: pdf.nlargest(3, "id")[["g", "id"]]
    got = aggregate.group_apply(df, "g", top, "g string, id long", merge=top, slice_key="id", slice_rows=10)
    assert sorted(r["id"] for r in got.collect()) == [197, 198, 199]


def test_pivot_sparse_has_no_bound_on_columns(spark):
    from quillframe.operators import reshape

    df = spark.range(20_500).select((F.col("id") % 2).alias("i"), F.col("id").alias("c"), F.col("id").alias("v"))
    with pytest.raises(ValueError):
        reshape.pivot_table(df, "i", "c", "v")
    got = {r["i"]: r for r in reshape.pivot_sparse(df, "i", "c", "v", "sum").collect()}
    assert len(got[0]["labels"]) == len(got[1]["labels"]) == 10_250
    assert got[1]["labels"] == got[1]["cells"] == list(range(1, 20_500, 2))
    blocks = reshape.pivot_sparse(df, "i", "c", "v", "sum", block=7).collect()
    assert len(blocks) == 14 and sorted(x for r in blocks for x in r["labels"]) == list(range(20_500))
    rows = spark.createDataFrame([(1, "a", 2), (1, "a", 3), (1, "b", None), (1, None, 9), (None, "a", 9), (2, "b", 4)], "i int, c string, v int")
    sparse = reshape.pivot_sparse(rows, "i", "c", "v", "sum")
    assert {(r["i"], *r["labels"], *r["cells"]) for r in sparse.collect()} == {(1, "a", "b", 5, None), (2, "b", 4)}
    wide = reshape.sparse_columns(sparse, ["b", "z"], fill_value=0).collect()
    assert {tuple(r) for r in wide} == {(1, 0, 0), (2, 4, 0)}


def test_wide_intervals_are_dealt_out_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(joins, "PAIRS_PER_TASK", 500)
    monkeypatch.setattr(joins, "LEAST_BLOCK", 16)
    monkeypatch.setattr(joins, "LARGEST_BLOCK", 16)
    values = [(i, None if i % 50 == 7 else float(i // 3)) for i in range(300)]
    spans = [(k, None if k % 3 == 0 else float(k), None if k % 3 == 1 else 60.0 + k) for k in range(80)] + [(80, 5.0, 4.0)]
    df = spark.createDataFrame(values, "id int, v double")
    bands = spark.createDataFrame(spans, "k int, lo double, hi double")
    got = joins.interval_lookup(df, bands, "v", closed="left")
    want = [(i, k) for i, v in values for k, lo, hi in spans if v is not None and (lo is None or v >= lo) and (hi is None or v < hi)]
    assert rows(got, "id", "k") == sorted(want, key=str)
    shares = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(shares) < len(want) / 5


def test_quantiles_of_spans_send_only_numbers_to_the_tasks(spark):
    day = dt.datetime(2024, 1, 1)
    data = [(i, "ab"[i % 2], None if i % 17 == 0 else day + dt.timedelta(hours=i // 3), None if i % 5 == 0 else float(i * 7 % 23), "x" * 50) for i in range(120)]
    df = spark.createDataFrame(data, "id int, k string, ts timestamp_ntz, v double, note string")
    got = rolling.rolling_time(df, "k", "ts", 6 * 3_600_000_000, "v", {"v": "median", "high": 0.9})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    sent = plan[plan.index("FlatMapGroupsInArrow") :].split("LogicalRDD")[0]
    assert "Project" in sent and "note#" not in sent and got.columns == ["id", "k", "ts", "note", "v", "high"]
    found = {r["id"]: (r["v"], r["high"]) for r in got.collect()}
    assert len(found) == len(data)
    for i, k, ts, _, _ in data:
        span = dt.timedelta(hours=6)
        frame = [v for _, k2, t, v, _ in data if k2 == k and v is not None and (t is ts if ts is None or t is None else ts - span < t <= ts)]
        assert found[i] == (pytest.approx(tuple(np.quantile(frame, [0.5, 0.9]))) if frame else (None, None))


def test_small_groups_are_dealt_out_to_tasks_of_few_rows(spark, monkeypatch):
    from quillframe.plans import groups

    monkeypatch.setattr(groups, "TASK_ROWS", 100)
    df = spark.range(4000).select("id", (F.col("id") % 200).alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    got = rolling.rolling_rows(df, "k", "id", "v", 40, {"top": "max"}, min_periods=1)
    shares = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(shares) == 4000 and max(shares) <= 400


def test_corpus_is_listed_by_tasks_as_spark_would_read_it(spark, tmp_path):
    import bz2
    import gzip

    names = {"a b+c.txt": b"one\r\n", "100%41 #;[x].txt": "né".encode(), "bytes": b"\xff\xfe", "sub/deep/d.txt": b"d", "_k=1.txt": b"k", "_metadata/m.txt": b"m"}
    passed_over = {"empty.txt": b"", "_tmp.txt": b"x", ".dot": b"x", "x._COPYING_": b"x", ".git/x.txt": b"x", "sub/_tmp/x.txt": b"x"}
    packed = {"p.txt.gz": gzip.compress(b"one ") + gzip.compress(b"two"), "q.txt.BZ2": bz2.compress(b"three"), "sub.gz/plain": b"plain"}
    for name, content in (names | passed_over | packed).items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    for pattern in (r"([^/]*?)(?:\.[^./]*)?$", "(.*)"):
        got = io.read_corpus(spark, str(tmp_path), id_pattern=pattern)
        assert got.inputFiles() == []  # the driver has no list of the files
        assert got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > 1 << 40  # no plan takes the texts for small
        theirs = spark.read.option("recursiveFileLookup", True).text(str(tmp_path), wholetext=True)
        theirs = theirs.select(F.regexp_extract(F.url_decode("_metadata.file_path"), pattern, 1).alias("doc_id"), F.col("value").alias("text"))
        assert got.schema == theirs.schema
        assert rows(got.withColumn("text", F.hex("text"))) == rows(theirs.withColumn("text", F.hex("text")))
        assert got.count() == len(names) + len(packed)
    (tmp_path / "none").mkdir()
    assert io.read_corpus(spark, str(tmp_path / "none")).count() == 0
    assert rows(io.read_corpus(spark, str(tmp_path / "sub/d*"))) == [("d", "d")]


@pytest.mark.parametrize("most", [100, 2])
def test_only_texts_that_share_an_id_are_brought_together(spark, tmp_path, monkeypatch, most):
    from quillframe.sources import corpus

    monkeypatch.setattr(corpus, "REPEATED_IDS", most)
    texts = [(f"{i}", f"{i:06d}" * 2_000) for i in range(200)] + [("7", "b"), ("9", "a"), (None, "y"), ("", "x"), (None, "w")]
    df, sent = spark.createDataFrame(texts, "doc_id string, text string").repartition(3), []
    repartition = type(df).repartition
    monkeypatch.setattr(type(df), "repartition", lambda df, *by: sent.append(df.count()) or repartition(df, *by))
    io.write_corpus(df, str(tmp_path / "c"))
    assert sent == [7 if most == 100 else 205]
    want = {f"doc_id={i}": f"{i:06d}" * 2_000 + "\n" for i in range(200)} | {"doc_id=__HIVE_DEFAULT_PARTITION__": "w\ny\nx\n"}
    want |= {"doc_id=7": want["doc_id=7"] + "b\n", "doc_id=9": want["doc_id=9"] + "a\n"}
    assert rows(io.read_corpus(spark, str(tmp_path / "c"))) == sorted(want.items(), key=str)
