"""The split layout (hot groups) gives the same rows as plain windows."""

import random

import pytest
from pyspark.sql import functions as F

from quillframe.operators import aggregate, keys, missing, rolling, text, timeseries
from quillframe.plans import groups
from quillframe.plans.ordering import with_group_position, with_position
from quillframe.plans.quantiles import group_quantiles


@pytest.fixture(scope="module")
def rows(spark):
    # Small shuffles would be merged into one partition; keep several, as on large data.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield _rows(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def _rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(90):
        group = "hot" if rng.random() < 0.6 else rng.choice("abc")
        value = None if rng.random() < 0.4 else round(rng.uniform(-50, 50), 2)
        data.append((i, group, 1_000_000 * rng.randrange(0, 60), value, rng.randrange(5)))
    df = spark.createDataFrame(data, "id long, g string, us long, v double, w int")
    epoch = F.lit("2024-01-01").cast("timestamp_ntz")
    return df.withColumn("ts", epoch + F.make_interval(secs=F.col("us") / 1_000_000)).repartition(5)


def result(df, places=6):
    def plain(v):
        return round(v, places) + 0.0 if isinstance(v, float) else v

    names = sorted(df.columns)
    return sorted((tuple(plain(v) for v in r) for r in df.select(*names).collect()), key=str)


ORDER = ["ts", "id"]

OPERATIONS = {
    "position": lambda d: with_group_position(d, "g", [("v", "desc"), "id"], "p"),
    "fill_forward": lambda d: missing.fill_forward(d, "g", ORDER, "v"),
    "fill_forward_limit": lambda d: missing.fill_forward(d, "g", ORDER, "v", limit=2),
    "fill_backward_limit": lambda d: missing.fill_backward(d, "g", ORDER, "v", limit=1),
    "linear": lambda d: missing.interpolate_linear(d, "g", ORDER, "v"),
    "time": lambda d: missing.interpolate_time(d, "g", ORDER, "v"),
    "nearest": lambda d: missing.interpolate_nearest(d, "g", ORDER, "v"),
    "both": lambda d: missing.interpolate(d, "g", ORDER, "v", limit=1, limit_direction="both"),
    "rolling": lambda d: rolling.rolling_rows(d, "g", ORDER, "v", 5, {"m": "mean", "s": "std"}, 2),
    "rolling_long": lambda d: rolling.rolling_rows(d, "g", ORDER, "v", 11, {"m": "sum", "n": "count"}, 1),
    "centred": lambda d: rolling.rolling_rows(d, "g", ORDER, "v", 6, {"m": "max", "k": "median"}, 1, True),
    "apply": lambda d: rolling.rolling_apply(d, "g", ORDER, "w", 4, F.array_max, "m"),
    "cov": lambda d: rolling.rolling_cov_corr(d, "g", ORDER, "v", "w", 7, 2),
    "expanding": lambda d: rolling.expanding(
        d, "g", ORDER, "v", {"s": "sum", "m": "mean", "lo": "min", "hi": "max", "n": "count"}
    ),
    "rolling_time": lambda d: rolling.rolling_time(
        d, "g", "ts", 7_000_000, "v", {"s": "sum", "m": "mean", "lo": "min", "hi": "max", "n": "count", "d": "std"}
    ),
    "rolling_time_long": lambda d: rolling.rolling_time(d, "g", "ts", 33_000_000, "v", {"s": "sum", "q": "var"}, 2),
    "rolling_long_spread": lambda d: rolling.rolling_rows(d, "g", ORDER, "v", 40, {"m": "mean", "d": "std", "lo": "min", "hi": "max", "t": ("sum", "w")}, 1),
    "centred_long": lambda d: rolling.rolling_rows(d, "g", ORDER, "v", 36, {"m": "mean", "q": 0.3, "n": "count", "e": ("var", "w")}, 1, True),
    "rolling_cov_long": lambda d: rolling.rolling_cov_corr(d, "g", ORDER, "v", "w", 37, 3),
    "time_quantiles": lambda d: rolling.rolling_time(d, "g", "ts", 9_000_000, "v", {"m": "median", "q": 0.9, "w9": (0.25, "w"), "s": ("sum", "w")}),
    "time_no_time": lambda d: rolling.rolling_time(d.withColumn("ts", F.when(F.col("id") % 4 > 0, F.col("ts"))), "g", "ts", 20_000_000, "v", {"m": "median", "d": "std", "s": ("sum", "w")}),
    "rolling_moment": lambda d: rolling.rolling_time(d, "g", "ts", 1, "v", {"s": "sum", "n": "count"}),
    "rolling_instant": lambda d: rolling.rolling_time(d, "g", "ts", 5, "v", {"s": "sum"}),
    "quantiles": lambda d: group_quantiles(d, "g", "v", [0, 0.25, 0.5, 0.9, 1]),
    "quantiles_all": lambda d: group_quantiles(d, None, "w", [0.25, 0.5, 0.99]),
    "nth": lambda d: aggregate.group_nth(d, "g", 4, ORDER),
    "median": lambda d: aggregate.group_agg(d, "g", {"v": ["median", "sum", "first"]}, ORDER),
    "upsample": lambda d: timeseries.resample_upsample(
        d.groupBy("g", "ts").agg(F.max("v").alias("v")), "ts", "2s", "v", "linear", by="g"
    ),
    "pieces": lambda d: text.cat_all(d, "g", "w", "-", "id", piece_rows=4),
}


@pytest.mark.parametrize("largest", [0, 20])  # every group is hot, or only the one of 50 rows
@pytest.mark.parametrize("name", sorted(OPERATIONS))
def test_split_equals_plain(rows, name, largest, monkeypatch):
    expected = result(OPERATIONS[name](rows))
    monkeypatch.setattr(groups, "LARGEST_PLAIN_GROUP", largest)
    monkeypatch.setattr(groups, "SEGMENT_ROWS", 3)
    monkeypatch.setattr(aggregate, "GROUP_LIMIT_ROWS", 0)
    assert result(OPERATIONS[name](rows)) == expected


@pytest.mark.parametrize("kind", ["long", "decimal(20,2)", "double"])
@pytest.mark.parametrize("by", ["g", None])
def test_long_frames_keep_types_and_values(spark, kind, by, monkeypatch):
    """One huge value far from a frame of ones changes nothing, at either side of a segment's edge."""
    monkeypatch.setattr(groups, "SEGMENT_ROWS", 50)
    df = spark.range(400).select("id", F.lit("a").alias("g"), F.when(F.col("id") == 0, 10**16).otherwise(1).cast(kind).alias("v"))
    for n in (50, 200):
        got = rolling.rolling_rows(df, by, "id", "v", n, {"s": "sum", "m": "median", "d": "var"})
        assert got.schema["s"].dataType == df.agg(F.sum("v").alias("s")).schema["s"].dataType
        last = got.filter("id = 399").first()
        assert (last.s, last.m, last.d) == (n, 1, 0)
    centred = rolling.rolling_rows(df, by, "id", "v", 201, {"s": "sum"}, center=True).filter("id = 200").first()
    assert centred.s == 201


def test_time_spans_do_not_depend_on_how_busy_they_are(spark):
    for per_second in (1, 300):
        df = spark.range(900).select("id", F.lit("a").alias("g"), F.timestamp_seconds(F.floor(F.col("id") / per_second)).cast("timestamp_ntz").alias("ts"), F.lit(2).cast("long").alias("v"))
        for by in ("g", None):
            got = rolling.rolling_time(df, by, "ts", 1_000_000, "v", {"s": "sum", "m": "median"})
            assert got.schema["s"].dataType.simpleString() == "bigint"
            assert {(r.s, r.m) for r in got.collect()} == {(2 * per_second, 2.0)}


def frame_statistics(values, qs=(0.5, 0.8)):
    import numpy as np

    known = [v for v in values if v is not None]
    if not known:
        return [0] + [None] * (5 + len(qs))
    var = None if len(known) < 2 else float(np.var(known, ddof=1))
    return [len(known), sum(known), float(np.mean(known)), min(known), max(known), var, *[float(np.quantile(known, q)) for q in qs]]


WANTED = {"n": "count", "s": "sum", "m": "mean", "lo": "min", "hi": "max", "d": "var", "q5": "median", "q8": 0.8}


def assert_frames(got, wanted_of):
    for r in got:
        for value, want in zip([r[c] for c in WANTED], wanted_of(r)):
            assert value == want if want is None or isinstance(want, int) else abs(value - want) < 1e-6 * max(1, abs(want))


@pytest.mark.parametrize("largest", [4_000_000, 0])
@pytest.mark.parametrize(("n", "center"), [(33, False), (48, True), (500, True)])
def test_row_frames_by_hand(rows, largest, n, center, monkeypatch):
    monkeypatch.setattr(groups, "LARGEST_PLAIN_GROUP", largest)
    monkeypatch.setattr(groups, "SEGMENT_ROWS", 10)
    data = {}
    for r in sorted(rows.collect(), key=lambda r: (r.us, r.id)):
        data.setdefault(r.g, []).append((r.id, r.v))
    before, after = (n // 2, (n - 1) // 2) if center else (n - 1, 0)

    def want(r):
        group = data[r.g]
        at = [i for i, _ in group].index(r.id)
        return frame_statistics([v for _, v in group[max(0, at - before) : at + after + 1]])

    assert_frames(rolling.rolling_rows(rows, "g", ORDER, "v", n, WANTED, 0, center).collect(), want)


@pytest.mark.parametrize("largest", [4_000_000, 0])
@pytest.mark.parametrize("by", ["g", None])
@pytest.mark.parametrize("span", [4_000_000, 300_000_000])
def test_time_frames_by_hand(rows, largest, by, span, monkeypatch):
    monkeypatch.setattr(groups, "LARGEST_PLAIN_GROUP", largest)
    monkeypatch.setattr(groups, "SEGMENT_ROWS", 4)
    data = [(r.g, r.us, r.v) for r in rows.collect()]
    want = lambda r: frame_statistics([v for g, us, v in data if (by is None or g == r.g) and r.us - span < us <= r.us])
    assert_frames(rolling.rolling_time(rows, by, "ts", span, "v", WANTED, 0).collect(), want)


def test_a_busy_second_is_cut_into_segments(spark, monkeypatch):
    """Half of the rows in one second: no task gets more rows than a segment and a frame."""
    monkeypatch.setattr(groups, "LARGEST_PLAIN_GROUP", 0)
    monkeypatch.setattr(groups, "SEGMENT_ROWS", 50)
    us = F.when(F.col("id") < 500, F.lit(7_000_000) + F.col("id") * 2_000).otherwise(F.col("id") * 1_000_000)
    df = spark.range(1000).select("id", F.lit("a").alias("g"), (F.timestamp_micros(us.cast("long"))).cast("timestamp_ntz").alias("ts"), F.col("id").cast("double").alias("v"))
    held = []
    counted = rolling._with_quantiles

    def watched(rows, partition, *rest):
        held.extend(r["count"] for r in rows.groupBy(*partition).count().collect())
        return counted(rows, partition, *rest)

    monkeypatch.setattr(rolling, "_with_quantiles", watched)
    got = {r.id: r.m for r in rolling.rolling_time(df, "g", "ts", 100_000, "v", {"m": "median"}).collect()}
    assert got == {i: (max(0, i - 49) + i) / 2 if i < 500 else i for i in range(1000)}
    assert max(held) <= 50 + 50 and len(held) >= 20


def test_decimals_and_times_keep_their_types(spark, monkeypatch):
    df = spark.range(120).select("id", F.lit("a").alias("g"), (F.col("id") / 7).cast("decimal(12,3)").alias("v"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"))
    wanted = {"s": "sum", "m": "mean", "lo": "min", "hi": "max", "first": ("min", "ts"), "n": "count"}
    long = rolling.rolling_rows(df, "g", "id", "v", 40, wanted, 1)
    timed = rolling.rolling_time(df, "g", "ts", 40_000_000, "v", wanted)
    monkeypatch.setattr(rolling, "SHORT_FRAME", 1000)
    plain = rolling.rolling_rows(df, "g", "id", "v", 40, wanted, 1)
    assert long.dtypes == plain.dtypes == timed.dtypes
    assert sorted(long.collect()) == sorted(plain.collect()) == sorted(timed.collect())
    with pytest.raises(ValueError):
        rolling.rolling_rows(df, "g", "id", "v", 40, {"x": 1.5})
    with pytest.raises(ValueError):
        rolling.rolling_rows(df, "g", "id", None, 40, {"x": "sum"})


def test_ranks_of_stretches():
    import numpy as np

    from quillframe.plans.order_statistics import RankTree

    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 100):
        values = rng.integers(0, max(1, n // 3), n).astype(float)
        tree = RankTree(values)
        start = rng.integers(0, n, 200)
        end = start + 1 + rng.integers(0, n - start)
        k = rng.integers(0, end - start)
        assert tree.smallest(start, end, k).tolist() == [sorted(values[a:b])[i] for a, b, i in zip(start, end, k)]


def test_whole_table_equals_one_group(rows, tiny_segments):
    one = rows.withColumn("all", F.lit(1))
    whole = result(missing.fill_forward(rows, None, ORDER, "v"))
    assert whole == result(missing.fill_forward(one, "all", ORDER, "v").drop("all"))


def test_position_is_dense_and_ordered(rows):
    assert rows.repartitionByRange("id").rdd.getNumPartitions() == 3
    got = with_position(rows, [("v", "desc"), "id"], "p").orderBy("p").collect()
    assert [r.p for r in got] == list(range(90))
    known = [(-r.v, r.id) for r in got if r.v is not None]
    assert known == sorted(known)
    assert all(r.v is None for r in got[len(known) :])


def test_position_of_no_rows(rows):
    assert keys.add_row_id(rows.filter("id < 0"), "id").count() == 0


def test_rolling_time_by_hand(rows, tiny_segments):
    data = [(r.g, r.us, r.v) for r in rows.collect()]
    got = rolling.rolling_time(rows, "g", "ts", 10_000_000, "v", {"s": "sum", "n": "count"}, 0).collect()
    for r in got:
        inside = [v for g, us, v in data if g == r.g and r.us - 10_000_000 < us <= r.us and v is not None]
        assert r.n == len(inside)
        if inside:
            assert abs(r.s - sum(inside)) < 1e-6
