"""WARC files, nearest neighbours, and the registered queries."""

import collections
import gzip
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillframe.llm import neighbours, warc
from quillframe.plans.lineage import scratch_path

PAGES = [
    (1, "http://a/1", "x" * 2000),
    (2, "http://a/2", "x" * 2000),
    (3, None, "x" * 2000),
    (4, "http://b/\r\nWARC-Type: bad", "short"),
    (5, "http://b/5", "short"),
    (6, "http://b/6", None),
    (7, "http://b/7", ""),
    (8, "http://b/8", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 200),
    (9, "http://b/9", "é" * 500),
    (10, "http://b/10", "é" * 500),
    (None, "http://c/0", "x" * 2000),
    (11, "http://c/11", "long " * 300_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("record_type", "payload", "response")})


def test_pages_round_trip(pages):
    same = collections.defaultdict(list)
    for i, _, html in PAGES:
        same[html or ""].append(-1 if i is None else i)
    want = set()
    for i, _, html in PAGES:
        data, first = (html or "").encode(), max(same[html or ""])
        again = len(data) >= 1000 and i != first
        want.add((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again else None))
    assert {tuple(r) for r in warc.pages_round_trip(pages).collect()} == want


def test_no_pages(spark):
    assert warc.pages_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_headers_decide_before_payloads(spark, pages, compression, monkeypatch):
    path = scratch_path(spark, "warc-test")
    warc.write_warc(warc.page_records(pages), path, compression=compression, fileBytes="3000")
    every = warc.read_warc(spark, path)
    assert every.count() == len(PAGES)
    some = warc.read_warc(spark, path, payload="false").filter("record_type = 'revisit'")
    assert {r["record_id"] for r in some.collect()} == {"urn:page:1", "urn:page:2", "urn:page:none", "urn:page:9"}
    assert {r["payload_bytes"] for r in some.collect()} == {2000, 1000}
    found = every.filter(F.col("target_uri").startswith("http://b/") & F.col("record_type").isin("response") & (F.length("payload") < 10))
    assert {(r["record_id"], bytes(r["payload"])) for r in found.collect()} == {
        ("urn:page:4", b"short"),
        ("urn:page:5", b"short"),
        ("urn:page:6", b""),
        ("urn:page:7", b""),
    }


def test_foreign_archives(spark, tmp_path):
    """Files that another writer made: no manifest, one gzip stream, other record types."""
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    page = b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:uuid:2>\r\nContent-Type: application/http\r\nContent-Length: 30\r\n\r\nHTTP/1.1 200 OK\r\nA: b\r\n\r\nbody!\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(info + page)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(page))
    got = warc.read_warc(spark, str(tmp_path)).select("record_type", "record_id", "payload", "payload_bytes").collect()
    assert sorted((r[0], r[1], bytes(r[2]), r[3]) for r in got) == sorted(
        [("warcinfo", "urn:uuid:1", b"hello", 5), ("response", "urn:uuid:2", b"body!", 5)] * 2
    )


# ---------------------------------------------------------------- nearest neighbours


def brute_nearest(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == len(rows[0][1])]
    ok = list({(i, tuple(v)): (i, v) for i, v in ok}.values())  # a repeated row is one row
    scaled = [(i, v / np.abs(v).max()) for i, v in ok]  # squares of tiny and huge numbers
    ids, unit = [i for i, _ in ok], np.array([v / np.linalg.norm(v) for _, v in scaled])
    out = {}
    for i, u in zip(ids, unit):
        if i % 50 == 0:
            near = sorted((-round(float(u @ w), 12), j) for j, w in zip(ids, unit) if j != i)[:k]
            out[i] = [j for _, j in near]
    return out


def test_nearest_of_awkward_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(130)]
    rows += [(200 + i, rows[50][1]) for i in range(20)]  # copies of a query's vector
    rows += [(300, None), (350, [0.0] * 6), (400, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (450, [float("nan")] * 6), (500, [float("inf")] * 6), (550, [1.0])]
    rows += [(None, rows[0][1]), (50, rows[50][1]), (600, [1e-200] * 6), (601, [1e200] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("key", "query", "tree", "id")})
    got = collections.defaultdict(list)
    for r in neighbours.nearest(table, F.col("vec_id") % 50 == 0, recall=1.0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = brute_nearest(rows, 5)
    assert set(got) == set(want) == {0, 50, 100, 200, 600}
    for i, near in want.items():
        assert [r for r, *_ in got[i]] == [1, 2, 3, 4, 5]
        hit = len(set(near) & {j for _, j, _ in got[i]})
        assert hit == 5 if i in (50, 200, 600) else hit >= 4
    assert [j for _, j, _ in got[50]] == [200, 201, 202, 203, 204] and got[600][0][1:] == (601, pytest.approx(1.0))


def test_fewer_candidates_than_asked_for(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = neighbours.nearest(table, F.col("vec_id") % 50 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 0.0)]
    assert neighbours.nearest(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("shard_rows", [neighbours.SHARD_ROWS, 300])
def test_recall(spark, shard_rows, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", shard_rows)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    want, got = brute_nearest(rows, 5), collections.defaultdict(set)
    for r in neighbours.nearest(table, F.col("vec_id") % 50 == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    assert np.mean([len(got[i] & set(near)) / 5 for i, near in want.items()]) >= 0.9


def test_small_shards_lose_no_recall(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 16)  # 7 bits and more, where queries must ascend further
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    want, got = brute_nearest(rows, 5), collections.defaultdict(set)
    for r in neighbours.nearest(table, F.col("vec_id") % 50 == 0, trees=10).collect():
        got[r["query_id"]].add(r["vec_id"])
    assert np.mean([len(got[i] & set(near)) / 5 for i, near in want.items()]) >= 0.9


def test_scaled_copies_rank_by_id(spark):
    rng = np.random.default_rng(3)
    query = rng.normal(size=6)
    rows = [(0, query.tolist())] + [(100 - i, (query * 2.0**i).tolist()) for i in range(1, 21)]  # smaller ids last
    rows += [(200 + i, rng.normal(size=6).tolist()) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = neighbours.nearest(table, F.col("vec_id") == 0, trees=5).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [80, 81, 82, 83, 84]


def test_ties_in_a_shard_all_go_on():
    import pyarrow as pa

    vectors = np.eye(24)[1:21] + np.eye(24)[0]
    part = [(False, list(range(20)), [0] * 20, vectors.ravel().tolist(), [0] * 20), (True, [99], [0], np.eye(24)[0].tolist(), [0])]
    names = ("query", "key", "string", "vector", "depth")
    met = neighbours._meet(24, 6)(pa.table(dict(zip(names, map(list, zip(*part))))))
    assert sorted(met["key"].to_pylist()) == list(range(20))


# ---------------------------------------------------------------- queries and the pipeline


def test_queries_against_twins(spark, folder):
    from quillframe.llm.queries import ORACLES, QUERIES

    from ..oracle import differences, duck

    for name, sql in ORACLES.items():
        assert differences(QUERIES[name](spark, folder), duck(folder), sql) == []
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 11)]


def test_pipeline(spark, folder, edge):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder).persist()
        assert out.columns == docs.columns, name
        left = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert left and left <= ids
        docs, ids = out, left
    last = collections.Counter(r["doc_id"] for r in corpus_pipeline.run(spark, folder).filter("piece = 0").collect())
    assert last == collections.Counter(r["doc_id"] for r in docs.collect())
    awkward = edge.withColumn("n_chars", F.length("text").cast("bigint"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, awkward, folder).count() > 0
        assert stage(spark, awkward.limit(0), folder).count() == 0


def test_one_row_of_each_group_of_near_duplicates_stays(spark, folder):
    import corpus_pipeline

    text = lambda k: " ".join(f"{k}w{i}" for i in range(60))
    rows = [(None, text("a")), (None, text("a")), (None, text("a"))]  # null ids
    rows += [(5, text("b"))] * 3  # repeated rows
    rows += [(7, text("c")), (8, text("c")), (8, text("d")), (None, text("c"))]  # one id, two texts
    rows += [(9, text("e")), (9, ""), (9, ""), (10, None), (None, None)]  # texts without words are nobody's copies
    table = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, row int").repartition(3)
    got = collections.Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, table, folder).collect())
    want = [(None, text("a")), (5, text("b")), (7, text("c")), (8, text("d")), (9, text("e")), (9, ""), (9, ""), (10, None), (None, None)]
    assert got == collections.Counter(want)
