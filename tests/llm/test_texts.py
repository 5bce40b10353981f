"""Operators on documents against brute force and on awkward rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from quillframe.llm import exact_dedup, jaccard, line_dedup, mixing, ngram_lm, packing, quality, sharding
from quillframe.llm.components import connected_components
from quillframe.llm.words import chunks, hash_words, word_hash

from .conftest import LONG, TEXTS

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


# ---------------------------------------------------------------- words


def test_words_hash_alike_wherever_they_stand():
    import pyarrow as pa

    texts = ["a Bb", "", None, "bb\x0ba", " x ", "A"]
    found = [(list(hash_words(d, e)[0]), list(hash_words(d, e)[1])) for _, _, d, e in chunks(pa.array(texts))]
    assert found == [([word_hash(w) for t in texts for w in words_of(t)], [2, 0, 0, 2, 1, 1])]


# ---------------------------------------------------------------- exact dedup


def brute_dedup(texts):
    groups = collections.defaultdict(list)
    for i, t, *_ in texts:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), math.inf if i is None else i))
    out = collections.Counter()
    for norm, members in groups.items():
        keep = min(members)[1]
        for size, i in members:
            out[(i, keep, len(members), hashlib.sha256(norm.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("counters", [exact_dedup.COUNTERS, 4])
def test_exact_dedup(edge, counters):
    got = rows(exact_dedup.dedup_groups(edge, candidates=min(2, counters), counters=counters))
    none = lambda i: math.inf if i is None else i
    assert collections.Counter((none(r["doc_id"]), none(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in got) == brute_dedup(TEXTS)
    kept = collections.Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len({r["text_sha256"] for r in got})


def test_exact_dedup_of_nothing(nothing):
    assert exact_dedup.dedup_groups(nothing).count() == 0


# ---------------------------------------------------------------- sharding


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards_are_even_and_gapless(spark, docs, shards):
    hot = docs.withColumn("source", docs.source.substr(1, 3))  # one source for all rows
    got = rows(sharding.kd_shards(hot, shards))
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
    mean, most = sum(size.values()) / shards, max(r["size"] for r in got)
    assert set(size) == set(range(shards)) if shards < 40 else set(size) <= set(range(shards))
    assert all(abs(b - mean) <= most for b in size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    text = {r["doc_id"]: r["text"] for r in rows(docs)}
    assert all(r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in got)


def test_shards_of_awkward_rows(edge, nothing):
    got = rows(sharding.kd_shards(edge, 4))
    assert sorted(r["size"] for r in got) == sorted(len((t or "").encode()) + 16 for _, t, *_ in TEXTS)
    assert sharding.kd_shards(nothing, 4).count() == 0
    assert {r["shard"] for r in rows(sharding.kd_shards(edge, None, target_bytes=1 << 40))} == {0}


# ---------------------------------------------------------------- mixing


def test_choose_counts_reaches_what_can_be_reached():
    rng = np.random.default_rng(0)
    for _ in range(40):
        size = rng.choice(np.arange(1, 40), 6, replace=False)
        count = rng.integers(1, 5, 6)
        sums = {0}
        for s, c in zip(size, count):
            sums = {x + k * s for x in sums for k in range(c + 1)}
        budget = int(rng.integers(0, (size * count).sum() + 1))
        taken = mixing.choose_counts(size, count, budget)
        assert (taken >= 0).all() and (taken <= count).all()
        assert abs(int((size * taken).sum()) - budget) <= max(3, min(abs(x - budget) for x in sums))
    big = mixing.choose_counts(np.array([7, 1000]), np.array([10**9, 10**9]), 10**11 + 3, fit_words=5000)
    assert abs(7 * int(big[0]) + 1000 * int(big[1]) - 10**11 - 3) <= 3


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        target |= {s: float(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return target


def test_mixing(docs, edge, monkeypatch):
    monkeypatch.setattr(mixing, "PART_ROWS", 3)
    for table in (docs, edge):
        source = collections.Counter()
        for r in rows(table):
            source[r["source"]] += len(words_of(r["text"]))
        want = brute_targets(source)
        got = rows(mixing.mix_sources(table))
        taken = collections.Counter()
        for r in got:
            taken[r["source"]] += r["taken"]
            assert r["source_size"] == source[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
            assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        if table is docs:
            assert all(abs(taken[s] - want[s]) <= max(3, 0.01 * want[s]) for s in want)
        assert sorted(map(str, got)) == sorted(map(str, rows(mixing.mix_sources(table.repartition(3)))))


def test_mixing_nothing(nothing):
    assert mixing.mix_sources(nothing).count() == 0


# ---------------------------------------------------------------- packing


def test_packing(docs, edge):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.public_tokenizer())
    for table in (docs, edge):
        got = rows(packing.pack(table))
        own = collections.defaultdict(list)
        for r in rows(table):
            own[r["doc_id"]].append(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0])
        pieces, want = collections.Counter(), collections.Counter()
        for r in got:
            pieces[(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])] += 1
        for i, texts in own.items():
            for ids in texts:
                for k in range(0, len(ids), 2048):
                    part = ids[k : k + 2048]
                    want[(i, k // 2048, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
        assert pieces == want
        held = collections.defaultdict(list)
        for r in got:
            held[r["sequence_id"]].append((r["offset"], r["length"]))
        for parts in held.values():
            parts.sort()
            assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
            assert sum(n for _, n in parts) <= 2048
        assert len(held) <= -(-sum(r["length"] for r in got) // 2048) + 1


def test_plan_fills_exactly_where_it_can():
    count = np.zeros(2049, np.int64)
    count[[2048, 1500, 548, 1000, 600, 448, 900, 700, 300, 148]] = 5
    plan = packing.plan_sequences(count)
    assert all(sum(x * n for x, n in held.items()) == 2048 for _, held in plan) and sum(t for t, _ in plan) == 20


def test_packing_nothing(nothing):
    assert packing.pack(nothing).count() == 0


def test_words_and_marks_encode_as_whole_texts_do():
    encoder = packing._WordEncoder(packing.public_tokenizer())
    texts = [t or "" for _, t, *_ in TEXTS] + ["It's ΑΣ, İx! ÀÉ. a<|endoftext|>b 1st. é́a, x\n\ty ẞ? " + "y" * 100]
    plain = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for _ in range(2):  # from the caches, too
        assert encoder.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in plain]


def test_known_units_need_no_tokenizer():
    encoder = packing._WordEncoder(packing.public_tokenizer())
    encoder.encode(["one two. 3 (straße) & it's"])
    new = ["(TWO)\n& one3.straße\tit's", "3.& 33.."]
    want = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in new]
    whole, encoder.tokenizer = encoder.tokenizer, None
    assert encoder.encode(new[:1]) == want[:1]
    encoder.tokenizer = whole
    assert encoder.encode(new) == want


def test_units_encode_as_whole_texts_do(monkeypatch):
    rng = np.random.default_rng(13)
    parts = [*"aAbSstmrev019 .,!?'|<>_-*&^`\t\n\r\x0b\x0c\x00\x1c", "<|endoftext|>", "'s", "'re", *"éÉÀñßẞİıſŉ×÷ɐȀµª\u0301\u0307\u200b’日жΣς가😀²½"]
    parts += ["x" * n for n in (47, 48, 49)]
    texts = ["".join(parts[k] for k in rng.integers(0, len(parts), rng.integers(0, 30))) for _ in range(5_000)]
    encoder = packing._WordEncoder(packing.public_tokenizer())
    want = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(packing, "CHUNK_BYTES", 5_000)
    monkeypatch.setattr(packing, "CACHE_UNITS", 3_000)
    assert encoder.encode(texts) == want
    encoder.by_units = False  # as for another kind of tokenizer
    assert encoder.encode(texts) == want


# ---------------------------------------------------------------- line dedup


def brute_lines(texts, least):
    """Lines of each text that an earlier equal run of at least ``least`` words, found pair by pair, covers."""
    key = lambda x: " ".join(x.replace("\t", " ").split(" ")).strip()
    order = sorted((t for t in texts if t[0] is not None), key=lambda t: t[0])
    solid = {i: [(k, key(x)) for k, x in enumerate((t or "").split("\n")) if key(x)] for i, t in order}
    gone = collections.defaultdict(set)
    for b, (i, _) in enumerate(order):
        for j, _ in order[: b + 1]:
            for p in range(len(solid[i])):
                for q in range(len(solid[j])):
                    n = 0
                    while p + n < len(solid[i]) and q + n < len(solid[j]) and solid[i][p + n][1] == solid[j][q + n][1] and (i, p) > (j, q):
                        n += 1
                    if n and sum(len(x.split()) for _, x in solid[i][p : p + n]) >= least:
                        gone[i].update(k for k, _ in solid[i][p : p + n])
    return gone


def test_line_dedup(spark):
    rng = np.random.default_rng(5)
    lines = [" ".join(f"v{rng.integers(99)}" for _ in range(n)) for n in (3, 5, 8, 13, 21, 34)]
    texts = [(i, "\n".join(lines[k] for k in rng.integers(0, 6, rng.integers(1, 9))) + f"\nown {i}") for i in range(14)]
    got = {r["doc_id"]: r for r in rows(line_dedup.drop_repeated_lines(spark.createDataFrame(texts, "doc_id long, text string"), min_words=30))}
    gone = brute_lines(texts, 30)
    assert sum(map(len, gone.values())) > 10
    for i, t in texts:
        kept = t.split("\n")
        # All of a window is certain to go; the rest of a run goes as far as the first place agrees.
        assert set(got[i]["text"].split("\n")) >= {kept[k] for k in range(len(kept)) if k not in gone[i]}
        assert (got[i]["deleted_lines"] > 0) == bool(gone[i]) and got[i]["deleted_lines"] <= len(gone[i])


def test_line_dedup_of_awkward_rows(edge, nothing):
    out = line_dedup.drop_repeated_lines(edge)
    assert out.columns == edge.columns + ["lines_", "deleted_lines_"]
    got = {(r["doc_id"], k): r for k, r in enumerate(rows(out))}
    assert len(got) == len(TEXTS)
    by_id = {r["doc_id"]: r["text"] for r in got.values()}
    assert by_id[12] == "own\nend" and by_id[11].count("\n") == 11 and by_id[3] is None and by_id[8] == LONG
    assert line_dedup.drop_repeated_lines(nothing).count() == 0


def test_passages_inside_lines_go(spark):
    rng = np.random.default_rng(11)
    own = lambda n: [f"o{rng.integers(10**9)}" for _ in range(n)]
    texts, want = [], {}
    for k in range(51, 61):  # a passage of k words, the second time in the middle of another line and broken in two
        passage, left, right = own(k), own(20), own(30)
        texts.append((2 * k, " ".join(own(7) + passage + own(9))))
        texts.append((2 * k + 1, "first line\n" + " ".join(left + passage[:25]) + "\n" + " ".join(passage[25:] + right)))
        want[2 * k + 1] = "first line\n" + " ".join(left) + "\n" + " ".join(right)
    short = own(49)
    texts += [(900 + i, " ".join(own(5) + short + own(5))) for i in range(2)]
    # The earliest place that shares the span in the middle shares too little; a later one shares all.
    passage = own(60)
    texts.append((920, " ".join(own(3) + passage[10:50] + own(3))))
    texts += [(921, " ".join(own(3) + passage)), (922, " ".join(["x", *passage, "y"]))]
    want[922] = "x y"
    got = {r["doc_id"]: r for r in rows(line_dedup.drop_repeated_lines(spark.createDataFrame(texts, "doc_id long, text string")))}
    for i, t in texts:
        assert got[i]["text"] == want.get(i, t), i
        assert (got[i]["deleted_lines"] > 0) == (i in want)


def test_every_repeated_window_of_words_goes(spark):
    rng = np.random.default_rng(12)
    parts = [[f"w{rng.integers(400)}" for _ in range(rng.integers(5, 60))] for _ in range(12)]
    texts = [(i, " ".join(w for k in rng.integers(0, 12, 5) for w in parts[k])) for i in range(40)]
    texts.append((40, "again " * 130))
    seen, want = set(), {}
    for i, t in texts:
        words = t.split()
        dead = set()
        for j in range(len(words) - 29):
            window = tuple(words[j : j + 30])
            if window in seen:
                dead.update(range(j, j + 30))
            seen.add(window)
        want[i] = [w for k, w in enumerate(words) if k not in dead]
    got = rows(line_dedup.drop_repeated_lines(spark.createDataFrame(texts, "doc_id long, text string"), min_words=30))
    assert {r["doc_id"]: r["text"].split() for r in got} == want and any(len(t.split()) > len(want[i]) > 0 for i, t in texts)


def test_passages_are_found_without_python(spark, capsys):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"a {passage} b"), (2, f"c {passage} d")], "doc_id long, text string")
    shape = line_dedup._Shape(50)
    anchors = line_dedup._anchors(docs.selectExpr("doc_id AS id", "text", "0L AS text_key"), shape)
    listed = docs.selectExpr("doc_id AS id", "text", "0L AS text_key", "array(named_struct('at', 20, 'left', true)) AS anchors")
    for part in (anchors, line_dedup._windows(listed, shape)):
        part.explain()
        assert "InArrow" not in (plan := capsys.readouterr().out) and "Python" not in plan
    assert [r["deleted_lines"] for r in rows(line_dedup.drop_repeated_lines(docs))].count(1) == 1


def test_line_dedup_sorts_places_once(spark, capsys):
    """Places are ranked: none is dealt out twice to meet the first of its like, and no word is hashed twice for a context."""
    passage = [f"p{i}" for i in range(120)]
    docs = spark.createDataFrame([(k, " ".join([*passage[:k], f"x{k}", *passage[k:]])) for k in (3, 70, 117)] * 2, "id long, text string")
    shape = line_dedup._Shape(50)
    anchors = line_dedup._anchors(docs.withColumn("text_key", line_dedup._text_key(docs["text"])), shape)
    for r in anchors.collect():
        words = dict(docs.collect())[r["id"]].split()
        assert (r["before"] is None) == (r["at"] < shape.half) and (r["behind"] is None) == (r["at"] + shape.span + shape.rest > len(words))
        assert r["reach"] == min(r["at"] + shape.span + shape.wide, len(words)) - r["at"]
    context = {}
    for r in anchors.collect():
        words = dict(docs.collect())[r["id"]].split()
        left = max(0, r["at"] - shape.wide)
        context.setdefault(r["context"], set()).add((r["at"] - left, *words[left : r["at"] + r["reach"]]))
    assert all(len(x) == 1 for x in context.values()) and len(set().union(*context.values())) == len(context)
    line_dedup.repeated_passages(docs.withColumnRenamed("id", "doc_id")).explain()
    assert "SortAggregate" not in capsys.readouterr().out
    out = line_dedup.drop_repeated_lines(docs, id_col="id")
    assert sorted((r["id"], r["deleted_lines"]) for r in rows(out)) == [(3, 0), (3, 0), (70, 1), (70, 1), (117, 1), (117, 1)]


def dealt_out(df):
    """The most rows that one shuffle of the plan deals out."""

    def walk(node):
        below = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in node.nodeName() else []
        metrics = node.metrics()
        own = metrics.apply("shuffleRecordsWritten").value() if metrics.contains("shuffleRecordsWritten") else 0
        children = node.children()
        return max([own, *map(walk, below + [children.apply(i) for i in range(children.size())])])

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_texts_without_repeats_are_not_dealt_out(spark, monkeypatch):
    own = lambda k, n: [f"t{k}x{i}" for i in range(n)]
    texts = [(k, " ".join(own(k, 90))) for k in range(300)]
    passage = own("p", 60)
    texts += [(400 + k, " ".join([*own(f"a{k}", 30), *passage, *own(f"b{k}", 30)])) for k in range(3)]
    texts += [(None, None), (None, texts[0][1]), (7, texts[7][1])]
    listed, windows = [], line_dedup._windows
    monkeypatch.setattr(line_dedup, "_windows", lambda again, shape: listed.append(again) or windows(again, shape))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many texts
    try:
        out = line_dedup.drop_repeated_lines(spark.createDataFrame(texts, "doc_id long, text string"))
        assert dealt_out(out) <= 30 and dealt_out(listed[0]) <= 30
        got = sorted((r["doc_id"] or 0, len((r["text"] or "").split()), r["deleted_lines"]) for r in out.collect())
        assert got == sorted([(0, 0, 0), (0, 0, 1), (7, 90, 0), *((k, 90, 0) for k in range(300)), (400, 120, 0), (401, 60, 1), (402, 60, 1)])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_full_sieve_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SIEVE_BITS", 1)
    rows = spark.range(-500, 500).selectExpr("xxhash64(id) AS key", "id AS `place.x`", "id AS place").union(spark.sql("SELECT null, 0L, 0L"))
    wanted = rows.filter("place > 400").select("key")
    met, others = line_dedup._sieved(rows, "key", wanted)
    assert met.columns == others.columns == rows.columns and met.union(others).exceptAll(rows).isEmpty()
    assert met.count() + others.count() == 1001 and wanted.exceptAll(met.select("key")).isEmpty()
    met, others = line_dedup._sieved(rows, "key", wanted.limit(0))
    assert met.count() == 0 and others.count() == 1001


# ---------------------------------------------------------------- n-gram Jaccard join


def brute_components(texts):
    sets = []
    for _, t, *_ in texts:
        w = words_of(t)
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(sets)))

    def find(i):
        return i if up[i] == i else find(up[i])

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                up[y] = x
    groups = collections.defaultdict(list)
    for k in range(len(sets)):
        groups[find(k)].append(texts[k][0])
    least = {k: min((i for i in g if i is not None), default=None) for k, g in groups.items()}
    return collections.Counter((texts[k][0], len(sets[k]), least[find(k)]) for k in range(len(sets)))


def test_jaccard_components(spark, docs, edge, monkeypatch):
    rng = np.random.default_rng(3)
    near = []
    for family in range(12):  # families of edited copies, around and below the similarity asked for
        base = [f"f{family}w{k}" for k in range(rng.integers(8, 80))]
        for _ in range(8):
            edit = [w if rng.random() > 0.04 else f"x{rng.integers(9)}" for w in base]
            near.append((len(near), " ".join(edit[: rng.integers(len(edit) // 2, len(edit) + 1)])))
    plain = [(r["doc_id"], r["text"]) for r in rows(docs)]
    for texts, table in ((near, spark.createDataFrame(near, "doc_id long, text string")), (plain, docs), (TEXTS, edge)):
        for block in (jaccard.BLOCK_BYTES, 2_000):
            monkeypatch.setattr(jaccard, "BLOCK_BYTES", block)
            got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(jaccard.jaccard_components(table)))
            assert got == brute_components(texts)


def test_trees_find_every_link(monkeypatch):
    monkeypatch.setattr(jaccard, "STEP_PAIRS", 7)
    rng = np.random.default_rng(8)
    for _ in range(20):
        sets = [np.unique(rng.integers(0, 30, rng.integers(1, 25))).astype(np.uint64) for _ in range(30)]
        n = np.array([len(s) for s in sets])
        up = np.arange(30)
        for i in range(30):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if 100 * common >= 60 * (n[i] + n[j] - common):
                    up[up == max(up[i], up[j])] = min(up[i], up[j])
        assert (jaccard.link_sets(sets, n, 60) == up).all()


def test_jaccard_of_nothing(nothing):
    assert jaccard.jaccard_components(nothing).count() == 0


def test_connected_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (103, 101), (7, 7)]
    got = {r["node"]: r["component"] for r in rows(connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b"))}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, 103: 100}


# ---------------------------------------------------------------- language model


def brute_scores(texts):
    tokens = [words_of(t) + [None] for _, t, *_ in texts]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in texts]
    pairs, single = collections.Counter(), collections.Counter()
    for w, h in zip(tokens, held):
        if not h:
            single.update(w)
            pairs.update(zip([0, *w[:-1]], w))
    total, kinds, left = sum(single.values()), len(single), collections.Counter(w for _, w in pairs)
    contexts, by_count = collections.Counter(), collections.defaultdict(lambda: [0] * 4)
    for (a, _), c in pairs.items():
        contexts[a] += c
        by_count[a][min(c, 3)] += 1
    of = lambda c: ngram_lm.discounts([sum(v == k for v in c.values()) for k in (1, 2, 3, 4)])
    top, low = of(pairs), of(left)
    rest = sum(low[min(c, 3)] for c in left.values()) / max(1, len(pairs)) if pairs else 1.0
    out = []
    for (i, *_), w, h in zip(texts, tokens, held):
        score = 0.0
        for a, x in zip([0, *w[:-1]], w):
            p = ((left[x] - low[min(left[x], 3)]) / len(pairs) if pairs else 0) + rest / (kinds + 1)
            if contexts[a]:
                p = (pairs[a, x] - top[min(pairs[a, x], 3)]) / contexts[a] + sum(top[k] * by_count[a][k] for k in (1, 2, 3)) / contexts[a] * p
            score += math.log10(p)
        base = sum(math.log10((single[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w)
        out.append((i, h, len(w), sum(single[x] > 0 for x in w), total, base, score))
    return out


def test_language_model(docs, edge, monkeypatch):
    for table, block in ((docs, 20_000), (edge, 5)):
        monkeypatch.setattr(ngram_lm, "BLOCK_TOKENS", block)
        texts = [(r["doc_id"], r["text"]) for r in rows(table)]
        order = lambda x: (str(x[0]), x[2], x[6])
        got = sorted((tuple(r.values()) for r in rows(ngram_lm.score_texts(table))), key=order)
        want = sorted(brute_scores(texts), key=order)
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)
    held = [g for g in sorted((tuple(r.values()) for r in rows(ngram_lm.score_texts(docs))), key=order) if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)


def test_probabilities_add_up(docs):
    model = ngram_lm.train(docs)
    known = np.concatenate([np.memmap(f"{n}.word", "<u8", "r") for n in model.words if n])
    for before in (known[0], known[7], np.uint64(1), ngram_lm.START):  # seen and unseen contexts
        log, _ = model.score(np.append(known, np.uint64(3)), np.full(len(known) + 1, before))
        assert (10**log).sum() == pytest.approx(1)


def test_language_model_of_nothing(nothing, spark):
    assert ngram_lm.score_texts(nothing).count() == 0
    only_held_out = spark.createDataFrame([(i, "a b") for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1], "doc_id long, text string")
    assert {(r["train_tokens"], r["base_score"], r["score"]) for r in rows(ngram_lm.score_texts(only_held_out))} == {(0, 0.0, 0.0)}


# ---------------------------------------------------------------- quality


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(2)
    bad = rng.random(20_000) < 0.15
    found, alarm = np.array([0.5, 0.4, 0.6, 0.3]), np.array([0.001, 0.002, 0.0005, 0.001])
    fires = rng.random((20_000, 4)) < np.where(bad[:, None], found, alarm)
    votes, back, count = np.unique(np.where(fires, quality.BAD, quality.GOOD), axis=0, return_inverse=True, return_counts=True)
    said = quality.fit_label_model(votes, count.astype(float))[back.ravel()] > 0.5
    assert said[~bad].mean() < 0.01 and said[bad].mean() > 0.85


def test_quality_on_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    kept = {r["doc_id"]: r["kept"] for r in rows(quality.quality_scores(docs, labels))}
    truth = rows(labels)
    clean = [kept[r["doc_id"]] for r in truth if r["quality"] == 1 and r["toxic"] == 0]
    junk = [kept[r["doc_id"]] for r in truth if r["quality"] == 0]
    assert np.mean(clean) > 0.97 and np.mean(junk) < 0.25


def test_quality_of_awkward_rows(edge, nothing, spark):
    insult = spark.createDataFrame([(99, "You are a stupid worthless idiot, a pathetic loser. " * 3, "en", "a")], "doc_id long, text string, lang string, source string")
    table = edge.unionByName(insult, allowMissingColumns=True)
    out = quality.quality_scores(table, nothing.selectExpr("doc_id", "1 AS quality", "1 AS toxic"), carry=("text", "score", "id"))
    got = rows(out.select("doc_id", "text", "kept"))
    assert len(got) == len(TEXTS) + 1
    assert all(r["kept"] for r in got if not (r["text"] or "").strip())
    assert quality.quality_scores(nothing).count() == 0




def test_sample_is_fitted_in_little_memory():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(8)
    toxic = (np.arange(2000) % 4 == 0).astype(np.int32)
    mark = {0: 7, 3: 8}  # a word and a beginning that toxic rows alone have
    features = []
    for t in toxic:
        own = rng.integers(10, 9000, 1000).astype(np.uint64) | rng.integers(0, 5, 1000).astype(np.uint64) << np.uint64(32)
        features.append(np.unique(np.append(own, [k << 32 | v for k, v in mark.items()] if t else []).astype(np.uint64)))
    table = pa.table({"id": np.arange(2000), "shape": np.full(2000, 3280), "insults": toxic, "features": pa.array([f.tobytes() for f in features], pa.binary()), "toxic": toxic})
    table = pa.concat_tables([table.slice(0, 700), table.slice(700, 0), table.slice(700)])
    tracemalloc.start()
    found = quality._lexicon_task(table)
    lexicons = [(np.frombuffer(v.as_py(), np.uint64), np.frombuffer(r.as_py())) for v, r in zip(found["value"], found["ratio"])]
    assert [v.tolist() for v, _ in lexicons] == [[7], [], [3 << 32 | 8], []]
    good, bad, not_known = quality.GOOD, quality.BAD, quality.ABSTAIN
    code = quality._code(np.array([[v, v, not_known, v, not_known] for v in (good, bad)])).tolist()
    model = quality.LabelModel([(3280, code[t], int((toxic == t).sum())) for t in (0, 1)])
    fitted = quality._scorer_task(model, lexicons)(table)
    assert np.frombuffer(fitted["number"][0].as_py(), np.uint64).tolist() == [7, 3 << 32 | 8]
    # At most twice the bytes of the sample: sorted all at once, they took more than seven times as much.
    assert tracemalloc.get_traced_memory()[1] < 2 * sum(f.nbytes for f in features)
    tracemalloc.stop()
