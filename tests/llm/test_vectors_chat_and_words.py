"""Whitening, chat formatting and spelling variants."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quillframe.llm import chat, spelling, whitening
from quillframe.llm.queries import ORACLES, QUERIES
from quillframe.llm.template import Template, TemplateError, Turns
from tests.oracle import differences, duck

# Whitening ------------------------------------------------------------------------------------


def plain_whitening(vectors, k=8):
    """The contract in whole numbers and a library's eigenvectors."""
    x = [[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(row[j] for row in x) for j in range(d)]
    deviation = [sum((n * row[j] - s[j]) ** 2 for j in range(d)) for row in x]
    centred = np.array([[float(Fraction(n * row[j] - s[j], n)) for j in range(d)] for row in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return deviation, centred @ axes / np.sqrt(values), values / (centred**2).sum() * n


def white_rows(df):
    rows = df.collect()
    names = list(dict.fromkeys(r[0] for r in rows))
    found = {(r[0], r["component"]): r for r in rows}
    k = max(r["component"] for r in rows)
    return names, np.array([[found[i, c + 1]["whitened"] for c in range(k)] for i in names]), found


@pytest.mark.parametrize("d", [1, 3, 20])
def test_whitening_equals_a_library(spark, d):
    rng = np.random.default_rng(d)
    vectors = rng.standard_normal((200, d)) @ rng.standard_normal((d, d)) + 3
    data = [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(vectors)]
    df = whitening.whiten(spark.createDataFrame(data, "vec_id long, embedding array<float>"))
    names, white, found = white_rows(df)
    deviation, want, explained = plain_whitening([v for _, v in data])
    k = min(8, d)
    assert names and len(found) == 200 * k
    for i in names:
        assert int(found[i, 1]["deviation"]) == deviation[i]
        assert found[i, 1]["n"] == 200
    want = want[names]
    signs = np.sign((white * want).sum(axis=0))
    assert np.abs(white - want * signs).max() < 1e-7
    assert all(abs(found[0, c + 1]["explained"] / explained[c] - 1) < 1e-9 for c in range(k))
    error = {r["identity_error"] for r in found.values()}
    assert len(error) == 1 and 0 <= error.pop() < 1e-12
    assert np.abs(np.cov(white.T, bias=True) - np.eye(k)).max() < 1e-12


def test_whitening_of_awkward_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 2.0], 7),
        (1, [1.0, 2.0], 7),
        (None, [0.0, 5.0], 7),
        (3, [-2.0, 0.5], 7),
        (4, None, 7),
        (5, [1.0, None], 7),
        (6, [nan, 1.0], 7),
        (7, [inf, 1.0], 7),
        (8, [], 7),
        (9, [1.0], 7),
        (10, [1e30, 1.0], 7),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n long").withColumn("component", F.lit("x"))
    out = whitening.whiten(df).collect()
    assert Counter(r["vec_id"] for r in out) == {1: 4, None: 2, 3: 2}
    deviation, _, _ = plain_whitening([rows[i][1] for i in (0, 1, 2, 3)])
    assert {(r["vec_id"], int(r["deviation"])) for r in out} == {(1, deviation[0]), (None, deviation[2]), (3, deviation[3])}
    schema = "vec_id string, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([("a", [1.0, 2.0])] * 5, schema)).count() == 0
    # No spread along one axis, and equal spread along two.
    flat = [(str(i), [float(i % 2), float(i // 2 % 2), 3.0]) for i in range(8)]
    out = whitening.whiten(spark.createDataFrame(flat, schema)).collect()
    assert {r["component"] for r in out} == {1, 2} and out[0]["identity_error"] < 1e-12
    assert {round(r["explained"], 12) for r in out} == {0.5}


def test_deviations_are_exact_beyond_64_bits(spark):
    vectors = [[2.0**20, -(2.0**30)], [3.0, 2.0**31 + 1], [-(2.0**41), 0.25], [2.0**41, 1.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    out = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(df).collect()}
    assert list(map(out.get, range(4))) == plain_whitening(vectors)[0]
    for largest, n in ((1 << 20, 1000), (1 << 40, 1 << 20), (1 << 52, 1 << 30)):
        y = np.random.default_rng(n).integers(-largest, largest, (20, 5))
        sums = [int(s) for s in np.random.default_rng(1).integers(0, n, 5)]
        want = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in y]
        got = whitening._deviations(y, n, sums).to_pylist()
        assert got == [w if w < 10**38 else None for w in want]


def test_moments_are_exact_for_any_size_of_entry():
    for largest in (3, 1 << 20, 1 << 30, 1 << 52):
        y = np.random.default_rng(largest).integers(-largest, largest, (50, 4))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(4)] for i in range(4)]
        assert whitening._gram(y).tolist() == want


@pytest.mark.parametrize("values", [[5] * 4 + [3] * 3 + [1] * 13, [1, 1 - 1e-15, 1 - 1e-12, 1 - 1e-8, 0.5] + [0] * 15, [1] * 20, [1e-9] + [0] * 19, [1e12, 1, 1e-3] + [1e-3] * 17])
def test_slicing_with_repeated_and_tiny_eigenvalues(values):
    rng = np.random.default_rng(7)
    q, _ = np.linalg.qr(rng.standard_normal((20, 20)))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, vectors = whitening.leading_eigenpairs(a, 8)
    true = np.linalg.eigvalsh(a)[::-1][: len(found)]
    assert np.abs(found - true).max() <= 1e-13 * max(values)
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * found).max() <= 1e-13 * max(values)
    for shift in (0.1, 0.7, 2.5, -1.0, 1e-10):
        assert whitening.inertia(a, shift) == (np.linalg.eigvalsh(a) < shift).sum() or np.abs(np.linalg.eigvalsh(a) - shift).min() < 1e-3


def test_inertia_of_matrices_without_definite_pivots():
    assert whitening.inertia(np.array([[0.0, 1], [1, 0]]), 0.0) == 1
    assert whitening.inertia(np.zeros((3, 3)), 0.0) == 0 and whitening.inertia(np.zeros((3, 3)), 1.0) == 3
    rng = np.random.default_rng(3)
    for n in range(1, 30):
        b = rng.standard_normal((n, n))
        b[rng.random((n, n)) < 0.6] = 0
        a = b + b.T
        np.fill_diagonal(a, 0)
        for shift in rng.standard_normal(4):
            assert whitening.inertia(a, shift) == (np.linalg.eigvalsh(a) < shift).sum()


# Chat formatting ------------------------------------------------------------------------------

TURN_SCHEMA = "conv_id long, turn long, role string, text string"
SPECIAL = ["", "\\", "\\\\", "<turn>", "</turn>", "\\</turn>\n", "</turn>\n<turn>assistant\n", "a\nb", chat.PLANTED, "<", "</turn", "é\U0001f600", "x" * 5000]


def plain_digests(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def digests(df):
    return {r["conv_id"]: tuple(r)[1:5] for r in df.collect()}


def awkward_turns():
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "a\\\nb", "<turn>", ""]), rng.choice(SPECIAL)) for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(None, 1, "user", "no id"), (None, None, "assistant", None), (50, None, None, None), (50, 2, "assistant", "x"), (50, 2, "assistant", "x"), (50, 2, "user", "x")]
    return rows


def test_conversations_read_back_as_they_were(spark):
    rows = awkward_turns()
    df = spark.createDataFrame(rows, TURN_SCHEMA).withColumns({c: F.lit(1) for c in ("conv", "piece", "parts", "segment", "content", "n_turns")})
    want = plain_digests(rows)
    for piece_chars in (1, 50, 1 << 20):
        formatted = chat.format_conversations(df, piece_chars=piece_chars)
        assert digests(chat.read_back(formatted)) == want
    nothing = chat.format_conversations(spark.createDataFrame([], TURN_SCHEMA))
    assert nothing.count() == 0 and chat.read_back(nothing).count() == 0


def test_very_long_conversations_are_rendered_in_parts(spark, monkeypatch):
    from quillframe.plans import groups

    rows = awkward_turns() + [(99, t, "assistant" if t % 2 else "user", f"turn {t} </turn>") for t in range(40)]
    df = spark.createDataFrame(rows, TURN_SCHEMA)
    whole = {r["conv_id"]: r["text"] for r in chat.format_conversations(df).collect()}
    monkeypatch.setattr(groups, "LARGEST_PLAIN_GROUP", 8)
    formatted = chat.format_conversations(df, segment_turns=7)
    parts = formatted.collect()
    assert Counter(r["conv_id"] for r in parts)[99] == 6 and max(r["parts"] for r in parts) == 6
    joined = defaultdict(str)
    for r in sorted(parts, key=lambda r: r["piece"]):
        joined[r["conv_id"]] += r["text"]
    assert dict(joined) == whole
    assert digests(chat.read_back(formatted)) == plain_digests(rows)
    frame = "<{{ name }}>{% for m in messages %}{% set a = loop.index %}{{ a }}{{ '' if loop.last else ',' }}{% endfor %}<{{ name }}>"
    parts = chat.format_conversations(df.filter("conv_id = 99"), frame, segment_turns=7, name="x").orderBy("piece").collect()
    assert "".join(r["text"] for r in parts) == "<x>" + ",".join(map(str, range(1, 41))) + "<x>"
    # A template that looks at messages twice takes them whole.
    twice = "{{ messages | length }}{% for m in messages %}{{ messages[-1].turn }}{% endfor %}"
    (row,) = chat.format_conversations(df.filter("conv_id = 99"), twice, segment_turns=7).collect()
    assert row["text"] == "40" + "39" * 40


def test_spans_lie_on_what_the_model_says(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "<turn> yo"), (1, 2, "assistant", "")], TURN_SCHEMA)
    (row,) = chat.format_conversations(df).collect()
    assert [row["text"][s["start"] : s["start"] + s["length"]] for s in row["generated"]] == ["\\<turn> yo"]
    with pytest.raises(TemplateError):
        chat.format_conversations(df, "{% for m in messages %}")


def test_chat_query_equals_its_twin(spark, folder):
    assert differences(QUERIES["op12_chat_format"](spark, folder), duck(folder), ORACLES["op12_chat_format"]) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb\\"]), st.text(alphabet="\\</turn>a\n", max_size=20)), min_size=1, max_size=4))
def test_escapes_are_reversible(turns):
    template = Template(chat.TEMPLATE, chat.FILTERS)
    text, spans = template.render(messages=[{"role": r, "content": t} for r, t in turns])
    reader = chat.Reader()
    reader.feed(text, spans)
    (want,) = plain_digests([(0, i, r, t) for i, (r, t) in enumerate(turns)]).values()
    assert reader.digest()[:4] == want


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("a{# b #}c", "ac"),
        ("{{ 1 + 2 * 3 - 4 // 2 % 3 }}", "5"),
        ("{{ -x + 1 }}{{ 'a' ~ x }}", "-4a5"),
        ("{{ 'b' in t }}{{ 'z' not in t }}{{ 3 in [1, 2] }}", "truetruefalse"),
        ("{{ t | upper | replace('B', \"-\") }}{{ n | default('?') }}{{ y | default('?') }}", "A-C??"),
        ("{{ d.k }}{{ d['k'] }}{{ d.z is defined }}{{ d.k is not defined }}", "vvfalsefalse"),
        ("{% if x == 5 and not y %}1{% elif x %}2{% else %}3{% endif %}", "1"),
        ("{% if false %}1{% elif x > 7 %}2{% else %}3{% endif %}", "3"),
        ("{% for i in l %}{{ loop.index }}{{ loop.first }}{{ i }}{% endfor %}", "1true72false8"),
        ("{% for i in [] %}x{% else %}none{% endfor %}", "none"),
        ("a  {%- if true -%}  b  {%- endif -%}  c", "abc"),
        ("{% set q = 'it\\'s' %}{{ q }}{{ 'p' if q else 'r' }}{{ l | length }}{{ l | join('+') }}", "it'sp27+8"),
        ("{{ messages[0].role }}{% for m in messages %}{{ m.role }}{% endfor %}", "rrs"),
        ("{{ 'a\\n' * 2 }}{{ t[0] }}{{ [1, 2][1] }}", "a\na\na2"),
    ],
)
def test_templates(source, want):
    names = {"x": 5, "t": "abc", "n": None, "d": {"k": "v"}, "l": [7, 8]}
    assert Template(source).render(messages=Turns([{"role": "r"}, {"role": "s"}]), **names)[0] == want


@pytest.mark.parametrize(
    "source",
    ["{% if x %}", "{% endif %}", "{% else %}", "{{ x", "{{ }}", "{{ 'a }}", "{{ x | nope }}", "{{ x() }}", "{% while x %}", "{% for i in l %}{% elif x %}{% endfor %}",
     "{% if x %}{% else %}{% else %}{% endif %}", "{% if x %}{% else %}{% elif x %}{% endif %}", "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}",
     "{{ " + "(" * 100 + "1" + ")" * 100 + " }}", "{{ 99999999999999999999 }}", "{% set x %}", "{{ a b }}", "{% for if in l %}{% endfor %}"],
)
def test_bad_templates(source):
    if source == "{{ x":
        assert Template(source).render()[0] == source  # an opening mark alone is text
        return
    with pytest.raises(TemplateError):
        Template(source)


@pytest.mark.parametrize(
    "source",
    ["{{ t.__class__.__mro__ }}", "{{ t.upper }}", "{{ d.items }}", "{{ f.__globals__ }}", "{{ n }}", "{{ l }}", "{{ 1 // 0 }}", "{{ 'a' * 2000000000 }}", "{{ 4611686018427387903 * 2 }}",
     "{{ t + 1 }}", "{{ t < 1 }}", "{% for c in t %}{{ c }}{% endfor %}", "{% for c in d %}x{% endfor %}", "{{ 1 in 2 }}",
     "{% set a = 'aaaaaaaaaaaaaaaa' %}" + "{% set a = a ~ a %}" * 30, "{% set a = [1] %}" + "{% set a = a + a %}" * 30, "{{ n.x }}"],
)
def test_sandbox(source):
    with pytest.raises(TemplateError):
        Template(source).render(t="abc", d={"k": "v"}, f=len, n=None, l=[1])


def test_constants_are_folded():
    source = "{% set unused = 1 %}a{{ 'b' ~ 1 + 1 }}{% if 1 < 2 %}c{% else %}{{ x }}{% endif %}{% generation %}d{{ 'e' | upper }}{% endgeneration %}{{ 1 // 0 if false else 'f' }}"
    tree = Template(source).tree
    assert [(n.kind, n.parts[:2]) for n in tree.parts[1:]] == [("text", ("ab2c", False)), ("text", ("dE", True)), ("text", ("f", False))]
    assert Template(source).render() == ("ab2cdEf", [(4, 2)])
    with pytest.raises(TemplateError):
        Template("{{ 1 // 0 }}").render()  # found when reached, not when compiled


def test_messages_are_read_once_only():
    with pytest.raises(TemplateError):
        Template("{% for m in messages %}{% endfor %}{% for m in messages %}{% endfor %}").render(messages=Turns([{}]))


# Spelling variants ----------------------------------------------------------------------------


def plain_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain_groups(vocabulary):
    near = {w: [v for v in vocabulary if one_apart(w, v)] for w in vocabulary}
    form = {}
    for w, n in vocabulary.items():
        best = min(near[w], key=lambda v: (-vocabulary[v], v), default=None)
        form[w] = best if best is not None and vocabulary[best] >= 10 * n else None
    out = {}
    for w, n in vocabulary.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (w, form[w], root, n, len(near[w]), vocabulary[form[w]] if form[w] else None)
    return out


def variants(df):
    return {r["word"]: tuple(r) for r in df.collect()}


def misspelt(seed, words=60, letters="abé"):
    """Few letters, so many words are near, halves are shared and runs repeat letters."""
    rng = random.Random(seed)
    vocabulary = {}
    for _ in range(words):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(1, 10)))
        for _ in range(6):
            vocabulary[word] = rng.choice([2, 2, 3, 25, 30, 300, 4000])
            at = rng.randint(0, len(word))
            word = rng.choice([word[:at] + rng.choice(letters + "zĀ") + word[at:], word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at + 1 :]]) or "a"
    return vocabulary


@pytest.mark.parametrize(("seed", "shard_words"), [(1, 150_000), (2, 40), (3, 5), (4, 1)])
def test_variants_equal_brute_force(spark, seed, shard_words):
    vocabulary = misspelt(seed)
    df = spark.createDataFrame(list(vocabulary.items()), "word string, n long")
    assert variants(spelling.spelling_groups(df, shard_words=shard_words)) == plain_groups(vocabulary)


def test_words_of_awkward_texts(spark, edge, nothing):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    long = "ab" * 3000
    more = [(i, f"Straßenbahn strassenbahn STRAßENBAHN straßenbahnen {long} {long}x Ünterwegs×÷ {'qwertzu ' * (1 + 12 * (i % 2))}") for i in range(60, 100)]
    df = edge.unionByName(spark.createDataFrame([(i, t, None, None) for i, t in more], "doc_id long, text string, lang string, source string"), allowMissingColumns=True)
    df = df.withColumns({c: F.lit("x") for c in ("word", "n", "form", "root", "run")})
    assert variants(spelling.variants_of_texts(df)) == plain_groups(plain_words(rows + more))
    assert spelling.variants_of_texts(nothing).count() == 0
    none = spark.createDataFrame([(None, 3), ("", 4), ("alone", 5)], "word string, n long")
    assert variants(spelling.spelling_groups(none)) == {"alone": ("alone", None, "alone", 5, 0, None)}


def test_spelling_query_equals_brute_force(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    words = plain_words(rows)
    got = variants(QUERIES["op13_spelling_variants"](spark, folder))
    assert {w: r[3] for w, r in got.items()} == words
    near = defaultdict(set)
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + "*" + w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in words:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    assert {w: r[4] for w, r in got.items()} == {w: len(near[w]) for w in words}
    for w, (_, form, root, n, _, form_n) in got.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        assert form == (best if best and words[best] >= 10 * n else None) and form_n == words.get(form)
        assert root == (w if form is None else got[form][2])


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text(alphabet="abc", min_size=1, max_size=7), min_size=1, max_size=30), st.sets(st.text(alphabet="abcd", min_size=1, max_size=7), min_size=1, max_size=10))
def test_index_finds_every_near_word_once(words, asked):
    words, asked = sorted(words), sorted(asked)
    index = spelling.WordIndex(words)
    for exact in (0, 1, 3):
        kept = [w for w in asked if len(w) >= exact]
        if not kept:
            continue
        q, w = index.near(kept, np.full(len(kept), exact))
        got = sorted((kept[i], words[j]) for i, j in zip(q, w))
        ends = lambda a, b: not exact or b.endswith(a[len(a) - exact :]) and one_apart(a[: len(a) - exact], b[: len(b) - exact])
        want = sorted((a, b) for a in kept for b in words if len(b) >= len(a) and one_apart(a, b) and ends(a, b))
        assert got == want


# Pipeline stages ------------------------------------------------------------------------------


def test_mixing_stage_keeps_the_weights_of_rows_without_id(spark, folder):
    import corpus_pipeline

    rows = [(None, " ".join(["word"] * (1 + (i * 7 + s) % 9)), "en", source, 5) for s, source in enumerate("abc") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("row", F.lit("x"))
    out = corpus_pipeline.mixing(spark, docs, folder)
    assert out.columns == docs.columns
    words = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    sizes = {s: sum(len(r[1].split()) for r in rows if r[3] == s) for s in "abc"}
    total = sum(sizes.values())
    # Weights 5, 2 and 1 share all words; no target is above three times its source.
    assert abs(words["a"] - total * 5 / 8) <= 10 and abs(words["b"] - total * 2 / 8) <= 10 and abs(words["c"] - total / 8) <= 10
    assert corpus_pipeline.mixing(spark, docs.limit(0), folder).count() == 0


def test_line_dedup_stage_on_every_kind_of_white_space(spark, folder):
    import corpus_pipeline

    passage = [f"passage{i}" for i in range(55)]
    first = " ".join(passage)
    again = "own start " + "".join(w + "\t\n\x0b\x0c\r "[i % 6] for i, w in enumerate(passage)) + "own end"
    docs = spark.createDataFrame([(1, first, 9), (2, again, 9), (3, first, 9), (4, "  ", 9)], "doc_id long, text string, n_chars long")
    out = {r["doc_id"]: r["text"].split() for r in corpus_pipeline.line_dedup(spark, docs, folder).collect()}
    assert out[1] == passage and 3 not in out and out[4] == []
    assert not set(out[2]) & set(passage[4:-4]) and out[2][:2] == ["own", "start"] and out[2][-2:] == ["own", "end"]
