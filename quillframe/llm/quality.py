"""Quality classifier: heuristic labellers, a label model fitted by EM, and a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage, fresh, text_or_empty
from .words import chunks, hash_spans, mix, running_hash, runs

# Rows that the scorer, and labelled rows that the lexicons, are fitted on, at most.
SAMPLE_ROWS = 10_000
# Text looked at together: a view of it takes many times its bytes.
VIEW_BYTES = 500_000
THRESHOLD = 0.5
SEED = 11
_PLACES = (1 << 63) - 1

# Insults, and common short words of four languages.
INSULTS = (
    "asshole bastard bitch clown coward cretin degenerate disgusting dumbass fool freak fucking garbage idiot idiotic "
    "imbecile jerk loser losers moron moronic parasite pathetic pig retard scum scumbag shit stupid subhuman trash "
    "vermin whore worthless wretch"
).split()
COMMON = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au de des du elle en est et il la le les ne par pas pour que qui se sur un une "
    "als das dem den der des die ein eine ist mit nicht sich und von zu auf im "
    "como con del el ella es las lo los no para por su una y"
).split()

_ASCII = np.arange(256)
_LETTER = ((_ASCII | 32) >= 97) & ((_ASCII | 32) <= 122) | (_ASCII >= 128)
_UPPER = (_ASCII >= 65) & (_ASCII <= 90)
_DIGIT = (_ASCII >= 48) & (_ASCII <= 57)
_BLANK = (_ASCII == 32) | ((_ASCII >= 9) & (_ASCII <= 13))
_PLAIN = np.isin(_ASCII, [ord(c) for c in ".,;:'\"-()?"])
_SYMBOL = ~(_LETTER | _DIGIT | _BLANK | _PLAIN)
_STOP = np.isin(_ASCII, [ord(c) for c in ".?!"])

WORD, SHAPE = np.uint64(0), np.uint64(1)
PREFIXES = {4: np.uint64(2), 5: np.uint64(3), 6: np.uint64(4)}  # first bytes of a word


def _feature(kind: np.uint64, h: np.ndarray) -> np.ndarray:
    """A feature: its kind, then 32 bits of a hash of kind and value."""
    return (kind << np.uint64(32)) | (mix(np.asarray(h, np.uint64) ^ (kind << np.uint64(60))) >> np.uint64(32))


def _hash_list(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, stops, _ = runs(data, np.array([len(data)]))
    return np.sort(hash_spans(running_hash(data), starts, stops))


_INSULTS, _COMMON = _hash_list(INSULTS), _hash_list(COMMON)


def _among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


# ---------------------------------------------------------------- what labellers and scorer see

# Shape labellers: (measure, bad from, good up to); between the two a labeller abstains.
SHAPES = {
    "symbols": (0.03, 0.015),
    "shouting": (0.4, 0.15),
    "stutter": (0.25, 0.1),
    "monotony": (0.3, 0.1),
    "run_on": (80.0, 40.0),
    "cut_up": (0.5, 0.3),
    "foreign": (0.97, 0.9),
    "bare_marks": (0.1, 0.05),
}
# Toxicity labellers: insults by list, then what labelled rows show, by word and by beginnings.
TOXIC = ("insults", "toxic_words", "toxic_4", "toxic_5", "toxic_6")
# A learned labeller calls a text toxic from this sum of log ratios on.
TOXIC_FROM = 5.0
BAD, ABSTAIN, GOOD = 0, 1, 2


class _View:
    """Measures and distinct features of a chunk of texts."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        n = len(ends)
        firsts = np.concatenate([[0], ends])[:-1]
        total = lambda mask: (np.concatenate([[0], np.cumsum(mask[data])])[np.stack([ends, firsts])] * [[1], [-1]]).sum(axis=0)
        share = lambda a, b: a / np.maximum(b, 1)
        summed = running_hash(data) if len(data) else np.zeros(0, np.uint64)

        starts, stops, self.words = runs(data, ends)
        of = np.repeat(np.arange(n), self.words)
        h = hash_spans(summed, starts, stops) if len(starts) else np.zeros(0, np.uint64)
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
        order = np.lexsort((h, of))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (of[order][1:] != of[order][:-1])
        distinct = np.bincount(of[order][new], minlength=n)
        per_text = lambda mask: np.bincount(of[mask], minlength=n)
        lettered = np.concatenate([[0], np.cumsum(_LETTER[data] | _DIGIT[data])]) if len(data) else np.zeros(1, np.int64)
        bare = (lettered[stops + 1] - lettered[starts]) == 0 if len(starts) else np.zeros(0, bool)

        first, last, self.tokens = runs(data, ends, ~_LETTER)
        text = np.repeat(np.arange(n), self.tokens)
        word = hash_spans(summed, first, last) if len(first) else np.zeros(0, np.uint64)
        common = np.bincount(text[_among(word, _COMMON)], minlength=n)
        self.insults = np.bincount(text[_among(word, _INSULTS)], minlength=n)
        letters = total(_LETTER & (_ASCII < 128))
        # A long text repeats its words by nature: what is expected grows with a power of its length.
        expected = np.maximum(self.words, 1) ** 0.75
        self.measures = np.stack(
            [
                share(total(_SYMBOL), total(~_BLANK)),
                share(total(_UPPER), letters),
                share(per_text(again), self.words),
                1 - np.minimum(1, distinct / expected),
                share(self.words, total(_STOP)),
                share(total(_STOP), self.words),
                1 - share(common, self.tokens),
                share(per_text(bare), self.words),
            ]
        )
        self.measures[:, self.words == 0] = 0
        kinds = [_feature(WORD, word)]
        for size, kind in PREFIXES.items():
            long = last - first + 1 >= size
            p = hash_spans(summed, first, np.minimum(last, first + size - 1)) if len(first) else word
            kinds.append(np.where(long, _feature(kind, p), kinds[0]))
        bins = np.floor(np.minimum(self.measures, 100) * np.array([40, 10, 20, 10, 0.1, 10, 20, 20])[:, None]).astype(np.uint64)
        shape = [_feature(SHAPE, bins[k] + np.uint64(1000 * (k + 1))) for k in range(len(SHAPES))]
        owner = np.concatenate([*[text] * len(kinds), *[np.arange(n)] * len(shape)])
        pairs = np.unique((owner.astype(np.uint64) << np.uint64(35)) | np.concatenate([*kinds, *shape]))
        self.features = pairs & np.uint64((1 << 35) - 1)
        self.counts = np.bincount((pairs >> np.uint64(35)).astype(np.int64), minlength=n)
        self.text_of = np.repeat(np.arange(n), self.counts)

    def toxic_votes(self, lexicons: list[Lexicon]) -> np.ndarray:
        return toxic_votes(self.insults, lexicons, lambda kind: (self.features, self.text_of))

    def shape_votes(self) -> np.ndarray:
        """Votes of the shape labellers, a column each; very short texts get none."""
        out = []
        for m, (bad, good) in zip(self.measures, SHAPES.values()):
            vote = np.where(m >= bad, BAD, np.where(m <= good, GOOD, ABSTAIN))
            out.append(np.where(self.words >= 8, vote, ABSTAIN))
        return np.stack(out, axis=1)


Lexicon = tuple[np.ndarray, np.ndarray]  # features, ascending, and their log ratios


def toxic_votes(insults: np.ndarray, lexicons: list[Lexicon], of_kind: Callable[[np.uint64], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Votes of the toxicity labellers; one without a lexicon abstains.

    ``of_kind`` gives the features of (at least) a kind, and the text of each.
    """
    votes = [np.where(insults > 0, BAD, GOOD)]
    for kind, (value, ratio) in zip((WORD, *PREFIXES.values()), lexicons):
        features, text_of = of_kind(kind)
        known = _among(features, value)
        sums = np.bincount(text_of[known], ratio[np.searchsorted(value, features[known])], minlength=len(insults))
        votes.append(np.where(sums >= TOXIC_FROM, BAD, GOOD) if len(value) else np.full(len(insults), ABSTAIN))
    return np.stack(votes, axis=1)


def _code(votes: np.ndarray) -> np.ndarray:
    """A row of votes as a number in base three."""
    return votes @ (3 ** np.arange(votes.shape[1]))


def _decode(code: np.ndarray, n: int) -> np.ndarray:
    return code[:, None] // 3 ** np.arange(n)[None, :] % 3


# ---------------------------------------------------------------- the label model


def fit_label_model(votes: np.ndarray, count: np.ndarray, steps: int = 200) -> np.ndarray:
    """P(bad) of each distinct row of votes, by expectation-maximisation.

    Labellers are independent given the class; each has a chance to call a good text bad and
    one to call a bad text bad, and an abstention says nothing. Faults come one at a time, so
    most labellers pass most bad texts: chances start at 0.05 and 30 in a hundred, and a prior of
    twice as much weight as the rows keeps false alarms near their start (a labeller that finds
    a fault of its own would else be taken for noise).
    """
    if not len(votes):
        return np.zeros(0)
    is_bad, is_good = (votes == BAD).astype(float), (votes == GOOD).astype(float)
    total = count.sum()
    alarm, found, prior = np.full(votes.shape[1], 0.0005), np.full(votes.shape[1], 0.3), 0.1
    bad = np.zeros(len(votes))
    for _ in range(steps):
        log = np.log(prior / (1 - prior)) + is_bad @ np.log(found / alarm) + is_good @ np.log((1 - found) / (1 - alarm))
        new = 1 / (1 + np.exp(-np.clip(log, -500, 500)))
        w_bad, w_good = new * count, (1 - new) * count
        prior = (w_bad.sum() + 1) / (total + 10)
        found = (w_bad @ is_bad + 0.3 * 10) / (w_bad @ (is_bad + is_good) + 10)
        alarm = (w_good @ is_bad + 0.0005 * 2 * total) / (w_good @ (is_bad + is_good) + 2 * total)
        if np.abs(new - bad).max() < 1e-9:
            break
        bad = new
    return bad


class LabelModel:
    """Two label models, of shape and of toxicity; a text is bad if either says so."""

    def __init__(self, patterns: list[tuple[int, int, int]]):
        self.tables = []
        for at, n in ((0, len(SHAPES)), (1, len(TOXIC))):
            sums: dict[int, int] = {}
            for row in patterns:
                sums[row[at]] = sums.get(row[at], 0) + row[2]
            code = np.array(sorted(sums), np.int64)
            bad = fit_label_model(_decode(code, n), np.array([sums[c] for c in code.tolist()], float))
            table = np.zeros(3**n)
            table[code] = bad
            self.tables.append(table)

    def bad(self, shape: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        return 1 - (1 - self.tables[0][shape]) * (1 - self.tables[1][toxic])


# ---------------------------------------------------------------- the scorer


class Features:
    """Features of sampled rows, given one kind at a time: all of them at once, sorted, take many times their bytes."""

    def __init__(self, column: pa.ChunkedArray | list[np.ndarray]):
        """Of each row, the bytes of its ascending features (or these themselves)."""
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []  # features of some rows laid end to end, and their edges
        self.rows = len(column)
        for part in column.chunks if isinstance(column, pa.ChunkedArray) else [pa.array([f.tobytes() for f in column], pa.binary())]:
            part = part.cast(pa.large_binary())
            edges = np.frombuffer(part.buffers()[1], np.int64, len(part) + 1, part.offset * 8) // 8 if len(part) else np.zeros(1, np.int64)
            if edges[-1] > edges[0]:
                flat = np.frombuffer(part.buffers()[2], np.uint64, edges[-1] - edges[0], edges[0] * 8)
            else:
                flat = np.zeros(0, np.uint64)
            self.parts.append((flat, edges - edges[0]))

    def of(self, kind: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the features of a kind, and the row of each; row by row, ascending in each."""
        numbers, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for flat, edges in self.parts:
            halves = flat.view(np.uint32).reshape(-1, 2)  # the hash, then the kind
            at = np.flatnonzero(halves[:, 1] == kind)
            numbers.append(halves[at, 0])
            counts.append(np.diff(np.searchsorted(at, edges)))
        return np.concatenate(numbers), np.repeat(np.arange(self.rows), np.concatenate(counts))


def _full(kind: np.uint64, number: np.ndarray) -> np.ndarray:
    return (kind << np.uint64(32)) | number.astype(np.uint64)


def fit_lexicons(features: Features, toxic: np.ndarray) -> list[Lexicon]:
    """Features that mark labelled toxic texts, by kind: words, and beginnings of each length."""
    yes, no = max(1, int((toxic == 1).sum())), max(1, int((toxic == 0).sum()))
    rate = yes / (yes + no)
    log = lambda n, of: n * np.log(np.maximum(n, 1e-300) / of)
    out = []
    for kind in (WORD, *PREFIXES.values()):
        number, row = features.of(kind)
        value, inverse = np.unique(number, return_inverse=True)
        hit, miss = (np.bincount(inverse[toxic[row] == t], minlength=len(value)) for t in (1, 0))
        ratio = np.log((hit + 0.5) / (yes + 1)) - np.log((miss + 0.5) / (no + 1))
        # Log odds against so many hits by chance: with so many features, rare ones are rarely proof.
        proof = log(hit, (hit + miss) * rate) + log(miss, (hit + miss) * (1 - rate))
        good = (ratio >= np.log(12)) & (proof >= 22)
        out.append((_full(kind, value[good]), ratio[good]))
    return out


def fit_scorer(
    features: Features, votes: np.ndarray, bad: np.ndarray, steps: int = 150, ridge: float = 0.3
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic weights of hashed features and of bad votes under soft labels.

    Features that tell nothing have no weight. Returns feature numbers (ascending), their
    weights, and the weights of the votes with the constant last.
    """
    n, total = max(1, len(bad)), float(bad.sum())
    rate = min(max(total / n, 1e-6), 1 - 1e-6)
    numbers, in_row, in_col, many = [], [], [], 0
    for kind in (WORD, SHAPE, *PREFIXES.values()):
        number, row = features.of(kind)
        value, inverse = np.unique(number, return_inverse=True)
        seen, with_bad = np.bincount(inverse, minlength=len(value)), np.bincount(inverse, bad[row], minlength=len(value))
        apart = (with_bad - seen * rate) ** 2 / (seen * rate * (1 - rate))
        use = np.flatnonzero((seen >= 3) & (apart > 15))
        place = np.full(len(value), -1)
        place[use] = np.arange(many, many + len(use))
        col = place[inverse]
        numbers.append(_full(kind, value[use]))
        in_row.append(row[col >= 0])
        in_col.append(col[col >= 0])
        many += len(use)
    rows, col = np.concatenate(in_row), np.concatenate(in_col)
    dense = np.column_stack([votes == BAD, np.ones(len(bad))]).astype(float)
    weight, plain = np.zeros(many), np.zeros(dense.shape[1])
    plain[-1] = np.log(rate / (1 - rate))
    square, square_plain = np.full(many, 1e-8), np.full(len(plain), 1e-8)
    for _ in range(steps):  # AdaGrad on the whole sample
        z = dense @ plain + np.bincount(rows, weight[col], minlength=len(bad))
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - bad
        step = np.bincount(col, error[rows], minlength=many) + ridge * weight
        square += step * step
        weight -= 0.5 * step / np.sqrt(square)
        step = error @ dense
        square_plain += step * step
        plain -= 0.5 * step / np.sqrt(square_plain)
    return np.concatenate(numbers), weight, plain


# ---------------------------------------------------------------- the jobs


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, data, ends in chunks(batch["text"], VIEW_BYTES):
            view = _View(data, ends)
            edges = np.cumsum(view.counts)[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].slice(at, to - at),
                    pa.array(_code(view.shape_votes())),
                    pa.array(view.insults),
                    pa.array([f.tobytes() for f in np.split(view.features, edges)], pa.binary()),
                ],
                names=["id", "shape", "insults", "features"],
            )


def _voted(lexicons: list[Lexicon]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, ends in chunks(batch["text"], VIEW_BYTES):
                view = _View(data, ends)
                toxic = _code(view.toxic_votes(lexicons))
                yield pa.RecordBatch.from_arrays([pa.array(_code(view.shape_votes())), pa.array(toxic)], names=["shape", "toxic"])

    return run


def _lexicon_task(table: pa.Table) -> pa.Table:
    found = fit_lexicons(Features(table["features"]), table["toxic"].to_numpy())
    values, ratios = ([x.tobytes() for x in column] for column in zip(*found))
    return pa.table({"value": pa.array(values, pa.binary()), "ratio": pa.array(ratios, pa.binary()), "at": pa.array(range(len(found)), pa.int32())})


def _scorer_task(model: LabelModel, lexicons: list[Lexicon]):
    def run(table: pa.Table) -> pa.Table:
        features, shape = Features(table["features"]), table["shape"].to_numpy()

        def of_kind(kind: np.uint64) -> tuple[np.ndarray, np.ndarray]:
            number, row = features.of(kind)
            return _full(kind, number), row

        toxic = toxic_votes(table["insults"].to_numpy(), lexicons, of_kind)
        votes = np.column_stack([_decode(shape, len(SHAPES)), toxic])
        fitted = fit_scorer(features, votes, model.bad(shape, _code(toxic)))
        return pa.table({n: [x.tobytes()] for n, x in zip(("number", "weight", "plain"), fitted)})

    return run


def _scored(
    model: LabelModel, lexicons: list[Lexicon], number: np.ndarray, weight: np.ndarray, plain: np.ndarray, names: list[str], text_at: int
):
    """Posterior and score of the text in that column; as many columns as have names beside these two are passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, ends in chunks(batch.column(text_at), VIEW_BYTES):
                view = _View(data, ends)
                shape, toxic = view.shape_votes(), view.toxic_votes(lexicons)
                known = _among(view.features, number)
                w = weight[np.searchsorted(number, view.features[known])]
                z = np.column_stack([np.column_stack([shape, toxic]) == BAD, np.ones(to - at)]) @ plain
                z += np.bincount(view.text_of[known], w, minlength=to - at)
                columns = [c.slice(at, to - at) for c in batch.columns[: len(names) - 2]]
                more = [pa.array(model.bad(_code(shape), _code(toxic))), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))]
                yield pa.RecordBatch.from_arrays(columns + more, names=names)

    return run


def _fewest(df: DataFrame, rows: int) -> DataFrame:
    """id and text of at most ``rows`` distinct rows, those with the smallest places."""
    distinct = df.groupBy("place").agg(F.first("id").alias("id"), F.first("text").alias("text"))
    kept = distinct.select("place").orderBy("place").limit(rows)
    return distinct.join(F.broadcast(kept), "place").select("id", "text")


def quality_scores(
    df: DataFrame,
    labels: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    threshold: float = THRESHOLD,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``df``: posterior and score of being bad, and whether it is kept.

    Labellers look at shape (SHAPES) and at toxicity (TOXIC). Of the latter, four use a
    lexicon of words and beginnings that mark the toxic ones among at most ``sample_rows`` rows
    with ``labels`` (id_col, toxic); without labels they abstain. The votes of all rows, as
    counts of distinct vote rows, go through EM (:func:`fit_label_model`); the posterior of at
    most ``sample_rows`` distinct rows, drawn by hash, trains the scorer, and the score of the
    whole text decides: kept where it is below ``threshold``.

    Returns ``id_col``, the columns named in ``carry``, posterior, score and kept (by a longer
    name where a carried column has that name). Null and
    very short texts get no shape votes and are kept unless they insult; null ids are scored
    like others but match no label; repeated rows count as often as they occur. An empty
    table gives an empty result.
    """
    text = text_or_empty(text_col).alias("text")
    ident = F.col(f"`{id_col}`").cast("bigint").alias("id")
    seen = "id long, shape long, insults long, features binary"
    share = min(1.0, 1.5 * sample_rows / max(1, df.count()))  # more than are wanted, so that enough are drawn
    place = F.xxhash64(F.lit(SEED), ident, text).alias("place")
    near = df.select(ident, text, place).filter(F.col("place").bitwiseAND(F.lit(_PLACES)) <= F.lit(min(_PLACES, int(_PLACES * share))))
    sample = cut_lineage(_fewest(near, sample_rows).mapInArrow(_sampled, seen))

    lexicons: list[Lexicon] = [(np.zeros(0, np.uint64), np.zeros(0))] * (len(TOXIC) - 1)
    if labels is not None:
        known = labels.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        known = known.filter("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic"))
        # The ids are bounded before the texts are looked up: their side of the join is small.
        drawn = known.withColumn("place", F.xxhash64(F.lit(SEED), "id")).orderBy("place", "id").limit(sample_rows).drop("place")
        labelled = df.select(ident, text, place).join(F.broadcast(drawn.select("id")), "id")
        labelled = _fewest(labelled, sample_rows).mapInArrow(_sampled, seen)
        marked = labelled.join(F.broadcast(drawn), "id").groupBy(F.lit(0).alias("all"))
        found = marked.applyInArrow(_lexicon_task, "value binary, ratio binary, at int").collect()
        if found:
            lexicons = [(np.frombuffer(r["value"], np.uint64), np.frombuffer(r["ratio"])) for r in sorted(found, key=lambda r: r["at"])]
    votes = df.select(text).mapInArrow(_voted(lexicons), "shape long, toxic long").groupBy("shape", "toxic").count()
    # At most one row per distinct row of votes: 3 ** labellers, however large the table.
    model = LabelModel([tuple(r) for r in votes.collect()])
    fitted = sample.groupBy(F.lit(0).alias("all")).applyInArrow(
        _scorer_task(model, lexicons), "number binary, weight binary, plain binary"
    ).first()
    number, weight, plain = np.zeros(0, np.uint64), np.zeros(0), np.array([*[0.0] * (len(SHAPES) + len(TOXIC)), -10.0])
    if fitted is not None:
        number, weight, plain = np.frombuffer(fitted["number"], np.uint64), np.frombuffer(fitted["weight"]), np.frombuffer(fitted["plain"])
    fields = {f.name: f.dataType.simpleString() for f in df.schema}
    extra = [c for c in carry if c != id_col]
    carried = df.select(*[F.col(f"`{c}`") for c in (id_col, *extra)])
    posterior, score, kept = fresh(carried, "posterior", "score", "kept")
    ddl = ", ".join([*[f"`{c}` {fields[c]}" for c in (id_col, *extra)], f"{posterior} double", f"{score} double"])
    # A carried text is not sent twice.
    text_at = carried.columns.index(text_col) if text_col in carried.columns and fields[text_col] == "string" else len(carried.columns)
    (last,) = fresh(df, "text")
    full = carried if text_at < len(carried.columns) else df.select(*[F.col(f"`{c}`") for c in carried.columns], text.alias(last))
    scored = _scored(model, lexicons, number, weight, plain, [*carried.columns, posterior, score], text_at)
    return full.mapInArrow(scored, ddl).withColumn(kept, F.col(score) < threshold)
