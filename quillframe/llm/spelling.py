"""Spelling variants: words one insertion, deletion or replacement apart, found with FM-indexes.

Of two near words the shorter one (either, at equal length) has an error-free half: its first
half begins the other word, or its second half ends it. Words are dealt out by these halves, once
from each end, so near words always meet in a shard. A shard indexes its words and runs the two
search schemes of the bidirectional index: from the left end the first half exactly and then the
second with one error, from the right end the second half exactly and then the first with one
error. A scheme that starts at a word's end moves in one direction only, so a shard dealt from the
left holds the index of the reversed words, and one dealt from the right that of the words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut_lineage, text_or_empty

# Letters of a word: fixed values of the contract.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 7
MIN_COUNT = 2
# A word is a variant of a near one that occurs so many times as often.
RATIO = 10
# Words that one shard indexes, about; the words of one half are cut into tiles beyond it.
SHARD_WORDS = 150_000
# Words searched for together.
BLOCK = 20_000

_FOUND = "word string, n_near long, near_n long, near string"


class WordIndex:
    """FM-index of distinct words in code-point order, delimited: ``last$first$second$...``.

    Read as a circle, the suffixes that begin with a delimiter sort like the words after them,
    so a suffix rank below the number of words is a word. Ranks of symbol ``c`` before place
    ``i`` come from one search in the ascending keys (symbol, place) of the transform.
    """

    def __init__(self, words: list[str]) -> None:
        self.size = len(words)
        around = [words[-1], *words[:-1]]
        points = np.frombuffer(("\0".join(around) + "\0").encode("utf-32-le"), np.uint32)
        self.points, symbols = np.unique(points, return_inverse=True)  # the delimiter is symbol 0
        self.sigma, n = len(self.points), len(points)
        order = _suffixes(symbols.astype(np.int64), max(map(len, words)) + 1)
        self.last = symbols[order - 1]  # the symbol before each suffix
        self.length = n
        self.keys = np.sort(self.last.astype(np.int64) * n + np.arange(n))

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-rank intervals of the patterns with ``symbol`` put before them."""
        first = symbol.astype(np.int64) * self.length
        return np.searchsorted(self.keys, first + low), np.searchsorted(self.keys, first + high)

    def before(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each interval the distinct letters before its suffixes: interval number, letter,
        and the intervals that they lead to."""
        size = high - low
        wide = np.flatnonzero(size > self.sigma)
        letters = np.arange(1, self.sigma)
        of = [np.repeat(wide, len(letters))]
        symbol = [np.tile(letters, len(wide))]
        slim = np.flatnonzero(size <= self.sigma)
        if len(slim):
            owner = np.repeat(slim, size[slim])
            place = np.arange(len(owner)) - np.repeat(np.cumsum(size[slim]) - size[slim], size[slim]) + low[owner]
            seen = np.unique(owner * self.sigma + self.last[place])
            seen = seen[seen % self.sigma > 0]
            of.append(seen // self.sigma)
            symbol.append(seen % self.sigma)
        of, symbol = np.concatenate(of), np.concatenate(symbol)
        down, up = self.step(symbol, low[of], high[of])
        some = up > down
        return of[some], symbol[some], down[some], up[some]

    def near(self, words: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (word asked for, word of the index) that differ by one replacement, or by one
        letter that only the index's word has, and agree in the last ``exact`` letters of the
        word asked for. Each pair once."""
        lengths = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbols = np.searchsorted(self.points, points)
        # A letter that no word of the index has never matches, but may be replaced.
        known = self.points[np.minimum(symbols, self.sigma - 1)] == points
        symbols = np.where(known, symbols, self.sigma)
        ends = np.cumsum(lengths)
        letter = lambda q, left: symbols[ends[q] - lengths[q] + left - 1]  # noqa: E731  last of the left letters

        asks = np.arange(len(words))
        left = lengths.copy()  # letters not yet matched
        low, high = np.zeros(len(words), np.int64), np.full(len(words), self.size, np.int64)
        found_q, found_w = [], []
        # States: without error (asks, left, low, high); with it (q, rest, down, up).
        q = rest = down = up = np.zeros(0, np.int64)
        while len(asks) or len(q):
            may = left <= lengths[asks] - exact[asks]  # inside the other half
            at = np.flatnonzero(may)
            of, symbol, new_down, new_up = self.before(low[at], high[at])
            own, remaining = asks[at[of]], left[at[of]]
            following = np.where(remaining > 0, letter(own, np.maximum(remaining, 1)), -1)
            other = symbol != following  # one more of the same letter counts where the run begins
            replaced = other & (remaining > 0)
            q = np.concatenate([q, own[other], own[replaced]])
            rest = np.concatenate([rest, remaining[other], remaining[replaced] - 1])
            down = np.concatenate([down, new_down[other], new_down[replaced]])
            up = np.concatenate([up, new_up[other], new_up[replaced]])

            whole = rest == 0
            if whole.any():  # the delimiter before it makes the match a whole word
                first, after = self.step(np.zeros(whole.sum(), np.int64), down[whole], up[whole])
                hit = after > first
                found_q.append(q[whole][hit])
                found_w.append(first[hit])
            q, rest, down, up = q[~whole], rest[~whole], down[~whole], up[~whole]
            down, up = self.step(letter(q, rest), down, up)
            rest = rest - 1
            some = up > down
            q, rest, down, up = q[some], rest[some], down[some], up[some]

            asks, left, low, high = asks[left > 0], left[left > 0], low[left > 0], high[left > 0]
            low, high = self.step(letter(asks, left), low, high)
            some = high > low
            asks, left, low, high = asks[some], left[some] - 1, low[some], high[some]
        if not found_q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_q), np.concatenate(found_w)


def _suffixes(symbols: np.ndarray, reach: int) -> np.ndarray:
    """Starts of the circle's suffixes, sorted by their first ``reach`` symbols, then by start."""
    n = len(symbols)
    width = max(1, int(symbols.max()).bit_length())
    held = max(1, 62 // width)
    key = np.zeros(n, np.int64)
    for k in range(held):  # as many symbols as a number holds
        key = (key << width) | np.roll(symbols, -k)
    while True:
        order = np.argsort(key, kind="stable")
        if held >= reach:
            return order
        ascending = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ascending[1:] != ascending[:-1])])
        key = rank * n + np.roll(rank, -held)
        held *= 2


def _group(words: np.ndarray, counts: np.ndarray, by: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
    """Of each word in ``by``: how many near ones and the most frequent, smallest first at ties."""
    order = np.lexsort((near, -counts[near], by))
    by, near = by[order], near[order]
    first = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]])) if len(by) else by
    n = np.diff(np.append(first, len(by)))
    return pa.RecordBatch.from_arrays(
        [pa.array(words[by[first]], pa.string()), pa.array(n, pa.int64()), pa.array(counts[near[first]], pa.int64()), pa.array(words[near[first]], pa.string())],
        names=["word", "n_near", "near_n", "near"],
    )


def _search_shard(table: pa.Table) -> pa.Table:
    """Near words in a shard; every pair is reported from both sides."""
    backwards = table["end"][0].as_py() == 0
    texts = np.array(table["word"].to_pylist(), object)
    n, tile, tiles, hash_ = (table[c].to_numpy() for c in ("n", "tile", "tiles", "spread"))
    asks, indexed = table["asks"].to_numpy(zero_copy_only=False), table["indexed"].to_numpy(zero_copy_only=False)
    # A word may be there under several halves: once in the index, and once as a question a tile.
    words, place = np.unique(texts, return_inverse=True)
    counts, spread, in_index = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.zeros(len(words), bool)
    counts[place], spread[place] = n, hash_
    in_index[place[indexed]] = True
    if not in_index.any() or not asks.any():
        return _schema().empty_table()
    shown = [w[::-1] for w in words] if backwards else list(words)
    own = np.flatnonzero(in_index)
    own = own[np.argsort(np.array([shown[i] for i in own], object), kind="stable")]
    index = WordIndex([shown[i] for i in own])
    out = []
    rows = np.flatnonzero(asks)
    rows = rows[np.argsort([len(words[place[r]]) for r in rows], kind="stable")]
    for start in range(0, len(rows), BLOCK):
        block = rows[start : start + BLOCK]
        who = place[block]
        lengths = np.array([len(words[i]) for i in who], np.int64)
        half = lengths // 2
        asked, met = index.near([shown[i] for i in who], half if backwards else lengths - half)
        row, a, b = block[asked], who[asked], own[met]
        keep = spread[b] % tiles[row] == tile[row]  # of other tiles' words, those under another half
        if not backwards:  # pairs whose first half agrees belong to the shards dealt from the left
            h = half[asked]
            keep &= np.array([words[x][:k] != words[y][:k] for x, y, k in zip(a, b, h)], bool) if len(a) else keep
        a, b = a[keep], b[keep]
        # At equal length both words ask, each for itself.
        longer = np.array([len(words[y]) > len(words[x]) for x, y in zip(a, b)], bool) if len(a) else np.zeros(0, bool)
        out.append(_group(words, counts, np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]])))
    return pa.Table.from_batches(out, _schema())


def _schema() -> pa.Schema:
    return pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])


def _dealt(vocabulary: DataFrame, shard_words: int) -> DataFrame:
    """Each word under the halves by which near words meet it, with the shard it goes to.

    A question of length L looks for words of length L and L + 1, so a word is indexed under the
    halves of its own length and of one less. A half that very many words share has several
    tiles: its words are spread over them and its questions go to each.
    """
    length = F.char_length("word")
    classes = F.array(F.struct(length.alias("length"), F.lit(True).alias("asks")), F.struct((length - 1).alias("length"), F.lit(False).alias("asks")))
    rows = vocabulary.select("word", "n", F.explode(classes).alias("class")).select("word", "n", "class.length", "class.asks")
    rows = rows.filter(F.col("length") > 0)
    half = F.floor(F.col("length") / 2).cast("int")
    ends = F.array(
        F.struct(F.lit(0).alias("end"), F.substring(F.col("word"), F.lit(1), half).alias("half")),
        F.struct(F.lit(1).alias("end"), F.substring(F.col("word"), F.char_length("word") - (F.col("length") - half) + 1, F.col("length") - half).alias("half")),
    )
    rows = rows.select("word", "n", "length", "asks", F.explode(ends).alias("by")).select("word", "n", "length", "asks", "by.end", "by.half")
    key = ["end", "length", "half"]
    spread = F.xxhash64("word").bitwiseAND(F.lit((1 << 62) - 1))
    hot = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("shared")).filter(F.col("shared") > shard_words)
    tiles = hot.select(*key, F.ceil(F.col("shared") / shard_words).alias("tiles"))
    rows = rows.join(tiles, key, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)).cast("long")).withColumn("spread", spread)
    home = F.pmod("spread", "tiles")
    # One row a tile for questions; in its home tile a word is indexed as well.
    rows = rows.withColumn("tile", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).otherwise(F.array(home))))
    return rows.withColumn("indexed", F.col("tile") == home)


def near_words(vocabulary: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Rows (word, n_near, near_n, near) of the words that have near words: how many, and the one
    of largest ``n``, the smallest in code-point order of several.

    ``vocabulary`` has one row a word: ``word`` and how often it occurs, ``n``.
    """
    dealt = _dealt(vocabulary, shard_words)
    # Four rows a word, if no half has tiles.
    shards = max(1, -(-4 * vocabulary.count() // shard_words))
    shard = F.pmod(F.xxhash64("end", "length", "half", "tile"), F.lit(shards))
    placed = dealt.select("end", shard.alias("shard"), "word", "n", "asks", "indexed", "tile", "tiles", "spread")
    found = placed.groupBy("end", "shard").applyInArrow(_search_shard, _FOUND)
    best = F.min(F.struct((-F.col("near_n")).alias("most"), "near")).alias("best")
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return summed.select("word", "n_near", (-F.col("best.most")).alias("near_n"), F.col("best.near").alias("near"))


def _roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root): the end of each word's chain of forms.

    Every form occurs more often than its word, so chains end; their length is halved in each step.
    """
    roots = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if roots.join(further, "root", "left_semi").isEmpty():
            return roots
        roots = cut_lineage(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")))


def spelling_groups(vocabulary: DataFrame, ratio: int = RATIO, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Each word with its form and root: word, form, root, n, n_near, form_n.

    ``vocabulary`` has one row a word (``word`` string, ``n`` long). Two words are near if they
    differ by exactly one inserted, deleted or replaced code point. A word's form is its near word
    of largest n, the smallest at ties, if that n is at least ``ratio`` times its own. The root
    follows forms to the last. Null and empty words take no part; no words give no rows.
    """
    if ratio < 2:
        raise ValueError("a form must occur more often than its word")
    vocabulary = cut_lineage(vocabulary.select("word", F.col("n").cast("long").alias("n")).filter("word <> ''"))
    found = vocabulary.join(near_words(vocabulary, shard_words), "word", "left")
    enough = F.col("near_n") >= ratio * F.col("n")
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("near")).alias("form"),
        F.when(enough, F.col("near_n")).alias("form_n"),
    )
    found = cut_lineage(found)
    roots = _roots(found.filter("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def counted_words(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    slip: int = 31,
) -> DataFrame:
    """Rows (word, n) of the words of all texts with at least ``min_length`` code points and
    ``min_count`` occurrences.

    A word is a longest run of letters with A-Z lower-cased. Where ``slip`` divides the crc32 of
    ``id:run`` the code point at crc32 modulo length is left out, a planted slip of the pen (0
    plants none). A null text has no words; a null id counts as empty; repeated rows count each.
    Runs shorter than ``min_length`` never get longer, so they are not taken at all.
    """
    runs = F.regexp_extract_all(F.col(f"`{text_col}`").cast("string"), F.lit(f"[{LETTERS}]{{{max(1, min_length)},}}"), F.lit(0))
    rows = df.select(text_or_empty(id_col).alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    word: Column = F.col("run")
    if slip:
        drawn = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        rows = rows.withColumn("drawn", drawn)
        at = F.pmod(F.col("drawn"), F.char_length("run")).cast("int")
        cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
        word = F.when(F.col("drawn") % slip == 0, cut).otherwise(F.col("run"))
    rows = rows.select(word.alias("word")).filter(F.char_length("word") >= min_length)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def variants_of_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """:func:`spelling_groups` over :func:`counted_words` of a table of texts."""
    return spelling_groups(counted_words(df, id_col, text_col), shard_words=shard_words)
