"""Deleting repeated passages, found by winnowing (DataFrame functions only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut_lineage, fresh, scratch_path, text_or_empty

# A passage of at least so many words is deleted where it repeats an earlier one.
MIN_WORDS = 50
# Where a passage ends so few words inside a line of which more stays, these words stay too.
RAGGED_WORDS = 4
# A token is a word with the white space before it.
TOKEN = r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"
# Values between two windows' outer words that are compared before all of them.
NEAR = 8
# A sieve of hashed keys has 2 to this power times 64 bits at most, however many keys there are.
SIEVE_BITS = 18


def _text_key(text: Column) -> Column:
    return F.xxhash64(text)


class _Shape:
    """The lengths that follow from that of a window."""

    def __init__(self, min_words: int):
        self.window = min_words
        self.span = max(1, min_words // 3)
        self.wide = min_words - self.span  # windows reach so far beyond an anchor on either side
        self.half = (self.wide + 1) // 2  # and so far to the left, or ``rest`` to the right
        self.rest = self.wide - self.half + 1


def _clip(at: Column, before: int) -> Column:
    return F.greatest(at - before, F.lit(0))


def _hashed(texts: DataFrame) -> DataFrame:
    """With ``h``, the hashes of a text's words, and their number instead of the text."""
    # A pattern of one plain character is split without a regular expression, and looking for a
    # character takes much less time than replacing it.
    rare, text = "\t\x0b\x0c\r", F.col("text")
    some = reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in rare])
    text = F.when(some, reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), rare, text)).otherwise(text)
    words = F.array_remove(F.split(F.array_join(F.split(text, "\n"), " "), " "), "")
    return texts.withColumn("h", F.transform(words, lambda w: F.xxhash64(w))).drop("text").withColumn("n", F.size("h"))


def _span(start: Column, length: Column | int) -> Column:
    """The hash of ``length`` words from ``start`` on."""
    return F.xxhash64(F.slice("h", start + 1, length))


# Only hashing words runs a function per word. Arrays are exploded before anything else is taken from
# them, as slices and hashes outside of such functions are compiled; an inner explode would have its
# array computed once more by a filter for empty ones.


def _anchors(texts: DataFrame, shape: _Shape) -> DataFrame:
    """Anchors of each text's windows, with their hash, that of their context and those of its halves."""
    final, j, at = F.col("n") - shape.window, F.col("j"), F.col("at")
    rows = _hashed(texts).withColumn("j", F.explode_outer(F.when(final >= 0, F.sequence(F.lit(0), final))))
    # A window's anchor is another one than that of the window before if that has left the window or
    # a lower one has come. The least value between them is named once, or it would be computed twice.
    both = F.array_min(F.slice("h", j + 1, shape.wide))
    outer = F.least(F.get("h", j - 1), F.try_add(F.get("h", j + shape.wide), F.lit(1)))
    moved = F.coalesce(both >= outer, F.lit(True))
    if shape.wide > NEAR:  # a few of these values rule most windows out
        moved = (F.least(*[F.get("h", j + k) for k in range(NEAR)]) >= outer) & moved
    rows = rows.filter((j == 0) | (j > 0) & moved)
    places = F.slice("h", j + 1, shape.wide + 1)
    rows = rows.withColumn("at", (j + F.array_position(places, F.array_min(places)) - 1).cast("int"))
    # The parts of a context are hashed each on its own, so no word is hashed twice.
    near, far = _clip(at, shape.half), _clip(at, shape.wide)
    end, beyond = (F.least(at + shape.span + k, F.col("n")) for k in (shape.rest, shape.wide))
    rows = rows.withColumn("print", _span(at, shape.span)).withColumn("before", _span(near, at - near))
    rows = rows.withColumn("behind", _span(at + shape.span, end - at - shape.span))
    return rows.select(
        "id",
        "text_key",
        "at",
        (beyond - at).alias("reach"),
        "print",
        # The anchor's distances from both ends count: contexts at the ends of texts are shorter.
        F.xxhash64(at - far, beyond - at, _span(far, near - far), "before", "print", "behind", _span(end, beyond - end)).alias("context"),
        F.when(at >= shape.half, F.col("before")).alias("before"),
        F.when(at + shape.span + shape.rest <= F.col("n"), F.col("behind")).alias("behind"),
    )


def _windows(again: DataFrame, shape: _Shape) -> DataFrame:
    """The windows that hold the named half of the context of a text's listed anchors, each once."""
    start = lambda a: F.when(a["left"], _clip(a["at"], shape.wide)).otherwise(_clip(a["at"], shape.half - 1))
    stop = lambda a: F.least(F.when(a["left"], a["at"] - shape.half).otherwise(a["at"]), F.col("n") - shape.window)
    starts = lambda a: F.when(start(a) <= stop(a), F.sequence(start(a), stop(a))).otherwise(F.array().cast("array<int>"))
    listed = F.array_distinct(F.flatten(F.transform("anchors", starts)))
    rows = _hashed(again).withColumn("at", F.explode_outer(listed)).filter("at IS NOT NULL")
    return rows.select("id", "text_key", "at", _span(F.col("at"), shape.window).alias("content"))


def _sieved(df: DataFrame, key_col: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be one of ``wanted`` (one column), and those whose key is none of them.

    Joins deal out whole texts, so those that meet nothing stay out of them. The keys are hashes;
    all that goes to every executor is a bit for each value of some of their bits.
    """
    place, bits = fresh(df, "place", "bits")
    number = lambda key: F.shiftrightunsigned(key, 64 - SIEVE_BITS)
    bit = lambda key: key.bitwiseAND(F.lit(63)).cast("int")
    key, one = F.col(wanted.columns[0]), F.lit(1).cast("bigint")
    sieve = wanted.groupBy(number(key).alias(place)).agg(F.bit_or(F.call_function("shiftleft", one, bit(key))).alias(bits))
    own = F.col(f"`{key_col}`")
    met = df.withColumn(place, number(own)).join(F.broadcast(sieve), place, "left")
    may = F.coalesce(F.getbit(F.col(bits), bit(own)) == 1, F.lit(False))
    return met.filter(may).drop(place, bits), met.filter(~may).drop(place, bits)


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """For documents with deletions: id, text_key and runs, ascending and apart, each by its first and last word (from 0).

    A word goes if it lies in a window of ``min_words`` words that is equal, word for word, to
    an earlier one (smallest id, null last, then word); lines play no part. Exact:

    1. Every window has an anchor: of the spans of a third as many words in it, the first with
       the smallest hash of its first word. Equal windows have equal anchors at the same distance, and
       neighbouring windows mostly share theirs, so about one word in 18 is an anchor. Only
       anchors whose span's hash occurs several times go on.
    2. The context of an anchor is all windows that may have it. Places with equal contexts are
       ranked: the first stays and all others go.
    3. Where contexts around equal anchors differ, a window holds half of what it has beyond the
       anchor on the left or on the right. First places that share such a half with another list
       the windows that hold it, which are ranked by content; again all but the first go.

    Contexts and windows are compared by 64-bit hashes. Places are sorted, never paired,
    so work grows with the number of places, not of pairs; of every word the first copy stays.
    """
    shape = _Shape(min_words)
    texts = df.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    texts = texts.withColumn("text_key", _text_key(F.col("text")))
    everywhere = _anchors(texts, shape)
    path = scratch_path(texts, "table")
    everywhere.write.parquet(path)
    anchors = df.sparkSession.read.schema(everywhere.schema).parquet(path)

    # Repeated rows count as well: they go on here, and share a rank with their like below.
    many = F.count(F.lit(1)).alias("many")
    several = anchors.groupBy("print").agg(many).filter("many > 1").select("print")
    # Dealt out by context as well: a frequent print has many.
    anchors = anchors.join(several, "print").repartition("print", "context")
    order = [F.col("id").isNull(), "id", "text_key", "at"]
    alike = Window.partitionBy("print", "context").orderBy(*order)
    anchors = cut_lineage(anchors.withColumn("rank", F.rank().over(alike)).withColumn("turn", F.row_number().over(alike)))
    # Anchors that occur once are not read again: an empty table takes their room.
    anchors.limit(0).select(everywhere.columns).write.mode("overwrite").parquet(path)

    whole = anchors.filter("rank > 1").select("id", "text_key", _clip(F.col("at"), shape.wide).alias("from"), (F.col("at") + F.col("reach") - 1).alias("to"))

    sides = F.explode(F.array(F.struct(F.lit(True).alias("left"), F.col("before").alias("beside")), F.struct(F.lit(False).alias("left"), F.col("behind").alias("beside"))))
    sided = anchors.filter("turn = 1").select("print", "id", "text_key", "at", sides.alias("s")).select("print", "id", "text_key", "at", "s.*").filter("beside IS NOT NULL")
    contexts = F.count(F.lit(1)).over(Window.partitionBy("print", "left", "beside"))
    firsts = sided.withColumn("contexts", contexts).filter("contexts > 1")
    # Written, as it is used twice.
    listed = cut_lineage(firsts.groupBy("id", "text_key").agg(F.collect_list(F.struct("at", "left")).alias("anchors")))
    renamed = listed.select(F.col("id").alias("o_id"), F.col("text_key").alias("o_key"), "anchors")
    met, _ = _sieved(texts, "text_key", listed.select("text_key"))
    again = met.join(renamed, F.col("id").eqNullSafe(F.col("o_id")) & (F.col("text_key") == F.col("o_key")))
    parts = _windows(again.select("id", "text_key", "text", "anchors"), shape)
    part = parts.withColumn("rank", F.rank().over(Window.partitionBy("content").orderBy(*order))).filter("rank > 1")
    # Written, so that the texts dealt out for it may leave the disks before they are dealt out again.
    part = cut_lineage(part.select("id", "text_key", "at"))
    ranges = whole.unionByName(part.select("id", "text_key", F.col("at").alias("from"), (F.col("at") + min_words - 1).alias("to")))

    of_text = Window.partitionBy("id", "text_key").orderBy("from", "to")
    before = F.max("to").over(of_text.rowsBetween(Window.unboundedPreceding, -1))
    islands = ranges.withColumn("new", F.when(F.col("from") <= before + 1, 0).otherwise(1))
    islands = islands.withColumn("run", F.sum("new").over(of_text.rowsBetween(Window.unboundedPreceding, 0)))
    runs = islands.groupBy("id", "text_key", "run").agg(F.min("from").alias("from"), F.max("to").alias("to"))
    return runs.groupBy("id", "text_key").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("runs"))


def _opens(tokens: Column, i: Column) -> Column:
    """Whether token ``i`` is the first of a line, or one past the last token."""
    return (i <= 0) | (i >= F.size(tokens)) | F.coalesce(F.get(tokens, i).contains("\n"), F.lit(True))


def _trimmed(tokens: Column, run: Column) -> Column:
    """The run without a few words at either end in a line of which more stays."""
    start, end = run["from"], run["to"]
    for k in range(RAGGED_WORDS, 0, -1):
        first = F.when(~_opens(tokens, run["from"]) & _opens(tokens, run["from"] + k), run["from"] + k)
        last = F.when(~_opens(tokens, run["to"] + 1) & _opens(tokens, run["to"] + 1 - k), run["to"] - k)
        start, end = F.coalesce(first, start), F.coalesce(last, end)
    return F.struct(start.cast("int").alias("from"), end.cast("int").alias("to"))


def drop_repeated_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``df`` with later repeated passages of ``min_words`` words or more deleted, and two more columns.

    All columns and rows of ``df`` stay, the text without the deleted passages; these may begin
    and end inside lines, but up to RAGGED_WORDS words in a line of which more stays are left.
    Lines of which nothing is left go. ``lines`` counts the lines before, ``deleted_lines``
    those that lose words (and blank ones inside passages). Null texts stay null (0 lines),
    texts without a repeated passage stay as they are, a text of which every line goes becomes
    empty. Rows that agree in id and text are one document: they lose the same words. Null ids
    come last. New columns give way to columns of the same name by a longer name.
    """
    runs = cut_lineage(repeated_passages(df, id_col, text_col, min_words))
    key, marks, many, gone, token = fresh(df, "text_key", "runs", "lines", "deleted_lines", "tokens")
    found = runs.select(F.col("id").alias(f"{key}_id"), F.col("text_key").alias(f"{key}_r"), F.col("runs").alias(marks))
    keyed = df.withColumn(key, _text_key(text_or_empty(text_col)))
    met, others = _sieved(keyed, key, runs.select("text_key"))
    joined = met.join(found, F.col(f"`{id_col}`").eqNullSafe(F.col(f"{key}_id")) & (F.col(key) == F.col(f"{key}_r")), "left")
    text = F.col(f"`{text_col}`").cast("string")
    tokens, cuts = F.col(token), F.col(marks)
    # The white space at the end is one more token, so a deletion always has one after it.
    cut = F.concat(F.regexp_extract_all(text, F.lit(TOKEN), 1), F.array(F.regexp_extract(text, r"[\x20\x09-\x0D]*\z", 0)))
    joined = joined.withColumn(token, F.when(cuts.isNotNull(), cut))
    words = F.slice(tokens, 1, F.size(tokens) - 1)
    joined = joined.withColumn(f"{marks}_w", words)
    joined = joined.withColumn(marks, F.transform(cuts, lambda r: _trimmed(F.col(f"{marks}_w"), r)))

    space = lambda t: F.regexp_extract(t, r"\A[\x20\x09-\x0D]*", 0)
    number = F.size(cuts)
    upto = lambda i: F.when(i + 1 < number, F.get(cuts, i + 1)["from"]).otherwise(F.size(tokens))

    def seam(r: Column) -> Column:
        """The white space that stays for a run: of two line breaks one goes, and parts of different lines do not meet."""
        left, right = space(F.get(tokens, r["from"])), space(F.get(tokens, r["to"] + 1))
        opens, closes = (r["from"] == 0) | left.contains("\n"), (r["to"] + 2 == F.size(tokens)) | right.contains("\n")
        both = F.when(right.contains("\n"), F.concat(left, F.regexp_replace(right, r"\A[^\n]*\n", ""))).otherwise(
            F.regexp_replace(left, r"\n[^\n]*\z", "")
        )
        broken = F.array_join(F.slice(tokens, r["from"] + 2, r["to"] - r["from"]), "").contains("\n")
        return F.when(opens & closes, both).when(closes, right).when(~opens & broken, "\n").otherwise(left)

    def after(r: Column, i: Column) -> Column:
        """What stays between a run and the next one."""
        rest = F.array_join(F.slice(tokens, r["to"] + 2, upto(i) - r["to"] - 1), "")
        return F.concat(seam(r), F.regexp_replace(rest, r"\A[\x20\x09-\x0D]+", ""))

    head = F.array_join(F.slice(tokens, 1, F.get(cuts, F.lit(0))["from"]), "")
    new_text = F.concat(head, F.array_join(F.transform(cuts, after), ""))
    breaks = lambda a, n: F.size(F.split(F.array_join(F.slice(tokens, a, n), ""), "\n")) - 1
    # Lines of a run are its breaks and one; a line that the run before has counted counts once.
    inside = lambda r, i: breaks(r["from"] + 2, r["to"] - r["from"]) + F.when(
        (i > 0) & (breaks(F.get(cuts, F.greatest(i - 1, F.lit(0)))["to"] + 2, r["from"] - F.get(cuts, F.greatest(i - 1, F.lit(0)))["to"]) == 0), 0
    ).otherwise(1)
    dead = F.aggregate(F.transform(cuts, inside), F.lit(0), lambda a, x: a + x)

    def result(rows: DataFrame, new: Column, deleted: Column) -> DataFrame:
        texts = [new.alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns]
        return rows.select(*texts, F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).alias(many), deleted.alias(gone))

    changed = result(joined, F.when(cuts.isNull(), text).otherwise(new_text), F.when(cuts.isNull(), 0).otherwise(dead))
    return result(others, text, F.lit(0)).union(changed)
