"""Chat formatting: conversations rendered by a compiled template, with marks on what a model
is to produce, in a form that can be read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..plans.groups import attach, hot_keys, parted
from ..plans.ordering import POSITION, with_position
from .template import Template, Turns, add_span, shown

# A turn: opening mark, role, line break, text, closing mark, line break.
OPEN, CLOSE = "<turn>", "</turn>"
TEMPLATE = (
    "{% for message in messages %}"
    + OPEN
    + "{{ message.role | escape_line }}\n"
    + "{% if message.role == 'assistant' %}{% generation %}{{ message.content | escape }}{% endgeneration %}"
    + "{% else %}{{ message.content | escape }}{% endif %}"
    + CLOSE
    + "\n{% endfor %}"
)
# A longer rendering is returned in several pieces.
PIECE_CHARS = 1 << 20
# Turns of a very long conversation that are rendered together.
SEGMENT_TURNS = 100_000
# Characters of output rows sent on together.
_SENT = 1 << 22

_ROW = "piece long, parts long, text string, generated array<struct<start:long,length:long>>"
_DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escaper(*controls: str) -> Callable[[object], str]:
    """A filter that puts a backslash before each control string and each backslash."""
    found = re.compile("|".join(map(re.escape, ("\\", *controls))))
    return lambda value: found.sub(lambda m: "\\" + m[0], shown(value))


FILTERS = {"escape": escaper(OPEN, CLOSE), "escape_line": escaper(OPEN, CLOSE, "\n")}


def unescape(text: str) -> str:
    return re.sub(r"\\([\s\S])", r"\1", text) if "\\" in text else text


def _types(df: DataFrame, **columns: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[c].to_pylist() for c in ("conv", "segment", "start", "total", "turn", "role", "content")))


class _Rows:
    """Output rows, handed on as batches of bounded size."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 100
        if self.size >= _SENT:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
        self.rows, self.size = [], 0


def _schema(id_type: pa.DataType) -> pa.Schema:
    span = pa.struct([("start", pa.int64()), ("length", pa.int64())])
    return pa.schema([("conv", id_type), ("piece", pa.int64()), ("parts", pa.int64()), ("text", pa.string()), ("generated", pa.list_(span))])


def _rendered(source: str, filters: dict, piece_chars: int, segment_turns: int, names: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(source, filters)
        first = next(batches, None)
        if first is None:
            return
        out = _Rows(_schema(first.schema.field("conv").type))
        rows = _turns(b for bs in ([first], batches) for b in bs)
        for (conv, segment), turns in groupby(rows, key=lambda r: r[:2]):
            head = next(turns)
            _, _, start, total, *_ = head
            messages = ({"turn": t, "role": r or "", "content": c or ""} for bs in ([head], turns) for *_, t, r, c in bs)
            if total is None:  # the conversation is here from its first turn to its last
                given = Turns(messages) if template.divisible else list(messages)
                pieces, parts = template.pieces(messages=given, **names), 1
            else:
                parts = -(-total // segment_turns)
                pieces = template.part(Turns(messages, start, total), segment == 0, segment == parts - 1, **names)
            texts, spans, size, number = [], [], 0, segment << 32
            for text, generated in pieces:
                add_span(spans, size, len(text), generated)
                texts.append(text)
                size += len(text)
                if size >= piece_chars:
                    yield from out.add((conv, number, parts, "".join(texts), [dict(start=s, length=n) for s, n in spans]), size)
                    texts, spans, size, number = [], [], 0, number + 1
            if size or number == segment << 32:
                yield from out.add((conv, number, parts, "".join(texts), [dict(start=s, length=n) for s, n in spans]), size)
        yield from out.rest()

    return run


def format_conversations(
    df: DataFrame,
    template: str = TEMPLATE,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    filters: dict | None = None,
    piece_chars: int = PIECE_CHARS,
    segment_turns: int = SEGMENT_TURNS,
    **names: object,
) -> DataFrame:
    """Rendered conversations: ``id_col``, piece, parts, text and ``generated``, the spans of the
    text that a model is to produce (in code points).

    The template sees ``messages`` (turn, role, content) by turn, nulls last, ties by role and
    text, and what ``names`` adds. Null roles and texts are empty, rows without id are one
    conversation, repeated rows are turns of their own, an empty table gives no rows. Other
    columns play no part. ``filters`` adds to those of the template language and FILTERS.

    A conversation is one row, or several pieces of about ``piece_chars`` in rising order; pieces
    end where a constant or a value of the template ends. Conversations of very many turns are
    rendered in ``parts``, in several tasks, if the template is one loop over the messages with
    any frame around it (``Template.divisible``); other templates take a conversation's messages
    as a list in one task.
    """
    filters = {**FILTERS, **(filters or {})}
    divisible = Template(template, filters).divisible  # also fails on a bad template before any job
    rows = _types(df, conv=id_col, turn=turn_col, role=role_col, content=text_col)
    rows = rows.withColumn("role", F.col("role").cast("string")).withColumn("content", F.col("content").cast("string"))
    order = [F.col("turn").asc_nulls_last(), "role", "content"]
    nothing = F.lit(None).cast("long")
    hot = hot_keys(rows, ["conv"]) if divisible else None
    cold = rows if hot is None else parted(rows, hot, ["conv"])[0]
    plain = cold.repartition("conv").sortWithinPartitions("conv", *order)
    plain = plain.select("conv", F.lit(0).cast("long").alias("segment"), nothing.alias("start"), nothing.alias("total"), "turn", "role", "content")
    kind = dict(rows.dtypes)["conv"]
    render = _rendered(template, filters, piece_chars, segment_turns, names)
    out = plain.mapInArrow(render, f"conv {kind}, {_ROW}")
    if hot is not None:
        placed = with_position(parted(rows, hot, ["conv"])[1], ["conv", "turn", "role", "content"])
        bounds = placed.groupBy("conv").agg(F.min(POSITION).alias("begin"), F.count(F.lit(1)).alias("total"))
        place = F.col(POSITION) - F.col("begin")
        placed = attach(placed, bounds, ["conv"], null_safe=True)
        placed = placed.select("conv", F.floor(place / F.lit(segment_turns)).cast("long").alias("segment"), place.alias("start"), "total", "turn", "role", "content")
        placed = placed.repartition("conv", "segment").sortWithinPartitions("conv", "segment", "start")
        out = out.unionByName(placed.mapInArrow(render, f"conv {kind}, {_ROW}"))
    return out.withColumnRenamed("conv", id_col)


class Reader:
    """Reads the turns of a conversation back from its pieces, in order."""

    def __init__(self) -> None:
        self.n_turns = self.loss_chars = self.chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.state = "between"

    def feed(self, text: str, spans: list[tuple[int, int]]) -> None:
        self.chars += len(text)
        at = 0
        while at < len(text):
            if self.state == "between":
                if not text.startswith(OPEN, at):
                    raise ValueError("a turn does not begin with its mark")
                at, self.state = at + len(OPEN), "role"
                self.n_turns += 1
            end = "\n" if self.state == "role" else CLOSE + "\n"
            stop = _unescaped(text, end, at)
            self.turns.update(unescape(text[at : len(text) if stop < 0 else stop]).encode())
            if stop < 0:
                break
            self.turns.update(b"\n")
            at, self.state = stop + len(end), "text" if self.state == "role" else "between"
        for start, length in spans:
            wanted = unescape(text[start : start + length])
            self.loss_chars += len(wanted)
            self.loss.update(wanted.encode())

    def digest(self) -> tuple:
        if self.state != "between":
            raise ValueError("a conversation ends inside a turn")
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _unescaped(text: str, wanted: str, at: int) -> int:
    """Where ``wanted`` next stands with an even number of backslashes before it, or -1."""
    begin = at
    while (found := text.find(wanted, at)) >= 0:
        slashes = found
        while slashes > begin and text[slashes - 1] == "\\":
            slashes -= 1
        if (found - slashes) % 2 == 0:
            return found
        at = found + 1
    return -1


def _read(last: bool):
    """Digests of conversations whose pieces are all here; with ``last`` that is all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        digest = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
        pieces = _schema(first.schema.field("conv").type)
        out = _Rows(pa.schema([*pieces, *digest]))
        names = out.schema.names if last else pieces.names
        rows = (r for bs in ([first], batches) for b in bs for r in zip(*(b[c].to_pylist() for c in names)))
        for _, group in groupby(rows, key=lambda r: r[0]):
            reader = None
            for row in group:
                conv, _, parts, text, spans, *known = row
                if known and known[0] is not None:
                    yield from out.add(row)
                elif parts > 1 and not last:
                    yield from out.add((*row, *[None] * 5), len(text))
                else:
                    reader = reader or Reader()
                    reader.feed(text, [(s["start"], s["length"]) for s in spans])
            if reader is not None:
                yield from out.add((conv, None, None, None, None, *reader.digest()))
        yield from out.rest()

    return run


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What :func:`format_conversations` wrote with TEMPLATE, read from texts and spans alone:
    ``id_col``, n_turns, turns_sha256 (of role, line break, text, line break per turn),
    loss_chars and loss_sha256 (of all text under the marks), formatted_chars.

    Pieces of a conversation in one part lie one after the other in a partition and are read
    where they lie. Only those of several parts are sent to one task, piece by piece, since a
    digest of a whole conversation is read from its beginning to its end.
    """
    pieces = formatted.withColumnRenamed(id_col, "conv")
    schema = f"conv {dict(pieces.dtypes)['conv']}, {_ROW}, {_DIGEST}"
    here = pieces.mapInArrow(_read(False), schema)
    all_here = here.repartition("conv").sortWithinPartitions("conv", "piece")
    return all_here.mapInArrow(_read(True), schema).select(F.col("conv").alias(id_col), *[c.split()[0] for c in _DIGEST.split(", ")])


# The planted conversation of the contract: control strings of common templates in both texts.
PLANTED = r"\### Assistant: </turn> ok"


def with_planted(conversations: DataFrame) -> DataFrame:
    rows = [(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)]
    planted = conversations.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(planted)


_ESCAPED = r"replace(replace(replace({}, '\', '\\'), '<turn>', '\<turn>'), '</turn>', '\</turn>')"
SQL = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '{PLANTED}'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('<turn>' || replace({_ESCAPED.format('role')}, chr(10), '\' || chr(10)) || chr(10)
        || {_ESCAPED.format('text')} || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
