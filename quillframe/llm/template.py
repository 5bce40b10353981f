"""A small sandboxed template language, compiled to Python closures.

    {# comment #}   {{ value }}   {% set name = value %}
    {% if value %} ... {% elif value %} ... {% else %} ... {% endif %}
    {% for name in value %} ... {% else %} ... {% endfor %}      loop.index, .index0, .first, .last
    {% generation %} ... {% endgeneration %}                     marks what a model is to produce

``{%-`` and ``-%}`` take off the white space beside a tag. Values: text, whole numbers, true,
false, none, lists, names, ``a.b``, ``a["b"]``, ``a[0]``, filters ``a | upper`` and ``a | f("x")``,
``x if test else y``, or, and, not, comparisons, in, not in, ``a is defined``, ``+ - * // %``
and ``~`` (joins as text).

Sandbox: a template reaches the values it is given, as texts, numbers, lists and mappings with
text keys, and the filters it is given, and nothing else: no attributes of Python objects, no
calls, no imports. Loops run over given or written lists only, nothing recurses, and numbers
and repeated texts have bounded size, so every rendering ends.

A source is parsed into a syntax tree, constant parts are computed once (``folded``), and each
node becomes a closure. Statements yield pieces ``(text, generated)``, so a long rendering is
never held whole, and a list of messages may be an iterator that is read once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

Piece = tuple[str, bool]
Filter = Callable[..., Any]
Scope = dict[str, Any]

MAX_TEXT = 1 << 30  # a text that a template puts together as a value
MAX_LIST = 1 << 20
MAX_NUMBER = 1 << 62
MAX_DEPTH = 64  # tags and brackets inside each other


class TemplateError(ValueError):
    """A template that does not follow the language, or a value that it cannot work on."""


class _Missing:
    """What an unknown name or key gives: false, empty, and an error where a value is needed."""

    def __bool__(self) -> bool:
        return False


MISSING = _Missing()


@dataclass(frozen=True)
class Node:
    kind: str
    parts: tuple = ()


# Source to tokens -------------------------------------------------------------------------

_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?)(.*?)(-?)#\}", re.S)
_TOKEN = re.compile(
    r"""\s*(?:(?P<text>"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"""
    r"""|(?P<op>==|!=|<=|>=|//|[-+*%~<>=|.,()\[\]]))""",
    re.S,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}
_WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_RESERVED = {"and", "or", "not", "in", "is", "if", "else", *_WORDS}


def _tokens(source: str) -> list[tuple[str, Any]]:
    out, at, source = [], 0, source.rstrip()
    while at < len(source):
        found = _TOKEN.match(source, at)
        if not found:
            raise TemplateError(f"cannot read {source[at:at + 20]!r}")
        kind, at = found.lastgroup, found.end()
        value: Any = found[kind]
        if kind == "text":
            value = re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], "\\" + m[1]), value[1:-1], flags=re.S)
        elif kind == "number":
            value = int(value) if len(value) < 20 else MAX_NUMBER
            if value >= MAX_NUMBER:
                raise TemplateError("number too large")
        out.append((kind, value))
    return out


# Tokens to values -------------------------------------------------------------------------


class _Values:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str, filters: dict[str, Filter]) -> None:
        self.tokens, self.at, self.filters, self.depth = _tokens(source), 0, filters, 0

    def peek(self, *wanted: str) -> bool:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
        return kind in ("op", "name") and value in wanted

    def take(self, *wanted: str) -> bool:
        found = self.peek(*wanted)
        self.at += found
        return found

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r}")

    def name(self) -> str:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
        if kind != "name" or value in _RESERVED:
            raise TemplateError("expected a name")
        self.at += 1
        return value

    def done(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def value(self) -> Node:
        self.depth += 1
        if self.depth > MAX_DEPTH:
            raise TemplateError("nested too deeply")
        out = self.binary(0)
        if self.take("if"):
            test = self.binary(0)
            self.need("else")
            out = Node("choice", (test, out, self.value()))
        self.depth -= 1
        return out

    LEVELS = (("or",), ("and",), ("not",), ("==", "!=", "<", "<=", ">", ">=", "in", "not", "is"), ("~",), ("+", "-"), ("*", "//", "%"))

    def binary(self, level: int) -> Node:
        if level == len(self.LEVELS):
            return self.sign()
        if self.LEVELS[level] == ("not",):
            negated = False
            while self.take("not"):
                negated = not negated
            inner = self.binary(level + 1)
            return Node("not", (inner,)) if negated else inner
        left = self.binary(level + 1)
        while self.peek(*self.LEVELS[level]):
            operator = self.tokens[self.at][1]
            self.at += 1
            if operator == "is":
                negated = self.take("not")
                self.need("defined")
                left = Node("defined", (left,))
                left = Node("not", (left,)) if negated else left
                continue
            if operator == "not":
                self.need("in")
                operator = "not in"
            left = Node("binary", (operator, left, self.binary(level + 1)))
        return left

    def sign(self) -> Node:
        minus = False
        while self.take("-"):
            minus = not minus
        inner = self.filtered()
        return Node("binary", ("-", Node("constant", (0,)), inner)) if minus else inner

    def filtered(self) -> Node:
        out = self.atom()
        while True:
            if self.take("."):
                out = Node("key", (out, Node("constant", (self.name(),))))
            elif self.take("["):
                out = Node("key", (out, self.value()))
                self.need("]")
            elif self.take("|"):
                name, arguments = self.name(), []
                if name not in self.filters:
                    raise TemplateError(f"no filter {name!r}")
                if self.take("("):
                    arguments = self.listed(")")
                out = Node("filter", (name, out, *arguments))
            else:
                return out

    def listed(self, end: str) -> list[Node]:
        out = []
        while not self.take(end):
            out.append(self.value())
            if not self.peek(end):
                self.need(",")
        return out

    def atom(self) -> Node:
        if self.take("("):
            out = self.value()
            self.need(")")
            return out
        if self.take("["):
            return Node("list", tuple(self.listed("]")))
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
        if kind in ("text", "number"):
            self.at += 1
            return Node("constant", (value,))
        if kind == "name" and value in _WORDS:
            self.at += 1
            return Node("constant", (_WORDS[value],))
        return Node("name", (self.name(),))


# Source to statements ---------------------------------------------------------------------


@dataclass
class _Open:
    """A block tag whose end has not come yet."""

    kind: str
    head: Any = None
    branches: list = field(default_factory=list)  # (test or None, statements)
    body: list = field(default_factory=list)


def parse(source: str, filters: dict[str, Filter]) -> Node:
    """The syntax tree of a template."""
    stack, at, strip = [_Open("template")], 0, False

    def text(upto: int, strip_end: bool) -> None:
        piece = source[at:upto]
        piece = piece.lstrip() if strip else piece
        piece = piece.rstrip() if strip_end else piece
        if piece:
            stack[-1].body.append(Node("text", (piece, False)))

    for tag in _TAG.finditer(source):
        before, shown, after, before2, statement, after2, before3, _, after3 = tag.groups()
        text(tag.start(), bool(before or before2 or before3))
        at, strip = tag.end(), bool(after or after2 or after3)
        if shown is not None:
            values = _Values(shown, filters)
            stack[-1].body.append(Node("show", (values.value(),)))
            values.done()
        elif statement is not None:
            _statement(stack, _Values(statement, filters))
    text(len(source), False)
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1].kind} without end")
    return Node("block", tuple(stack[0].body))


def _statement(stack: list[_Open], values: _Values) -> None:
    top = stack[-1]
    if values.take("if"):
        stack.append(_Open("if", values.value()))
    elif values.take("elif") and top.kind == "if" and (not top.branches or top.head is not None):
        top.branches.append((top.head, top.body))
        top.head, top.body = values.value(), []
    elif values.take("else") and top.kind in ("if", "for") and top.head is not None:
        top.branches.append((top.head, top.body))
        top.head, top.body = None, []
    elif values.take("for"):
        name = values.name()
        values.need("in")
        stack.append(_Open("for", (name, values.value())))
    elif values.take("set"):
        name = values.name()
        values.need("=")
        top.body.append(Node("set", (name, values.value())))
    elif values.take("generation"):
        if any(o.kind == "generation" for o in stack):
            raise TemplateError("generation inside generation")
        stack.append(_Open("generation"))
    elif values.peek("endif", "endfor", "endgeneration") and values.take(f"end{top.kind}"):
        stack.pop()
        stack[-1].body.append(_closed(top))
    else:
        raise TemplateError("unknown or misplaced tag")
    values.done()
    if len(stack) > MAX_DEPTH:
        raise TemplateError("nested too deeply")


def _closed(block: _Open) -> Node:
    if block.kind == "generation":
        return Node("generation", (Node("block", tuple(block.body)),))
    parts = [*block.branches, (block.head, block.body)]
    if block.kind == "for":
        (name, values), body = parts[0]
        other = parts[1][1] if len(parts) > 1 else []
        return Node("for", (name, values, Node("block", tuple(body)), Node("block", tuple(other))))
    return Node("if", tuple((test, Node("block", tuple(body))) for test, body in parts))


# Values at work -----------------------------------------------------------------------------


def shown(value: Any) -> str:
    """A value as text; none and lists have no text of their own."""
    if isinstance(value, str):
        return value
    if value is True or value is False:
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    raise TemplateError(f"no text for {_kind(value)}")


def _kind(value: Any) -> str:
    return "a missing value" if value is MISSING else "none" if value is None else type(value).__name__


def _fits(length: int, most: int = MAX_TEXT) -> None:
    if length > most:
        raise TemplateError("value too long")


def _joined(a: Any, b: Any) -> Any:
    _fits(len(a) + len(b), MAX_TEXT if isinstance(a, str) else MAX_LIST)
    return a + b


def _bounded(value: Any) -> Any:
    if isinstance(value, int) and abs(value) > MAX_NUMBER:
        raise TemplateError("number too large")
    return value


def _calculate(operator: str, a: Any, b: Any) -> Any:
    if operator == "==":
        return a == b
    if operator == "!=":
        return a != b
    if operator == "~":
        return _joined(shown(a), shown(b))
    if operator in ("in", "not in"):
        if not isinstance(b, (list, tuple, dict)) and not (isinstance(a, str) and isinstance(b, str)):
            raise TemplateError(f"cannot search {_kind(b)} for {_kind(a)}")
        return (a in b) == (operator == "in")
    numbers = all(isinstance(x, int) and not isinstance(x, bool) for x in (a, b))
    texts = isinstance(a, str) and isinstance(b, str)
    if operator in ("<", "<=", ">", ">="):
        if not numbers and not texts:
            raise TemplateError(f"cannot compare {_kind(a)} and {_kind(b)}")
        return {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[operator]
    if operator == "+" and (texts or isinstance(a, list) and isinstance(b, list)):
        return _joined(a, b)
    if operator == "*" and isinstance(a, str) and isinstance(b, int):
        _fits(len(a) * b)
        return a * b
    if not numbers:
        raise TemplateError(f"cannot use {operator} on {_kind(a)} and {_kind(b)}")
    if operator in ("//", "%") and not b:
        raise TemplateError("division by zero")
    return _bounded({"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "//": lambda: a // b, "%": lambda: a % b}[operator]())


def _key(value: Any, key: Any) -> Any:
    """Keys of mappings and places of lists only; anything else of an object stays out of reach."""
    if isinstance(value, dict):
        return value.get(key, MISSING) if isinstance(key, str) else MISSING
    if isinstance(value, (list, str)) and isinstance(key, int) and not isinstance(key, bool):
        return value[key] if -len(value) <= key < len(value) else MISSING
    if isinstance(value, Turns) and key == 0 and not isinstance(key, bool):
        return value.first
    if value is MISSING or value is None:
        raise TemplateError(f"no {key!r} of {_kind(value)}")
    return MISSING


class Turns:
    """Messages read once, in order; the first may be looked at before."""

    def __init__(self, rows: Iterable[dict], start: int = 0, total: int | None = None, first: Any = None) -> None:
        self._rows = iter(rows)
        self._next = next(self._rows, MISSING)
        self._begun = False
        self.start, self.total = start, total
        self.first = self._next if first is None else first

    def __bool__(self) -> bool:
        return self._begun or self._next is not MISSING

    def walk(self) -> Iterator[tuple[Any, int, bool]]:
        if self._begun:
            raise TemplateError("messages are read once only")
        self._begun, at = True, self.start
        while self._next is not MISSING:
            row, self._next = self._next, next(self._rows, MISSING)
            at += 1
            yield row, at - 1, at == self.total if self.total is not None else self._next is MISSING


def _walk(value: Any) -> Iterator[tuple[Any, int, bool]]:
    if isinstance(value, Turns):
        yield from value.walk()
    elif isinstance(value, (list, tuple)):
        for i, item in enumerate(value):
            yield item, i, i + 1 == len(value)
    else:
        raise TemplateError(f"cannot loop over {_kind(value)}")


# Folding and closures -------------------------------------------------------------------------


def fold(node: Node, filters: dict[str, Filter]) -> Node:
    """The same tree with constant parts computed and neighbouring texts joined.

    What fails on constants is left as it is, so it fails only if it is ever reached.
    """
    inside = lambda p: fold(p, filters) if isinstance(p, Node) else tuple(map(inside, p)) if isinstance(p, tuple) else p
    parts = tuple(map(inside, node.parts))
    node = Node(node.kind, parts)
    constant = lambda n: n.kind == "constant"
    if node.kind == "choice" and constant(parts[0]):
        return parts[1] if parts[0].parts[0] else parts[2]
    if node.kind == "binary" and parts[0] in ("and", "or") and constant(parts[1]):
        return parts[2] if bool(parts[1].parts[0]) == (parts[0] == "and") else parts[1]
    if node.kind in ("binary", "not", "filter", "list") and all(constant(p) for p in parts if isinstance(p, Node)):
        try:
            return Node("constant", (_value(node, filters)({}),))
        except Exception:  # a filter may raise anything
            return node
    if node.kind == "show" and constant(parts[0]):
        try:
            return Node("text", (shown(parts[0].parts[0]), False))
        except TemplateError:
            return node
    if node.kind == "if":
        kept = []
        for test, body in parts:
            if test is not None and constant(test):
                if not test.parts[0]:
                    continue
                test = None
            kept.append((test, body))
            if test is None:
                break
        if not kept:
            return Node("block")
        return kept[0][1] if kept[0][0] is None else Node("if", tuple(kept))
    if node.kind == "generation" and parts[0].kind == "block":
        if not parts[0].parts:
            return parts[0]
        if all(p.kind == "text" for p in parts[0].parts):
            return Node("block", tuple(Node("text", (p.parts[0], True)) for p in parts[0].parts))
    if node.kind == "block":
        flat = [q for p in parts for q in (p.parts if p.kind == "block" else (p,))]
        joined: list[Node] = []
        for p in flat:
            if p.kind == "text" and joined and joined[-1].kind == "text" and joined[-1].parts[1] == p.parts[1]:
                joined[-1] = Node("text", (joined[-1].parts[0] + p.parts[0], p.parts[1]))
            elif p.kind != "text" or p.parts[0]:
                joined.append(p)
        return Node("block", tuple(joined))
    return node


def _value(node: Node, filters: dict[str, Filter]) -> Callable[[Scope], Any]:
    """A closure that computes the value from the names in scope."""
    parts = node.parts
    if node.kind == "constant":
        (held,) = parts
        return lambda scope: held
    if node.kind == "name":
        (name,) = parts
        return lambda scope: scope.get(name, MISSING)
    if node.kind == "list":
        items = [_value(p, filters) for p in parts]
        return lambda scope: [item(scope) for item in items]
    if node.kind == "not":
        inner = _value(parts[0], filters)
        return lambda scope: not inner(scope)
    if node.kind == "defined":
        inner = _value(parts[0], filters)
        return lambda scope: inner(scope) is not MISSING
    if node.kind == "choice":
        test, yes, no = (_value(p, filters) for p in parts)
        return lambda scope: yes(scope) if test(scope) else no(scope)
    if node.kind == "key":
        of, key = (_value(p, filters) for p in parts)
        return lambda scope: _key(of(scope), key(scope))
    if node.kind == "filter":
        work, arguments = filters[parts[0]], [_value(p, filters) for p in parts[1:]]
        return lambda scope: work(*[a(scope) for a in arguments])
    operator = parts[0]
    a, b = (_value(p, filters) for p in parts[1:])
    if operator == "and":
        return lambda scope: a(scope) and b(scope)
    if operator == "or":
        return lambda scope: a(scope) or b(scope)
    if operator == "==":  # by far the most frequent
        return lambda scope: a(scope) == b(scope)
    return lambda scope: _calculate(operator, a(scope), b(scope))


Renderer = Callable[[Scope], Iterator[Piece]]


def _statements(node: Node, filters: dict[str, Filter]) -> Renderer:
    """A closure that yields the pieces of a statement; ``set`` changes the scope."""
    parts = node.parts
    if node.kind == "text":
        piece = (parts[0], parts[1])

        def text(scope: Scope) -> Iterator[Piece]:
            yield piece

        return text
    if node.kind == "show":
        value = _value(parts[0], filters)

        def show(scope: Scope) -> Iterator[Piece]:
            yield shown(value(scope)), False

        return show
    if node.kind == "set":
        name, value = parts[0], _value(parts[1], filters)

        def assign(scope: Scope) -> Iterator[Piece]:
            scope[name] = value(scope)
            return iter(())

        return assign
    if node.kind == "block":
        steps = [_statements(p, filters) for p in parts]
        if len(steps) == 1:
            return steps[0]

        def block(scope: Scope) -> Iterator[Piece]:
            for step in steps:
                yield from step(scope)

        return block
    if node.kind == "generation":
        inner = _statements(parts[0], filters)

        def generation(scope: Scope) -> Iterator[Piece]:
            for text, _ in inner(scope):
                yield text, True

        return generation
    if node.kind == "if":
        branches = [(None if test is None else _value(test, filters), _statements(body, filters)) for test, body in parts]

        def choose(scope: Scope) -> Iterator[Piece]:
            for test, body in branches:
                if test is None or test(scope):
                    return body(scope)
            return iter(())

        return choose
    name, values = parts[0], _value(parts[1], filters)
    body, other = _statements(parts[2], filters), _statements(parts[3], filters)

    def loop(scope: Scope) -> Iterator[Piece]:
        empty = True
        for item, index, last in _walk(values(scope)):
            empty = False
            place = {"index": index + 1, "index0": index, "first": not index, "last": last}
            # What a loop sets is gone with the turn, so every turn can be rendered alone.
            yield from body({**scope, name: item, "loop": place})
        if empty:
            yield from other(scope)

    return loop


def _replace(x: Any, old: Any, new: Any) -> str:
    x, old, new = shown(x), shown(old), shown(new)
    _fits(len(x) + x.count(old) * len(new))
    return x.replace(old, new)


def _join(x: Any, between: Any = "") -> str:
    if not isinstance(x, (list, tuple)):
        raise TemplateError(f"cannot join {_kind(x)}")
    texts = [shown(v) for v in x]
    _fits(sum(map(len, texts)) + len(texts) * len(shown(between)))
    return shown(between).join(texts)


def _length(x: Any) -> int:
    if not isinstance(x, (str, list, tuple, dict)):
        raise TemplateError(f"no length of {_kind(x)}")
    return len(x)


FILTERS: dict[str, Filter] = {
    "trim": lambda x: shown(x).strip(),
    "upper": lambda x: shown(x).upper(),
    "lower": lambda x: shown(x).lower(),
    "length": _length,
    "default": lambda x, other="": other if x is MISSING or x is None else x,
    "replace": _replace,
    "join": _join,
}


class Template:
    """A compiled template; ``filters`` adds to FILTERS."""

    def __init__(self, source: str, filters: dict[str, Filter] | None = None) -> None:
        self.filters = {**FILTERS, **(filters or {})}
        self.tree = fold(parse(source, self.filters), self.filters)
        self.tree = self.tree if self.tree.kind == "block" else Node("block", (self.tree,))
        self._all = _statements(self.tree, self.filters)
        loops = [i for i, n in enumerate(self.tree.parts) if n.kind == "for" and n.parts[1] == Node("name", ("messages",))]
        self.divisible = len(loops) == 1 and not any("messages" in _names(n) for i, n in enumerate(self.tree.parts) if i not in loops)
        if self.divisible:
            (at,) = loops
            self.divisible = "messages" not in _names(self.tree.parts[at].parts[2]) | _names(self.tree.parts[at].parts[3])
            block = lambda nodes: _statements(Node("block", tuple(nodes)), self.filters)
            self._parts = [block(self.tree.parts[:at]), block([self.tree.parts[at]]), block(self.tree.parts[at + 1 :])]

    def pieces(self, **names: Any) -> Iterator[Piece]:
        return self._all(dict(names))

    def part(self, turns: Turns, start: bool, end: bool, **names: Any) -> Iterator[Piece]:
        """Some turns of a conversation alone; what comes before the loop only with ``start``,
        what comes after it with ``end``. Joined, the parts are the whole (``divisible``)."""
        if not self.divisible:
            raise TemplateError("this template needs all messages at once")
        scope = dict(names, messages=turns)
        before = list(self._parts[0](scope))  # also sets names that the loop uses
        yield from before if start else ()
        yield from self._parts[1](scope)
        yield from self._parts[2](scope) if end else ()

    def render(self, **names: Any) -> tuple[str, list[tuple[int, int]]]:
        """The text, and where generated spans begin and how long they are."""
        out, spans, at = [], [], 0
        for text, generated in self.pieces(**names):
            out.append(text)
            add_span(spans, at, len(text), generated)
            at += len(text)
        return "".join(out), spans


def _names(node: Any) -> set[str]:
    if isinstance(node, tuple):
        return set().union(*map(_names, node)) if node else set()
    if not isinstance(node, Node):
        return set()
    return {node.parts[0]} if node.kind == "name" else _names(node.parts)


def add_span(spans: list[tuple[int, int]], at: int, length: int, generated: bool) -> None:
    if generated and length:
        if spans and sum(spans[-1]) == at:
            spans[-1] = (spans[-1][0], spans[-1][1] + length)
        else:
            spans.append((at, length))
