"""Chat formatting with a small compiled template language.

A template has text, ``{{ expression }}``, ``{% for x in expression %}``,
``{% if %}`` / ``{% elif %}`` / ``{% else %}``, ``{% generation %}`` (text the
model learns to produce) and ``{# comments #}``.  Expressions have literals,
names, ``.attributes``, ``+ == != < > and or not``, parentheses and filters.

The source becomes a syntax tree, constant parts are folded, and each node
becomes a Python closure.  Templates are sandboxed: names come from the given
variables, attributes only from dictionaries, filters from a fixed table, and
there are no calls.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import need_columns

TURN_END = "</turn>\n"
TEMPLATE = (
    "{% for turn in turns %}### {{ turn.role | header }}:\n"
    "{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}"
    "{% else %}{{ turn.text | escape }}{% endif %}</turn>\n{% endfor %}"
)
# A formatted conversation is cut into parts of about this size, outside of
# generation, so a long one is never held whole.
PART_CHARS = 1 << 16
MAX_DEPTH = 64


class TemplateError(ValueError):
    """The template cannot be compiled."""


# --- reversible escapes -----------------------------------------------------

_CONTROL = re.compile(r"\\|(?<=#)#|(?<=<)/(?=turn>)")
_HEADER = re.compile(r"[\\#\n\r:<]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_LINE = {"\n": "\\n", "\r": "\\r"}


def escape(text: str) -> str:
    """No ``##`` and no ``</turn>`` is left; every backslash is doubled."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def header(text: str) -> str:
    """As ``escape``, on one line and without a colon."""
    return _HEADER.sub(lambda m: _LINE.get(m[0], "\\" + m[0]), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def unheader(text: str) -> str:
    return _ESCAPED.sub(lambda m: {"n": "\n", "r": "\r"}.get(m[1], m[1]), text)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape,
    "header": header,
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
}

# --- source to tree ---------------------------------------------------------

_PIECE = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:([A-Za-z_]\w*)|(\d+)|'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)"|(==|!=|[+<>|().]))""")
_BINARY = (("or",), ("and",), ("==", "!=", "<", ">"), ("+",))


class _Expression:
    """Recursive descent over one expression's tokens."""

    def __init__(self, source: str) -> None:
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 12]!r}")
            name, number, single, double, sign = m.groups()
            text = single if single is not None else double
            if name:
                self.tokens.append(("name", name))
            elif number:
                self.tokens.append(("const", int(number)))
            elif text is not None:
                self.tokens.append(("const", unheader(text)))
            else:
                self.tokens.append(("sign", sign))
            at = m.end()
        self.at = self.depth = 0

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens):
            kind, value = self.tokens[self.at]
            if kind != "const" and value in wanted:
                self.at += 1
                return value
        return None

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is missing")

    def all(self) -> tuple:
        tree = self.binary(0)
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def binary(self, rank: int) -> tuple:
        self.depth += 1
        if self.depth > MAX_DEPTH * (len(_BINARY) + 2):
            raise TemplateError("the expression is nested too deeply")
        if rank == len(_BINARY):
            tree = self.unary()
        else:
            tree = self.binary(rank + 1)
            while sign := self.take(*_BINARY[rank]):
                tree = (sign, tree, self.binary(rank + 1))
        self.depth -= 1
        return tree

    def unary(self) -> tuple:
        if self.take("not"):
            return ("not", self.binary(2))
        if self.take("("):
            tree = self.binary(0)
            if not self.take(")"):
                raise TemplateError("a parenthesis is not closed")
        elif self.at < len(self.tokens) and self.tokens[self.at][0] == "const":
            tree = self.tokens[self.at]
            self.at += 1
        else:
            tree = ("name", self.name())
        while True:
            if self.take("."):
                tree = ("attribute", tree, self.name())
                if tree[2].startswith("_"):
                    raise TemplateError("attributes do not start with _")
            elif self.take("|"):
                tree = ("filter", tree, self.name())
                if tree[2] not in FILTERS:
                    raise TemplateError(f"no filter {tree[2]}")
            else:
                return tree


def parse(source: str) -> list[tuple]:
    """The template's syntax tree: a list of nodes."""
    pieces, at = [], 0
    for m in _PIECE.finditer(source):
        pieces.append(("text", source[at : m.start()]))
        if m[1] is not None:
            pieces.append(("out", _Expression(m[1]).all()))
        elif m[2] is not None:
            word, _, rest = m[2].strip().partition(" ")
            pieces.append(("tag", word, rest))
        at = m.end()
    pieces.append(("text", source[at:]))
    pieces.reverse()
    tree, end = _body(pieces, (), 0)
    if end is not None:
        raise TemplateError(f"{end[1]} stands alone")
    return tree


def _body(pieces: list, ends: tuple, depth: int) -> tuple[list, tuple | None]:
    if depth > MAX_DEPTH:
        raise TemplateError("blocks are nested too deeply")
    tree = []
    while pieces:
        piece = pieces.pop()
        if piece[0] != "tag":
            tree.append(piece)
        elif piece[1] in ends:
            return tree, piece
        elif piece[1] == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", piece[2], re.S)
            if not m:
                raise TemplateError("for wants: name in expression")
            inner, _ = _body(pieces, ("endfor",), depth + 1)
            tree.append(("for", m[1], _Expression(m[2]).all(), inner))
        elif piece[1] == "if":
            arms, test = [], piece[2]
            while True:
                inner, end = _body(pieces, ("elif", "else", "endif"), depth + 1)
                arms.append((_Expression(test).all(), inner))
                if end[1] == "else":
                    inner, _ = _body(pieces, ("endif",), depth + 1)
                    arms.append((("const", True), inner))
                if end[1] != "elif":
                    break
                test = end[2]
            tree.append(("if", arms))
        elif piece[1] == "generation":
            inner, _ = _body(pieces, ("endgeneration",), depth + 1)
            tree.append(("generation", inner))
        else:
            raise TemplateError(f"unexpected tag {piece[1]}")
    if ends:
        raise TemplateError(f"{' or '.join(ends)} is missing")
    return tree, None


# --- folding ----------------------------------------------------------------


def _text(value) -> str:
    return "" if value is None else str(value)


_WAYS: dict[str, Callable] = {
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
}


def fold_expression(tree: tuple) -> tuple:
    kind = tree[0]
    if kind in ("name", "const"):
        return tree
    if kind == "attribute":
        return (kind, fold_expression(tree[1]), tree[2])
    if kind == "filter":
        inner = fold_expression(tree[1])
        return ("const", FILTERS[tree[2]](_text(inner[1]))) if inner[0] == "const" else (kind, inner, tree[2])
    if kind == "not":
        inner = fold_expression(tree[1])
        return ("const", not inner[1]) if inner[0] == "const" else (kind, inner)
    left, right = fold_expression(tree[1]), fold_expression(tree[2])
    if kind in ("and", "or"):
        if left[0] == "const":
            return right if bool(left[1]) == (kind == "and") else left
    elif left[0] == right[0] == "const":
        return ("const", _WAYS[kind](left[1], right[1]))
    return (kind, left, right)


def fold(tree: list[tuple]) -> list[tuple]:
    """The same template with constants worked out and neighbouring text joined."""
    out: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in tree:
        if node[0] == "out":
            inner = fold_expression(node[1])
            add(("text", _text(inner[1])) if inner[0] == "const" else ("out", inner))
        elif node[0] == "for":
            add(("for", node[1], fold_expression(node[2]), fold(node[3])))
        elif node[0] == "generation":
            add(("generation", fold(node[1])))
        elif node[0] == "if":
            arms = []
            for test, inner in node[1]:
                test = fold_expression(test)
                if test[0] == "const" and not test[1]:
                    continue
                arms.append((test, fold(inner)))
                if test[0] == "const":
                    break
            if arms and arms[0][0][0] == "const":
                for inner in arms[0][1]:
                    add(inner)
            elif arms:
                add(("if", arms))
        else:
            add(node)
    return out


# --- tree to closures -------------------------------------------------------

Env = dict
Render = Callable[[Env, bool], Iterator[tuple[str, bool]]]


def _value(tree: tuple) -> Callable[[Env], object]:
    kind = tree[0]
    if kind == "const":
        return lambda env, v=tree[1]: v
    if kind == "name":
        return lambda env, k=tree[1]: env.get(k)
    if kind == "attribute":
        inner = _value(tree[1])

        def attribute(env: Env, key=tree[2]):
            owner = inner(env)
            return owner.get(key) if isinstance(owner, dict) else None

        return attribute
    if kind == "filter":
        inner, way = _value(tree[1]), FILTERS[tree[2]]
        return lambda env: way(_text(inner(env)))
    if kind == "not":
        inner = _value(tree[1])
        return lambda env: not inner(env)
    left, right = _value(tree[1]), _value(tree[2])
    if kind == "and":
        return lambda env: left(env) and right(env)
    if kind == "or":
        return lambda env: left(env) or right(env)
    way = _WAYS[kind]
    return lambda env: way(left(env), right(env))


def _sequence(tree: list[tuple]) -> Render:
    parts = [_node(node) for node in tree]

    def render(env: Env, learned: bool) -> Iterator[tuple[str, bool]]:
        for part in parts:
            yield from part(env, learned)

    return render


def _node(node: tuple) -> Render:
    kind = node[0]
    if kind == "text":

        def render(env, learned, text=node[1]):
            yield text, learned

    elif kind == "out":
        value = _value(node[1])

        def render(env, learned):
            yield _text(value(env)), learned

    elif kind == "generation":
        inner = _sequence(node[1])

        def render(env, learned):
            yield from inner(env, True)

    elif kind == "for":
        items, inner, name = _value(node[2]), _sequence(node[3]), node[1]

        def render(env, learned):
            for i, item in enumerate(items(env) or ()):
                yield from inner({**env, name: item, "loop": {"index": i + 1, "first": i == 0}}, learned)

    else:
        arms = [(_value(test), _sequence(inner)) for test, inner in node[1]]

        def render(env, learned):
            for test, inner in arms:
                if test(env):
                    yield from inner(env, learned)
                    break

    return render


def compile_template(source: str) -> Callable[[Env], Iterator[tuple[str, bool]]]:
    """A function of the variables that yields (text, inside generation) piece by piece."""
    render = _sequence(fold(parse(source)))
    return lambda env: render(env, False)


# --- on tables --------------------------------------------------------------

PART = "conv_id long, part long, formatted string, loss array<struct<start: long, end: long>>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _parts(pieces: Iterator[tuple[str, bool]]) -> Iterator[tuple[str, list]]:
    text, size, spans = [], 0, []
    for piece, learned in pieces:
        if size > PART_CHARS and not learned:
            yield "".join(text), spans
            text, size, spans = [], 0, []
        if learned and piece:
            spans.append({"start": size, "end": size + len(piece)})
        text.append(piece)
        size += len(piece)
    yield "".join(text), spans


def _in_batches(rows: Iterator[tuple], types: list, names: list[str], chars) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names
        )

    for row in rows:
        held.append(row)
        size += chars(row)
        if size > 1 << 22 or len(held) >= 5000:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _format(template: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def rows():
            turns = _rows(batches, "conv_id", "role", "text")
            for conv, own in groupby(turns, key=lambda r: r[0]):
                # The turns stream through the template's loop.
                said = ({"role": role or "", "text": text or ""} for _, role, text in own)
                for k, (text, spans) in enumerate(_parts(render({"turns": said}))):
                    yield conv, k, text, spans

        types = [pa.int64(), pa.int64(), pa.string(), _SPAN]
        yield from _in_batches(rows(), types, ["conv_id", "part", "formatted", "loss"], lambda r: len(r[2]))

    return run


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Rows (conv_id, part, formatted, loss): the rendered text of every conversation.

    Turns go by number, then role and text; a null turn comes first, a null
    role or text is empty, and rows with a null conv_id are one conversation.
    ``loss`` has the code-point spans inside generation.  Turns are read in
    order from sorted partitions, so a long conversation is never held whole;
    repeated rows are repeated turns.  Other columns are ignored.
    """
    need_columns(conversations, "conv_id", "turn", "role", "text")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    order = ("conv_id", "turn", "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions(*order)
    return rows.mapInArrow(_format(template), PART)


_TURN = re.compile(r"### ((?:[^\\:\n]|\\.)*):\n(.*?)</turn>\n", re.S)


class _Digest:
    """What is read back of one conversation."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0
        self.rest = ""

    def add(self, text: str, spans: list) -> None:
        self.chars += len(text)
        for span in spans:
            own = unescape(text[span["start"] : span["end"]])
            self.loss_chars += len(own)
            self.loss.update(own.encode())
        self.rest += text
        if TURN_END not in self.rest:
            return
        at = 0
        while m := _TURN.match(self.rest, at):
            said = f"{unheader(m[1])}\n{unescape(m[2])}\n"
            self.turns.update(said.encode())
            self.n += 1
            at = m.end()
        self.rest = self.rest[at:]


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        parts = _rows(batches, "conv_id", "formatted", "loss")
        for conv, own in groupby(parts, key=lambda r: r[0]):
            digest = _Digest()
            for _, text, spans in own:
                digest.add(text, spans or [])
            if digest.rest:
                raise ValueError(f"conversation {conv}: {digest.rest[:60]!r} is no turn")
            yield (
                conv,
                digest.n,
                digest.turns.hexdigest(),
                digest.loss_chars,
                digest.loss.hexdigest(),
                digest.chars,
            )

    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    yield from _in_batches(rows(), types, names, lambda r: 0)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of formatted conversations (default template), taken from their text alone.

    The parts of a conversation must lie in one partition in order, as
    ``format_conversations`` leaves them.
    """
    return formatted.mapInArrow(
        _read_back,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
