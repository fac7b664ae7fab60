"""Chat formatting: a small sandboxed template language, compiled to Python closures.

A template is text with ``{{ expression }}`` and blocks::

    {% for turn in turns %} ... {% end %}      once for each turn
    {% if a %} ... {% elif b %} ... {% else %} ... {% end %}
    {% generation %} ... {% end %}             what is inside is under the loss mask

Expressions know text in double quotes, ``turn.role``, ``turn.text``, ``turn.index``,
``turn.first``, ``+`` (join), ``==``, ``!=``, ``not``, ``and``, ``or``, parentheses and
filters (``x | escape``). Nothing else exists: no attributes, calls or loops of a
template's own, so a template can neither reach Python nor run for ever.

``parse`` gives a syntax tree, ``fold`` works out what does not depend on a turn and joins
neighbouring text, ``compile_template`` turns the tree into closures. A compiled template
renders turn by turn, so the longest conversation needs the memory of one turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import or_empty

# --- The production template and the strings that mark its turns. ---
END_OF_TURN = "</turn>"
START_OF_TURN = "### "
TEMPLATE = (
    '{% for turn in turns %}{{ "### " + (turn.role | line) + "\n" }}'
    '{% if turn.role == "assistant" %}{% generation %}{{ turn.text | escape }}{% end %}'
    '{% else %}{{ turn.text | escape }}{% end %}{{ "\n</turn>\n" }}{% end %}'
)

_CONTROL = re.compile(rf"(?={re.escape(START_OF_TURN)}|{re.escape(END_OF_TURN)})")
_ESCAPED = re.compile(rf"\\(?={re.escape(START_OF_TURN)}|{re.escape(END_OF_TURN)})")


def escape(text: str) -> str:
    """A backslash before every control string. A control string with k backslashes before
    it gets k + 1, so the step can be undone, and none is left without one."""
    return _CONTROL.sub(r"\\", text)


def unescape(text: str) -> str:
    """One backslash less before every control string."""
    return _ESCAPED.sub("", text)


def line(text: str) -> str:
    """Text on one line, reversibly."""
    return text.replace("%", "%25").replace("\n", "%0A")


def unline(text: str) -> str:
    return text.replace("%0A", "\n").replace("%25", "%")


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "line": line, "trim": str.strip, "upper": str.upper}


class TemplateError(ValueError):
    pass


# --- Syntax tree ---
@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Name:
    path: str


@dataclass(frozen=True)
class Op:
    kind: str  # + == != and or not filter:<name>
    args: tuple


@dataclass(frozen=True)
class Show:
    value: object


@dataclass(frozen=True)
class Choice:
    arms: tuple  # of (condition, body); the last condition may be Text("1")


@dataclass(frozen=True)
class Loop:
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_PIECE = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r'\s*(?:"((?:[^"\\]|\\.)*)"|([A-Za-z_][\w.]*)|(==|!=|[+|()]))', re.S)
_NAMES = {"turn.role", "turn.text", "turn.index", "turn.first"}


def _words(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        at = m.end()
        if m[1] is not None:
            out.append(("text", re.sub(r"\\(.)", lambda e: {"n": "\n", "t": "\t"}.get(e[1], e[1]), m[1], flags=re.S)))
        else:
            out.append(("name", m[2]) if m[2] else ("mark", m[3]))
    return out


class _Expression:
    """Recursive descent: or, and, not, comparison, +, filters, atoms."""

    def __init__(self, source: str):
        self.words, self.at = _words(source), 0

    def next_is(self, *values: str) -> bool:
        return self.at < len(self.words) and self.words[self.at][0] != "text" and self.words[self.at][1] in values

    def take(self) -> tuple[str, str]:
        if self.at >= len(self.words):
            raise TemplateError("an expression ends too early")
        self.at += 1
        return self.words[self.at - 1]

    def read(self):
        e = self.either()
        if self.at != len(self.words):
            raise TemplateError(f"unexpected {self.words[self.at][1]!r}")
        return e

    def _joined(self, kinds: tuple[str, ...], below):
        e = below()
        while self.next_is(*kinds):
            kind = self.take()[1]
            e = Op(kind, (e, below()))
        return e

    def either(self):
        return self._joined(("or",), self.both)

    def both(self):
        return self._joined(("and",), self.negated)

    def negated(self):
        if self.next_is("not"):
            self.take()
            return Op("not", (self.negated(),))
        return self._joined(("==", "!="), self.total)

    def total(self):
        return self._joined(("+",), self.filtered)

    def filtered(self):
        e = self.atom()
        while self.next_is("|"):
            self.take()
            name = self.take()[1]
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            e = Op(f"filter:{name}", (e,))
        return e

    def atom(self):
        kind, value = self.take()
        if kind == "text":
            return Text(value)
        if kind == "name" and value in _NAMES:
            return Name(value)
        if value == "(":
            e = self.either()
            if self.take()[1] != ")":
                raise TemplateError("a parenthesis is not closed")
            return e
        raise TemplateError(f"unknown {value!r}")


def parse(source: str) -> tuple:
    """Syntax tree of a template; ``TemplateError`` says what is wrong."""
    pieces: list[tuple[str, str]] = []
    at = 0
    for m in _PIECE.finditer(source):
        if m.start() > at:
            pieces.append(("text", source[at:m.start()]))
        pieces.append(("show", m[1]) if m[1] is not None else ("block", m[2].strip()))
        at = m.end()
    if at < len(source):
        pieces.append(("text", source[at:]))
    position = 0

    def body(depth: str) -> tuple[tuple, str]:
        nonlocal position
        out = []
        while position < len(pieces):
            kind, value = pieces[position]
            position += 1
            if kind == "text":
                out.append(Show(Text(value)))
            elif kind == "show":
                out.append(Show(_Expression(value).read()))
            elif value == "end" or value == "else" or value.startswith("elif "):
                if not depth or (value != "end" and depth != "if"):
                    raise TemplateError(f"unexpected {{% {value} %}}")
                return tuple(out), value
            elif value == "generation":
                out.append(Generation(body("generation")[0]))
            elif value == "for turn in turns":
                if depth:
                    raise TemplateError("the loop must stand at the top")
                out.append(Loop(body("for")[0]))
            elif value.startswith("if "):
                arms, test = [], value[3:]
                while True:
                    inner, ended = body("if")
                    arms.append((_Expression(test).read() if test else Text("1"), inner))
                    if ended == "end":
                        break
                    if not test:
                        raise TemplateError("nothing may follow {% else %}")
                    test = ended[5:] if ended.startswith("elif ") else ""
                out.append(Choice(tuple(arms)))
            else:
                raise TemplateError(f"unknown block {{% {value} %}}")
        if depth:
            raise TemplateError(f"{{% {depth} %}} is not closed")
        return tuple(out), ""

    tree = body("")[0]
    if sum(isinstance(n, Loop) for n in tree) > 1:
        raise TemplateError("a template has one loop at most")
    return tree


def _truth(value: str) -> str:
    return "1" if value else ""


_FOLD: dict[str, Callable[..., str]] = {
    "+": lambda a, b: a + b, "==": lambda a, b: _truth(a == b), "!=": lambda a, b: _truth(a != b),
    "and": lambda a, b: a and b, "or": lambda a, b: a or b, "not": lambda a: _truth(not a),
}


def _apply(kind: str) -> Callable[..., str]:
    return FILTERS[kind[7:]] if kind.startswith("filter:") else _FOLD[kind]


def fold_expression(e):
    if not isinstance(e, Op):
        return e
    args = tuple(fold_expression(a) for a in e.args)
    if all(isinstance(a, Text) for a in args):
        return Text(_apply(e.kind)(*(a.value for a in args)))
    return Op(e.kind, args)


def fold(body: tuple) -> tuple:
    """The same template with constants worked out, dead branches gone, text joined."""
    out: list = []

    def put(node) -> None:
        if isinstance(node, Show) and isinstance(node.value, Text):
            if not node.value.value:
                return
            if out and isinstance(out[-1], Show) and isinstance(out[-1].value, Text):
                out[-1] = Show(Text(out[-1].value.value + node.value.value))
                return
        out.append(node)

    for node in body:
        if isinstance(node, Show):
            put(Show(fold_expression(node.value)))
        elif isinstance(node, Choice):
            arms = []
            for test, inner in node.arms:
                test = fold_expression(test)
                if isinstance(test, Text) and not test.value:
                    continue
                arms.append((test, fold(inner)))
                if isinstance(test, Text):
                    break
            if arms and isinstance(arms[0][0], Text):
                for inner in arms[0][1]:
                    put(inner)
            elif arms:
                put(Choice(tuple(arms)))
        else:
            put(type(node)(fold(node.body)))
    return tuple(out)


# --- Closures ---
Turn = tuple[str, str, int]  # role, text, index
Emit = Callable[[str, bool], None]


def _value(e) -> Callable[[Turn], str]:
    if isinstance(e, Text):
        value = e.value
        return lambda turn: value
    if isinstance(e, Name):
        return {
            "turn.role": lambda turn: turn[0], "turn.text": lambda turn: turn[1],
            "turn.index": lambda turn: str(turn[2]), "turn.first": lambda turn: _truth(turn[2] == 0),
        }[e.path]
    work = _apply(e.kind)
    if len(e.args) == 1:
        only = _value(e.args[0])
        return lambda turn: work(only(turn))
    left, right = map(_value, e.args)
    return lambda turn: work(left(turn), right(turn))


def _code(body: tuple, masked: bool = False) -> Callable[[Turn, Emit], None]:
    steps = []
    for node in body:
        if isinstance(node, Show):
            steps.append(lambda turn, emit, v=_value(node.value): emit(v(turn), masked))
        elif isinstance(node, Generation):
            steps.append(_code(node.body, True))
        elif isinstance(node, Choice):
            arms = [(_value(test), _code(inner, masked)) for test, inner in node.arms]

            def choose(turn, emit, arms=arms):
                for test, inner in arms:
                    if test(turn):
                        return inner(turn, emit)

            steps.append(choose)

    def run(turn: Turn, emit: Emit) -> None:
        for step in steps:
            step(turn, emit)

    return run


_NO_TURN: Turn = ("", "", 0)


@dataclass
class Template:
    """``head()``, ``turn(...)`` for each turn, ``tail()``: each gives its text and the
    ``(start, end)`` of its parts under the loss mask, in code points of that text."""

    source: str
    _parts: tuple = field(init=False, repr=False)

    def __post_init__(self) -> None:
        tree = fold(parse(self.source))
        at = next((i for i, n in enumerate(tree) if isinstance(n, Loop)), len(tree))
        inner = tree[at].body if at < len(tree) else ()
        self._parts = (_code(tree[:at]), _code(inner), _code(tree[at + 1:]))

    def _render(self, part: int, turn: Turn) -> tuple[str, list[tuple[int, int]]]:
        out: list[str] = []
        spans: list[tuple[int, int]] = []
        at = 0

        def emit(text: str, masked: bool) -> None:
            nonlocal at
            if text:
                out.append(text)
                if masked:
                    spans.append((at, at + len(text)))
                at += len(text)

        self._parts[part](turn, emit)
        return "".join(out), spans

    def head(self):
        return self._render(0, _NO_TURN)

    def turn(self, role: str, text: str, index: int):
        return self._render(1, (role, text, index))

    def tail(self):
        return self._render(2, _NO_TURN)

    def render(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """A whole conversation at once."""
        out, spans, at = "", [], 0
        for text, inner in [self.head(), *(self.turn(r, t, i) for i, (r, t) in enumerate(turns)), self.tail()]:
            spans += [(a + at, b + at) for a, b in inner]
            out += text
            at += len(text)
        return out, spans


def compile_template(source: str = TEMPLATE) -> Template:
    return Template(source)


_STOP = f"\n{END_OF_TURN}\n"


def read_back(formatted: str) -> Iterator[tuple[str, str]]:
    """Turns (role, text) out of what the production template made."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(START_OF_TURN, at):
            raise ValueError(f"no turn begins at {at}")
        head = formatted.index("\n", at)
        end = formatted.index(_STOP, head)
        yield unline(formatted[at + len(START_OF_TURN):head]), unescape(formatted[head + 1:end])
        at = end + len(_STOP)


PIECES = "conv_id long, piece long, formatted string, loss array<struct<start:long,end:long>>"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def _ordered(conversations: DataFrame) -> DataFrame:
    """A conversation's rows one after the other, by turn. Rows stream through a task, so
    a conversation of any length needs no memory of its size."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                or_empty("role").alias("role"), or_empty("text").alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*[F.asc_nulls_first(c) for c in order])


def _rendered(batches, source: str):
    """``(conv_id, piece number, text, spans, is last)`` for pieces in order; spans count
    from the beginning of the conversation."""
    template = compile_template(source)
    current, number, at, begun = None, 0, 0, False

    def piece(made, last=False):
        nonlocal number, at
        text, spans = made
        out = (current, number, text, [(a + at, b + at) for a, b in spans], last)
        number, at = number + 1, at + len(text)
        return out

    for batch in batches:
        cols = batch.to_pydict()
        for conv, role, text in zip(cols["conv_id"], cols["role"], cols["text"]):
            if not begun or conv != current:
                if begun:
                    yield piece(template.tail(), True)
                current, number, at, begun, index = conv, 0, 0, True, 0
                yield piece(template.head())
            yield piece(template.turn(role, text, index))
            index += 1
    if begun:
        yield piece(template.tail(), True)


def format_pieces(conversations: DataFrame, source: str = TEMPLATE) -> DataFrame:
    """``conv_id, piece, formatted, loss``: a conversation's formatted text in order of
    ``piece`` (head, one for each turn, tail), with its parts under the loss mask.

    Null role or text is empty; rows of null ``conv_id`` are one conversation; equal turns
    are ordered by role, then text; repeated rows are repeated turns; an empty table gives
    no rows. Other columns are ignored.
    """
    def run(batches):
        rows = []
        for conv, number, text, spans, _ in _rendered(batches, source):
            rows.append({"conv_id": conv, "piece": number, "formatted": text,
                         "loss": [{"start": a, "end": b} for a, b in spans]})
            if len(rows) >= 1000:
                yield pa.RecordBatch.from_pylist(rows, _PIECE_SCHEMA)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _PIECE_SCHEMA)

    return _ordered(conversations).mapInArrow(run, PIECES)


_PIECE_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("piece", pa.int64()), ("formatted", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
_DIGEST_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def format_digests(conversations: DataFrame) -> DataFrame:
    """What a reader finds in the formatted text of each conversation (see ``op1``): its
    turns and its text under the loss mask. Same rules as ``format_pieces``."""
    def run(batches):
        rows, fresh = [], True
        for conv, _, text, spans, last in _rendered(batches, TEMPLATE):
            if fresh:
                base, n, chars = 0, 0, 0
                turns, loss, fresh = hashlib.sha256(), hashlib.sha256(), False
            for role, said in read_back(text):
                turns.update(f"{role}\n{said}\n".encode())
                n += 1
            for a, b in spans:
                part = unescape(text[a - base:b - base])
                loss.update(part.encode())
                chars += len(part)
            base += len(text)
            if last:
                rows.append({"conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars,
                             "loss_sha256": loss.hexdigest(), "formatted_chars": base})
                fresh = True
            if len(rows) >= 5000:
                yield pa.RecordBatch.from_pylist(rows, _DIGEST_SCHEMA)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _DIGEST_SCHEMA)

    return _ordered(conversations).mapInArrow(run, DIGESTS)
