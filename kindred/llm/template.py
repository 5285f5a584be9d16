"""A small sandboxed template language, compiled to Python closures.

``{{ expr }}`` writes a value, ``{% if e %}..{% elif e %}..{% else %}..{% endif %}`` and
``{% for x in e %}..{% endfor %}`` control, ``{% generation %}..{% endgeneration %}`` marks what a
model is trained to write. Expressions are strings, numbers, names, ``a.b``, ``a | filter``,
``+ == != and or not`` and brackets. They reach nothing but the given variables and the given
filters: an attribute is a key of a mapping, and there are no calls.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Op:
    """An operator or filter over parts."""

    name: str
    parts: tuple


@dataclass(frozen=True)
class Write:
    value: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_TOKEN = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[+.|()]))""")
_ESCAPES = {"n": "\n", "t": "\t"}
_BINARY = {
    "+": lambda a, b: a + b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
}
_LEVELS = (("or",), ("and",), ("==", "!="), ("+",))


class _Expression:
    def __init__(self, source: str):
        self.tokens, at = [], 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append(next((i, t) for i, t in enumerate(m.groups()) if t is not None))
            at = m.end()
        self.tokens.reverse()

    def take(self, *texts: str) -> str | None:
        if self.tokens and self.tokens[-1][0] > 0 and self.tokens[-1][1] in texts:
            return self.tokens.pop()[1]
        return None

    def parse(self):
        out = self.binary(0)
        if self.tokens:
            raise TemplateError(f"unexpected {self.tokens[-1][1]!r}")
        return out

    def binary(self, level: int):
        if level == len(_LEVELS):
            return self.unary()
        out = self.binary(level + 1)
        while name := self.take(*_LEVELS[level]):
            out = Op(name, (out, self.binary(level + 1)))
        return out

    def unary(self):
        if self.take("not"):
            return Op("not", (self.unary(),))
        if self.take("("):
            out = self.binary(0)
            if not self.take(")"):
                raise TemplateError("missing )")
        else:
            out = self.atom()
        while name := self.take(".", "|"):
            if not self.tokens or self.tokens[-1][0] != 2:
                raise TemplateError(f"a name must follow {name}")
            word = self.tokens.pop()[1]
            out = Op(".", (out, Const(word))) if name == "." else Op(f"|{word}", (out,))
        return out

    def atom(self):
        if not self.tokens:
            raise TemplateError("missing value")
        kind, text = self.tokens.pop()
        if kind == 0:
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1]))
        if kind == 1:
            return Const(int(text))
        if kind == 2:
            return Name(text)
        raise TemplateError(f"unexpected {text!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    pieces = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", source, flags=re.S)
    pieces.reverse()

    def body(*stops: str) -> tuple[tuple, str]:
        out = []
        while pieces:
            piece = pieces.pop()
            if piece.startswith("{{"):
                out.append(Write(_Expression(piece[2:-2]).parse()))
            elif piece.startswith("{%"):
                word, _, rest = piece[2:-2].strip().partition(" ")
                if word in stops:
                    pieces.append(piece)
                    return tuple(out), word
                out.append(block(word, rest))
            elif piece:
                out.append(Write(Const(piece)))
        if stops:
            raise TemplateError(f"missing {stops[-1]}")
        return tuple(out), ""

    def block(word: str, rest: str):
        if word == "if":
            then, stop = body("elif", "else", "endif")
            piece = pieces.pop()
            if stop == "elif":
                return If(_Expression(rest).parse(), then, (block("if", piece[2:-2].strip()[4:]),))
            other = ()
            if stop == "else":
                other, _ = body("endif")
                pieces.pop()
            return If(_Expression(rest).parse(), then, other)
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
            if not m:
                raise TemplateError(f"cannot read for {rest}")
            inner, _ = body("endfor")
            pieces.pop()
            return For(m[1], _Expression(m[2]).parse(), inner)
        if word == "generation":
            inner, _ = body("endgeneration")
            pieces.pop()
            return Generation(inner)
        raise TemplateError(f"unknown block {word}")

    return body()[0]


def _apply(op: str, values: list, filters: dict[str, Callable]):
    if op == ".":
        if not isinstance(values[0], dict) or values[1] not in values[0]:
            raise TemplateError(f"no {values[1]} here")
        return values[0][values[1]]
    if op == "not":
        return not values[0]
    if op[0] == "|":
        if op[1:] not in filters:
            raise TemplateError(f"unknown filter {op[1:]}")
        return filters[op[1:]](values[0])
    return _BINARY[op](*values)


def fold(node, filters: dict[str, Callable]):
    """The tree with constant expressions computed, dead branches gone and texts joined."""
    if isinstance(node, Op):
        parts = tuple(fold(p, filters) for p in node.parts)
        if all(isinstance(p, Const) for p in parts):
            return Const(_apply(node.name, [p.value for p in parts], filters))
        if node.name in ("and", "or") and isinstance(parts[0], Const):
            return parts[1] if bool(parts[0].value) == (node.name == "and") else parts[0]
        return Op(node.name, parts)
    if isinstance(node, tuple):
        out = []
        for child in node:
            child = fold(child, filters)
            if isinstance(child, If) and isinstance(child.test, Const):
                children = child.then if child.test.value else child.other
            else:
                children = (child,)
            for c in children:
                constant = isinstance(c, Write) and isinstance(c.value, Const)
                if constant and out and isinstance(out[-1], Write) and isinstance(out[-1].value, Const):
                    out[-1] = Write(Const(str(out[-1].value.value) + str(c.value.value)))
                else:
                    out.append(c)
        return tuple(out)
    if isinstance(node, Write):
        return Write(fold(node.value, filters))
    if isinstance(node, If):
        return If(fold(node.test, filters), fold(node.then, filters), fold(node.other, filters))
    if isinstance(node, For):
        return For(node.name, fold(node.over, filters), fold(node.body, filters))
    if isinstance(node, Generation):
        return Generation(fold(node.body, filters))
    return node


def _closure(node, filters: dict[str, Callable]) -> Callable:
    """Expressions: names -> value. Statements: (names, out, spans) -> None."""
    if isinstance(node, Const):
        return lambda names, value=node.value: value
    if isinstance(node, Name):

        def look_up(names, name=node.name):
            if name not in names:
                raise TemplateError(f"unknown name {name}")
            return names[name]

        return look_up
    if isinstance(node, Op):
        parts = [_closure(p, filters) for p in node.parts]
        if node.name in ("and", "or"):
            a, b = parts
            if node.name == "and":
                return lambda names: a(names) and b(names)
            return lambda names: a(names) or b(names)
        return lambda names, op=node.name: _apply(op, [p(names) for p in parts], filters)
    if isinstance(node, tuple):
        steps = [_closure(n, filters) for n in node]

        def run(names, out, spans):
            for step in steps:
                step(names, out, spans)

        return run
    if isinstance(node, Write):
        value = _closure(node.value, filters)

        def write(names, out, spans):
            out.add(str(value(names)))

        return write
    if isinstance(node, If):
        test, then, other = (_closure(n, filters) for n in (node.test, node.then, node.other))
        return lambda names, out, spans: (then if test(names) else other)(names, out, spans)
    if isinstance(node, For):
        over, inner = _closure(node.over, filters), _closure(node.body, filters)

        def loop(names, out, spans, name=node.name):
            for item in over(names):
                inner({**names, name: item}, out, spans)

        return loop
    inner = _closure(node.body, filters)

    def generation(names, out, spans):
        start = out.size
        inner(names, out, spans)
        spans.append((start, out.size))

    return generation


class _Out:
    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def compile_template(source: str, filters: dict[str, Callable] | None = None) -> Callable:
    """A function from variables to (text, spans of generated text in code points)."""
    filters = filters or {}
    run = _closure(fold(parse(source), filters), filters)

    def render(**names):
        out, spans = _Out(), []
        run(names, out, spans)
        return "".join(out.parts), spans

    return render
