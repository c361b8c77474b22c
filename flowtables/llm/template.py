"""A small sandboxed template language compiled to closures.

    text {{ expression }} {% for m in messages %} ... {% endfor %}
    {% if expression %} ... {% elif expression %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}

Expressions are strings, whole numbers, ``true``/``false``, names, ``name.field``, ``==``, ``!=``, ``+``, ``and``,
``or``, ``not``, brackets and ``| filter``. Fields are looked up in the values given for a message or in
``loop`` (``first``, ``last``, ``index``), never on Python objects, and filters are those of ``FILTERS``, so a
template can reach nothing else. Sources are parsed into a tree, constant parts are folded, and
every node becomes a closure that yields (text, is generated) segments; messages may be any iterator.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

Segments = Iterator[tuple[str, bool]]


class TemplateError(ValueError):
    """The source is not of the language, or a value is missing."""


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    base: str
    field: str


@dataclass(frozen=True)
class Apply:
    """An operator or a filter."""

    what: str
    parts: tuple


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class For:
    name: str
    source: str
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple  # (condition, body); the last condition may be Const(True)


@dataclass(frozen=True)
class Generation:
    body: tuple


ESCAPED = re.compile(r"([\[<\\])\\")


def escape(text: str) -> str:
    """``text`` in which no control string of the form ``[...]`` or ``<...>`` can stand."""
    return text.replace("\\", "\\\\").replace("[", "[\\").replace("<", "<\\")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape,
    "trim": lambda text: text.strip(" \t\n\r\f\v"),
    "upper": str.upper,
    "lower": str.lower,
}
OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "+": lambda a, b: a + b,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "not": lambda a: not a,
}
PART = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.S)
TOKEN = re.compile(r"""\s*(?:("[^"]*"|'[^']*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[+|().]))""")


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            found = TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append(found)
            at = found.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][0].strip() if self.at < len(self.tokens) else None

    def take(self, wanted: str | None = None) -> re.Match:
        if self.at == len(self.tokens) or wanted not in (None, self.peek()):
            raise TemplateError(f"{wanted or 'a value'} is missing")
        self.at += 1
        return self.tokens[self.at - 1]

    def whole(self):
        tree = self.chain(("or", "and", "==", "+"))
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.peek()} is left over")
        return tree

    def chain(self, levels: tuple[str, ...]):
        if not levels:
            return self.filtered()
        if levels[0] == "==" and self.peek() == "not":
            self.take()
            return Apply("not", (self.chain(levels),))
        tree = self.chain(levels[1:])
        same = ("==", "!=") if levels[0] == "==" else levels[:1]
        while self.peek() in same:
            tree = Apply(self.take()[0].strip(), (tree, self.chain(levels[1:])))
        return tree

    def filtered(self):
        tree = self.atom()
        while self.peek() == "|":
            self.take()
            name = self.take()[3]
            if name not in FILTERS:
                raise TemplateError(f"no filter {name}")
            tree = Apply(name, (tree,))
        return tree

    def atom(self):
        token = self.take()
        if token[1] is not None:
            return Const(token[1][1:-1])
        if token[2] is not None:
            return Const(int(token[2]))
        if token[3] in ("true", "false"):
            return Const(token[3] == "true")
        if token[3] is not None:
            if self.peek() == ".":
                self.take()
                return Field(token[3], self.take()[3] or "")
            return Name(token[3])
        if token[4] == "(":
            tree = self.chain(("or", "and", "==", "+"))
            self.take(")")
            return tree
        raise TemplateError(f"{token[0].strip()} is out of place")


def parse(source: str) -> tuple:
    """Syntax tree of a template: a tuple of nodes."""
    parts, at = PART.split(source), 0

    def body(ends: tuple[str, ...]) -> tuple[tuple, str]:
        nonlocal at
        nodes = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                nodes.append(Output(_Expression(part[2:-2]).whole()))
            elif not part.startswith("{%"):
                nodes.append(Output(Const(part)))
            else:
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in ends:
                    at -= 1
                    return tuple(nodes), word
                nodes.append(block(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(nodes), ""

    def statement() -> str:
        nonlocal at
        at += 1
        return parts[at - 1][2:-2].strip().partition(" ")[2]

    def block(word: str, rest: str):
        if word == "for":
            found = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+([A-Za-z_]\w*)", rest.strip())
            if not found:
                raise TemplateError(f"for {rest}")
            inner, _ = body(("endfor",))
            statement()
            return For(found[1], found[2], inner)
        if word == "generation":
            inner, _ = body(("endgeneration",))
            statement()
            return Generation(inner)
        if word == "if":
            branches, condition = [], _Expression(rest).whole()
            while True:
                inner, end = body(("elif", "else", "endif"))
                branches.append((condition, inner))
                text = statement()
                if end == "endif":
                    return If(tuple(branches))
                condition = Const(True) if end == "else" else _Expression(text).whole()
        raise TemplateError(f"no statement {word}")

    return body(())[0]


def folded(node):
    """The same tree with constant expressions computed, dead branches gone and texts joined."""
    if isinstance(node, tuple):
        out: list = []
        for part in map(folded, node):
            for one in part if isinstance(part, tuple) else (part,):
                text = isinstance(one, Output) and isinstance(one.value, Const)
                if text and one.value.value == "":
                    continue
                if text and out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                    out[-1] = Output(Const(str(out[-1].value.value) + str(one.value.value)))
                else:
                    out.append(one)
        return tuple(out)
    if isinstance(node, Output):
        return Output(folded(node.value))
    if isinstance(node, Apply):
        parts = tuple(folded(p) for p in node.parts)
        if all(isinstance(p, Const) for p in parts):
            return Const(_function(node.what)(*[p.value for p in parts]))
        return Apply(node.what, parts)
    if isinstance(node, For):
        return For(node.name, node.source, folded(node.body))
    if isinstance(node, Generation):
        return Generation(folded(node.body))
    if isinstance(node, If):
        branches = []
        for condition, inner in node.branches:
            condition = folded(condition)
            if isinstance(condition, Const) and not condition.value:
                continue
            branches.append((condition, folded(inner)))
            if isinstance(condition, Const):
                break
        if branches and isinstance(branches[0][0], Const):
            return branches[0][1]
        return If(tuple(branches)) if branches else ()
    return node


def _function(what: str) -> Callable:
    return OPERATORS[what] if what in OPERATORS else FILTERS[what]


def _value(node) -> Callable[[dict], object]:
    """Closure that computes an expression in an environment."""
    if isinstance(node, Const):
        return lambda env, value=node.value: value
    if isinstance(node, Name):

        def name(env, key=node.name):
            if key not in env or not isinstance(env[key], str | int | bool):
                raise TemplateError(f"no value {key}")
            return env[key]

        return name
    if isinstance(node, Field):

        def field(env, base=node.base, key=node.field):
            found = env.get(base)
            if not isinstance(found, dict) or key not in found:
                raise TemplateError(f"no value {base}.{key}")
            return found[key]

        return field
    parts, what = [_value(p) for p in node.parts], node.what
    if what == "and":
        return lambda env: parts[0](env) and parts[1](env)
    if what == "or":
        return lambda env: parts[0](env) or parts[1](env)
    function = _function(what)
    if len(parts) == 1:
        return lambda env: function(parts[0](env))
    return lambda env: function(parts[0](env), parts[1](env))


def _body(nodes: tuple) -> Callable[[dict, bool], Segments]:
    steps = [_step(n) for n in nodes]

    def run(env: dict, generated: bool) -> Segments:
        for step in steps:
            yield from step(env, generated)

    return run


def _step(node) -> Callable[[dict, bool], Segments]:
    if isinstance(node, Output):
        value = _value(node.value)

        def output(env, generated):
            yield str(value(env)), generated

        return output
    inner = None if isinstance(node, If) else _body(node.body)
    if isinstance(node, Generation):
        return lambda env, generated: inner(env, True)
    if isinstance(node, For):

        def loop(env, generated):
            items, index = iter(env[node.source]), 0
            current = next(items, None)
            while current is not None:
                following = next(items, None)
                flags = {"first": index == 0, "last": following is None, "index": index + 1}
                yield from inner({**env, node.name: current, "loop": flags}, generated)
                current, index = following, index + 1

        return loop
    branches = [(_value(condition), _body(inner)) for condition, inner in node.branches]

    def choose(env, generated):
        for condition, inner in branches:
            if condition(env):
                yield from inner(env, generated)
                return

    return choose


def compiled(source: str) -> Callable[[Iterable[dict]], Segments]:
    """Renderer of a template: messages (dicts of strings) to (text, is generated) segments."""
    run = _body(folded(parse(source)))
    return lambda messages: run({"messages": messages}, False)
