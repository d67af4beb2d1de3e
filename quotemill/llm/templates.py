"""A small sandboxed template language: source -> syntax tree -> folded tree -> Python closures.

    {{ value }}   {% if c %} {% elif c %} {% else %} {% endif %}   {% for m in messages %} {% endfor %}
    {% generation %} {% endgeneration %}   {# remark #}

Values: names, `m.role`, `m['role']`, texts, whole numbers, true, false, none, `+`, `~` (join as text), comparisons, `in`,
`not in`, `and`, `or`, `not`, brackets, and filters behind `|`. In a loop `loop.first`, `loop.last`, `loop.index` and
`loop.index0` are known. Names reach nothing but the values handed in: members are looked up in dictionaries, never as
attributes, nothing can be called, and filters come from a fixed table.

A compiled template yields (text, under the generation mark) piece by piece and None where a round of an outermost loop
is over, so conversations of any length are rendered in bounded memory.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

from quotemill.shipping import ship_by_value


class TemplateError(ValueError):
    pass


# Syntax tree.


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Member:
    of: Any
    key: Any


@dataclass(frozen=True)
class Apply:
    op: str
    args: tuple


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class For:
    name: str
    source: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


MARKS = re.compile(r"({{.*?}}|{%.*?%}|{#.*?#})", re.S)
WORDS = re.compile(r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-+~|.,<>()\[\]]))""", re.S)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def as_text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


FILTERS: dict[str, Callable] = {
    "trim": lambda v: as_text(v).strip(),
    "upper": lambda v: as_text(v).upper(),
    "lower": lambda v: as_text(v).lower(),
    "length": lambda v: len(v) if v is not None else 0,
}
BINARY: dict[str, Callable] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge, "+": operator.add,
    "~": lambda a, b: as_text(a) + as_text(b), "in": lambda a, b: a in b, "not in": lambda a, b: a not in b,
}
CONSTANTS = {"true": True, "false": False, "none": None}


class Values:
    """Parses one value by precedence: or, and, not, comparison, join, filter, member."""

    def __init__(self, source: str, filters: Iterable[str]):
        self.source, self.filters, self.words, at = source, set(filters), [], 0
        source = source.rstrip()
        while at < len(source):
            found = WORDS.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.words.append((found.lastgroup, found.group(found.lastgroup)))
            at = found.end()
        self.at = 0

    def peek(self, *wanted: str) -> bool:
        return self.at < len(self.words) and self.words[self.at][0] != "text" and self.words[self.at][1] in wanted

    def take(self, *wanted: str) -> str | None:
        if self.peek(*wanted):
            self.at += 1
            return self.words[self.at - 1][1]
        return None

    def need(self, kind: str, wanted: str | None = None) -> str:
        if self.at >= len(self.words) or self.words[self.at][0] != kind or wanted not in (None, self.words[self.at][1]):
            raise TemplateError(f"{wanted or kind} expected in {self.source!r}")
        self.at += 1
        return self.words[self.at - 1][1]

    def whole(self):
        value = self.either()
        if self.at < len(self.words):
            raise TemplateError(f"{self.words[self.at][1]!r} not expected in {self.source!r}")
        return value

    def either(self):
        value = self.both()
        while self.take("or"):
            value = Apply("or", (value, self.both()))
        return value

    def both(self):
        value = self.negated()
        while self.take("and"):
            value = Apply("and", (value, self.negated()))
        return value

    def negated(self):
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        value = self.joined()
        while True:
            if op := self.take("==", "!=", "<", ">", "<=", ">=", "in"):
                value = Apply(op, (value, self.joined()))
            elif self.take("not"):
                self.need("name", "in")
                value = Apply("not in", (value, self.joined()))
            else:
                return value

    def joined(self):
        value = self.filtered()
        while op := self.take("+", "~"):
            value = Apply(op, (value, self.filtered()))
        return value

    def filtered(self):
        value = self.member()
        while self.take("|"):
            name = self.need("name")
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            value = Apply(f"|{name}", (value,))
        return value

    def member(self):
        value = self.simple()
        while True:
            if self.take("."):
                value = Member(value, Const(self.need("name")))
            elif self.take("["):
                value = Member(value, self.either())
                self.need("sign", "]")
            else:
                return value

    def simple(self):
        if self.take("("):
            value = self.either()
            self.need("sign", ")")
            return value
        if self.at >= len(self.words):
            raise TemplateError(f"value expected in {self.source!r}")
        kind, word = self.words[self.at]
        self.at += 1
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(word))
        if kind == "name":
            return Const(CONSTANTS[word]) if word in CONSTANTS else Name(word)
        raise TemplateError(f"value expected at {word!r} in {self.source!r}")


def parse(source: str, filters: Iterable[str] = ()) -> tuple:
    """The syntax tree of a template."""
    filters = [*FILTERS, *filters]
    parts = MARKS.split(source)
    at = 0

    def value(text: str):
        return Values(text, filters).whole()

    def body(*ends: str) -> tuple[tuple, str, str]:
        nonlocal at
        out = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{") and MARKS.fullmatch(part):
                out.append(Output(value(part[2:-2])))
            elif part.startswith("{%") and MARKS.fullmatch(part):
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in ends:
                    return tuple(out), word, rest
                if word == "if":
                    branches, end = [], "elif"
                    while end != "endif":
                        if end == "elif":
                            condition = value(rest)
                            inner, end, rest = body("elif", "else", "endif")
                        else:
                            condition = Const(True)
                            inner, end, rest = body("endif")
                        branches.append((condition, inner))
                    out.append(If(tuple(branches)))
                elif word == "for":
                    found = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
                    if not found:
                        raise TemplateError(f"cannot read loop {rest!r}")
                    out.append(For(found[1], value(found[2]), body("endfor")[0]))
                elif word == "generation":
                    out.append(Generation(body("endgeneration")[0]))
                else:
                    raise TemplateError(f"{word!r} not expected")
            elif part and not (part.startswith("{#") and MARKS.fullmatch(part)):
                out.append(Output(Const(part)))
        if ends:
            raise TemplateError(f"{ends[-1]} missing")
        return tuple(out), "", ""

    return body()[0]


def fold(tree: tuple, filters: dict[str, Callable]) -> tuple:
    """The tree with constant values computed, dead branches gone and neighbouring texts joined."""

    def value(node):
        if isinstance(node, Member):
            return Member(value(node.of), value(node.key))
        if not isinstance(node, Apply):
            return node
        args = tuple(value(a) for a in node.args)
        if node.op in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.op == "and") else args[0]
        if all(isinstance(a, Const) for a in args):
            try:
                return Const(applied(node.op, filters)(*[a.value for a in args]))
            except Exception as error:
                raise TemplateError(f"{node.op} cannot be applied to {[a.value for a in args]}") from error
        return Apply(node.op, args)

    out: list = []
    for node in tree:
        if isinstance(node, Output):
            new = [Output(value(node.value))]
        elif isinstance(node, For):
            new = [For(node.name, value(node.source), fold(node.body, filters))]
        elif isinstance(node, Generation):
            new = [Generation(fold(node.body, filters))]
        else:
            branches = []
            for condition, inner in node.branches:
                condition = value(condition)
                if isinstance(condition, Const) and not condition.value:
                    continue
                branches.append((condition, fold(inner, filters)))
                if isinstance(condition, Const):
                    break
            certain = branches and isinstance(branches[0][0], Const)
            new = list(branches[0][1]) if certain else [If(tuple(branches))] if branches else []
        for item in new:
            plain = isinstance(item, Output) and isinstance(item.value, Const)
            if plain and out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                out[-1] = Output(Const(as_text(out[-1].value.value) + as_text(item.value.value)))
            else:
                out.append(Output(Const(as_text(item.value.value))) if plain else item)
    return tuple(out)


def applied(op: str, filters: dict[str, Callable]) -> Callable:
    if op == "not":
        return operator.not_
    return filters[op[1:]] if op.startswith("|") else BINARY[op]


def uses_last(node, loop: str = "loop") -> bool:
    """Whether a tree asks for `loop.last`."""
    if isinstance(node, tuple):
        return any(uses_last(x) for x in node)
    if isinstance(node, Member):
        named = isinstance(node.key, Const) and node.key.value in ("first", "index", "index0")
        return (node.of == Name(loop) and not named) or uses_last(node.of) or uses_last(node.key)
    return any(uses_last(getattr(node, f)) for f in getattr(node, "__dataclass_fields__", ()))


def compile_template(source: str, filters: dict[str, Callable] | None = None) -> Callable[..., Iterator]:
    """``render(**values)``, a generator of (text, under the generation mark) and None between rounds of outer loops."""
    table = FILTERS | (filters or {})
    tree = fold(parse(source, table), table)

    def value(node) -> Callable[[dict], Any]:
        if isinstance(node, Const):
            held = node.value
            return lambda env: held
        if isinstance(node, Name):
            name = node.name
            return lambda env: env.get(name)
        if isinstance(node, Member):
            of, key = value(node.of), value(node.key)

            def member(env):
                holder = of(env)
                return holder.get(key(env)) if isinstance(holder, dict) else None

            return member
        args = [value(a) for a in node.args]
        if node.op == "and":
            return lambda env: args[0](env) and args[1](env)
        if node.op == "or":
            return lambda env: args[0](env) or args[1](env)
        call = applied(node.op, table)
        if len(args) == 1:
            return lambda env: call(args[0](env))
        return lambda env: call(args[0](env), args[1](env))

    def block(nodes: tuple, marked: bool, outer: bool) -> Callable[[dict], Iterator]:
        steps = [step(n, marked, outer) for n in nodes]

        def run(env):
            for each in steps:
                yield from each(env)

        return run

    def step(node, marked: bool, outer: bool) -> Callable[[dict], Iterator]:
        if isinstance(node, Output):
            get = value(node.value)
            return lambda env: iter(((as_text(get(env)), marked),))
        if isinstance(node, Generation):
            return block(node.body, True, False)
        if isinstance(node, If):
            branches = [(value(c), block(b, marked, False)) for c, b in node.branches]

            def choose(env):
                for condition, body in branches:
                    if condition(env):
                        return body(env)
                return iter(())

            return choose
        source_of, body, ahead = value(node.source), block(node.body, marked, False), uses_last(node.body)

        def loop(env):
            items, index, missing = iter(source_of(env) or ()), 0, object()
            item = next(items, missing)
            while item is not missing:
                later = next(items, missing) if ahead else missing
                state = {"index0": index, "index": index + 1, "first": index == 0, "last": later is missing if ahead else None}
                yield from body({**env, node.name: item, "loop": state})
                if outer:
                    yield None
                item, index = later if ahead else next(items, missing), index + 1

        return loop

    whole = block(tree, False, True)
    return lambda **values: whole(values)


ship_by_value(__name__)
