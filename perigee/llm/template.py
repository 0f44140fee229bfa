"""A small template language for conversations: parsed to a syntax tree, folded, compiled to Python closures.

    {{ expression | filter }}   {% for m in messages %} {% endfor %}   {% if %} {% elif %} {% else %} {% endif %}
    {% generation %} {% endgeneration %}     marks what the model is trained on

Expressions know strings, integers, true, false, fields of names (m.role, loop.first, loop.last, loop.index0),
~ (joining), ==, !=, and, or, not and the filters below. There are no calls, no attributes of Python objects and no
loops but over the messages, so a template can neither reach outside nor run without end. Rendering is lazy: it
takes one message ahead of what it yields, whatever a conversation's length.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

END = "</turn>"
HEAD = "###"


def escape(text: str) -> str:
    """Reversible: control strings get a backslash, backslashes are doubled."""
    return text.replace("\\", "\\\\").replace(END, "\\" + END).replace(HEAD, "\\" + HEAD)


def escape_name(text: str) -> str:
    return escape(text).replace(":", "\\:")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "escape_name": escape_name, "trim": str.strip, "upper": str.upper, "lower": str.lower}

Piece = tuple[str, bool]
_TOKEN = re.compile(r"""\s*(?:(?P<str>'[^']*'|"[^"]*")|(?P<int>[0-9]+)|(?P<name>[A-Za-z_][A-Za-z0-9_]*)|(?P<op>==|!=|[~.|()]))""")


class TemplateError(ValueError):
    pass


# ---- syntax tree: tuples ("const", v), ("field", name, key), ("filter", f, x), ("not", x), (op, a, b)


class _Expressions:
    """Recursive descent over one expression: or < and < not < comparison < joining < filters."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()

    def take(self, *wanted: str) -> str | None:
        if self.tokens and self.tokens[0][0] in ("op", "name") and self.tokens[0][1] in wanted:
            return self.tokens.pop(0)[1]
        return None

    def whole(self) -> tuple:
        tree = self.either()
        if self.tokens:
            raise TemplateError(f"unexpected {self.tokens[0][1]!r}")
        return tree

    def either(self) -> tuple:
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self) -> tuple:
        tree = self.negated()
        while self.take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        tree = self.joined()
        if op := self.take("==", "!="):
            tree = (op, tree, self.joined())
        return tree

    def joined(self) -> tuple:
        tree = self.filtered()
        while self.take("~"):
            tree = ("~", tree, self.filtered())
        return tree

    def filtered(self) -> tuple:
        tree = self.atom()
        while self.take("|"):
            kind, name = self.tokens.pop(0) if self.tokens else ("", "")
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter", name, tree)
        return tree

    def atom(self) -> tuple:
        if self.take("("):
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return tree
        if not self.tokens:
            raise TemplateError("expression ends early")
        kind, value = self.tokens.pop(0)
        if kind == "str":
            return ("const", value[1:-1])
        if kind == "int":
            return ("const", int(value))
        if kind == "name" and value in ("true", "false"):
            return ("const", value == "true")
        if kind != "name" or not self.take("."):
            raise TemplateError(f"unexpected {value!r}")
        kind, key = self.tokens.pop(0) if self.tokens else ("", "")
        if kind != "name":
            raise TemplateError(f"no field of {value!r}")
        return ("field", value, key)


def parse(source: str) -> list[tuple]:
    """Statements: ("text", s), ("out", expr), ("if", [(expr, body)], other), ("for", name, body), ("generation", body)."""
    parts = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", source, flags=re.S)
    at = 0

    def body(*ends: str) -> tuple[list[tuple], str]:
        nonlocal at
        out: list[tuple] = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                out.append(("out", _Expressions(part[2:-2]).whole()))
            elif part.startswith("{%"):
                words = part[2:-2].split(None, 1)
                word, rest = words[0] if words else "", words[1].strip() if len(words) > 1 else ""
                if word in ends:
                    return out, f"{word} {rest}"
                out.append(statement(word, rest))
            elif part:
                out.append(("text", part))
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return out, ""

    def statement(word: str, rest: str) -> tuple:
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+messages", rest)
            if not m:
                raise TemplateError(f"can't loop over {rest!r}")
            return ("for", m[1], body("endfor")[0])
        if word == "generation":
            return ("generation", body("endgeneration")[0])
        if word == "if":
            branches, other, test = [], [], rest
            while True:
                inner, end = body("elif", "else", "endif")
                branches.append((_Expressions(test).whole(), inner))
                if end.startswith("elif"):
                    test = end[5:]
                    continue
                if end.startswith("else"):
                    other = body("endif")[0]
                return ("if", branches, other)
        raise TemplateError(f"no statement {word!r}")

    return body()[0]


# ---- folding


def _value(op: str, a, b):
    if op == "~":
        return f"{a}{b}"
    if op in ("==", "!="):
        return (a == b) == (op == "==")
    return (a and b) if op == "and" else (a or b)


def fold(tree: tuple) -> tuple:
    """An expression with its constant parts computed."""
    if tree[0] in ("const", "field"):
        return tree
    if tree[0] == "filter":
        inner = fold(tree[2])
        return ("const", FILTERS[tree[1]](str(inner[1]))) if inner[0] == "const" else ("filter", tree[1], inner)
    if tree[0] == "not":
        inner = fold(tree[1])
        return ("const", not inner[1]) if inner[0] == "const" else ("not", inner)
    a, b = fold(tree[1]), fold(tree[2])
    if a[0] == b[0] == "const":
        return ("const", _value(tree[0], a[1], b[1]))
    return (tree[0], a, b)


def fold_body(body: list[tuple]) -> list[tuple]:
    """Statements with constants written out as text, decided branches taken and neighbouring texts joined."""
    out: list[tuple] = []

    def add(s: tuple) -> None:
        if s[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + s[1])
        elif s != ("text", ""):
            out.append(s)

    for s in body:
        if s[0] == "out":
            e = fold(s[1])
            add(("text", str(e[1])) if e[0] == "const" else ("out", e))
        elif s[0] in ("for", "generation"):
            add((*s[:-1], fold_body(s[-1])))
        elif s[0] == "if":
            branches, other = [], fold_body(s[2])
            for test, inner in s[1]:
                e = fold(test)
                if e[0] == "const" and e[1]:
                    other = fold_body(inner)
                    break
                if e[0] != "const":
                    branches.append((e, fold_body(inner)))
            if branches:
                add(("if", branches, other))
            else:
                for x in other:
                    add(x)
        else:
            add(s)
    return out


# ---- closures


def _expression(tree: tuple) -> Callable[[dict], object]:
    if tree[0] == "const":
        value = tree[1]
        return lambda env: value
    if tree[0] == "field":
        name, key = tree[1:]

        def field(env: dict):
            if name not in env or key not in env[name]:
                raise TemplateError(f"no {name}.{key}")
            return env[name][key]

        return field
    if tree[0] == "filter":
        use, inner = FILTERS[tree[1]], _expression(tree[2])
        return lambda env: use(str(inner(env)))
    if tree[0] == "not":
        inner = _expression(tree[1])
        return lambda env: not inner(env)
    op, a, b = tree[0], _expression(tree[1]), _expression(tree[2])
    if op == "and":
        return lambda env: a(env) and b(env)
    if op == "or":
        return lambda env: a(env) or b(env)
    return lambda env: _value(op, a(env), b(env))


def _body(body: list[tuple]) -> Callable[[dict], Iterator[Piece]]:
    steps = [_statement(s) for s in body]

    def run(env: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(env)

    return run


def _statement(s: tuple) -> Callable[[dict], Iterator[Piece]]:
    if s[0] == "text":
        piece = s[1]

        def text(env: dict) -> Iterator[Piece]:
            yield piece, False

        return text
    if s[0] == "out":
        value = _expression(s[1])

        def out(env: dict) -> Iterator[Piece]:
            yield str(value(env)), False

        return out
    if s[0] == "generation":
        inner = _body(s[1])

        def generation(env: dict) -> Iterator[Piece]:
            yield "".join(t for t, _ in inner(env)), True  # one piece for a whole marked region

        return generation
    if s[0] == "if":
        branches, other = [(_expression(e), _body(b)) for e, b in s[1]], _body(s[2])

        def choose(env: dict) -> Iterator[Piece]:
            yield from next((b for test, b in branches if test(env)), other)(env)

        return choose
    name, inner = s[1], _body(s[2])

    def loop(env: dict) -> Iterator[Piece]:
        messages = iter(env["messages"])
        now, index = next(messages, None), 0
        while now is not None:
            after = next(messages, None)
            yield from inner(env | {name: now, "loop": {"first": index == 0, "last": after is None, "index0": index}})
            now, index = after, index + 1

    return loop


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages (dicts with role and text) to pieces: text, and whether the model is trained on it."""
    run = _body(fold_body(parse(source)))
    return lambda messages: run({"messages": messages})
