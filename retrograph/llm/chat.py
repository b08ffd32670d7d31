"""Chat formatting: a template compiler for conversations with generation markers.

The language is a small sandbox: text, ``{{ expression }}``, ``{# comment #}`` and
the blocks ``for``/``if``/``elif``/``else``/``set``/``generation``; a ``-`` beside
a bracket strips white space on that side.  Expressions know literals, names,
fields of mappings, items of lists, ``or and not == != < <= > >= in + - ~``, the
inline ``a if c else b``, ``loop.index/index0/first/last`` and the filters of
``FILTERS``.  Nothing else can be reached: no attribute of a Python object, no
call but ``fail(message)``; mistakes are found when the template is compiled.

``compile_template`` parses to a syntax tree, folds constants (operators and
filters on literals, neighbouring text, branches that can't be taken), and makes
one Python closure of each node.  Rendering gives the text and the [start, end)
character spans that ``generation`` blocks wrote, for loss masks.

Defined results: turns are ordered by turn (null first), role, text, so ties
and repeated rows have one order, and repeated rows stay; null role or text is empty;
rows without conv_id are left out; an empty table gives no conversations;
columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CHATML = (
    "{% for m in messages %}<|im_start|>{{ m.role }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text }}<|im_end|>{% endgeneration %}"
    "{% else %}{{ m.text }}<|im_end|>{% endif %}{{ '\\n' }}{% endfor %}"
)

FILTERS: dict[str, Callable[[object], object]] = {
    "trim": lambda x: _text(x).strip(),
    "lower": lambda x: _text(x).lower(),
    "upper": lambda x: _text(x).upper(),
    "length": lambda x: len(x) if isinstance(x, (str, list, dict)) else 0,
    "string": lambda x: _text(x),
}


class TemplateError(ValueError):
    """A template that can't be compiled, or that failed on purpose."""


def _text(x: object) -> str:
    if x is None:
        return ""
    if isinstance(x, bool):
        return "true" if x else "false"
    return str(x)


def _order(op: Callable[[object, object], bool]) -> Callable[[object, object], bool]:
    def compare(a: object, b: object) -> bool:
        try:
            return op(a, b)
        except TypeError:
            return False

    return compare


def _add(a: object, b: object) -> object:
    if isinstance(a, int) and isinstance(b, int):
        return a + b
    return _text(a) + _text(b)


def _minus(a: object, b: object) -> object:
    if isinstance(a, int) and isinstance(b, int):
        return a - b
    raise TemplateError("'-' needs two numbers")


def _within(a: object, b: object) -> bool:
    return _text(a) in b if isinstance(b, str) else a in b if isinstance(b, (list, dict)) else False


_BINARY = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": _order(lambda a, b: a < b),
    "<=": _order(lambda a, b: a <= b),
    ">": _order(lambda a, b: a > b),
    ">=": _order(lambda a, b: a >= b),
    "in": _within,
    "+": _add,
    "-": _minus,
    "~": lambda a, b: _text(a) + _text(b),
}
_TOKEN = re.compile(r"\s*(?:(\d+)|([A-Za-z_]\w*)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(==|!=|<=|>=|[-+~<>().\[\]|=]))", re.S)
_BRACKET = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?).*?(-?)#\}", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """Recursive descent over one expression; nodes are tuples (kind, ...)."""

    def __init__(self, source: str) -> None:
        self.items: list[tuple[str, object]] = []
        at = 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            number, name, quoted, mark = m.groups()
            if number is not None:
                self.items.append(("const", int(number)))
            elif name is not None:
                self.items.append(("name", name))
            elif quoted is not None:
                self.items.append(("const", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[1]), quoted[1:-1], flags=re.S)))
            else:
                self.items.append(("mark", mark))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, object]:
        return self.items[self.at] if self.at < len(self.items) else ("end", None)

    def take(self, kind: str, value: object = None) -> object:
        found = self.peek()
        if found[0] != kind or (value is not None and found[1] != value):
            raise TemplateError(f"expected {value or kind}, found {found[1]!r}")
        self.at += 1
        return found[1]

    def accept(self, *values: str) -> str | None:
        kind, value = self.peek()
        if kind in ("name", "mark") and value in values:
            self.at += 1
            return value
        return None

    def whole(self) -> tuple:
        node = self.choice()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return node

    def choice(self) -> tuple:
        node = self.either()
        if self.accept("if"):
            test = self.either()
            other = self.choice() if self.accept("else") else ("const", None)
            node = ("choose", test, node, other)
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.accept("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.accept("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.accept("not") else self.compared()

    def compared(self) -> tuple:
        node = self.summed()
        while op := self.accept("==", "!=", "<", "<=", ">", ">=", "in"):
            node = ("binary", op, node, self.summed())
        return node

    def summed(self) -> tuple:
        node = self.filtered()
        while op := self.accept("+", "-", "~"):
            node = ("binary", op, node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.item()
        while True:
            if self.accept("|"):
                name = self.take("name")
                if name not in FILTERS:
                    raise TemplateError(f"unknown filter {name!r}")
                node = ("filter", name, node)
            elif self.accept("."):
                node = ("field", node, ("const", self._open(self.take("name"))))
            elif self.accept("["):
                key = self.choice()
                self.take("mark", "]")
                node = ("field", node, key)
            else:
                return node

    @staticmethod
    def _open(name: str) -> str:
        if name.startswith("_"):
            raise TemplateError(f"{name!r} is out of reach")
        return name

    def item(self) -> tuple:
        if self.accept("("):
            node = self.choice()
            self.take("mark", ")")
            return node
        kind, value = self.peek()
        if kind == "const":
            self.at += 1
            return ("const", value)
        name = self._open(self.take("name"))
        if name in ("true", "false", "none"):
            return ("const", {"true": True, "false": False, "none": None}[name])
        if name == "fail":
            self.take("mark", "(")
            node = ("fail", self.choice())
            self.take("mark", ")")
            return node
        return ("name", name)


def _pieces(source: str) -> Iterator[tuple[str, str]]:
    """Text, output and block pieces, with white space stripped where a dash asks for it."""
    at, strip = 0, False
    for m in _BRACKET.finditer(source):
        left, right = (m[1] or m[4] or m[7] or ""), (m[3] or m[6] or m[8] or "")
        text = source[at : m.start()]
        text = text.lstrip() if strip else text
        yield "text", text.rstrip() if left else text
        if m[2] is not None:
            yield "out", m[2]
        elif m[5] is not None:
            yield "block", m[5].strip()
        at, strip = m.end(), bool(right)
    yield "text", source[at:].lstrip() if strip else source[at:]


class _Parser:
    def __init__(self, source: str) -> None:
        self.pieces = list(_pieces(source))
        self.at = 0

    def body(self, *ends: str) -> tuple[list[tuple], str]:
        """Nodes up to a block that begins with one of ``ends``; that block's text."""
        nodes: list[tuple] = []
        while self.at < len(self.pieces):
            kind, value = self.pieces[self.at]
            self.at += 1
            if kind == "text":
                nodes.append(("text", value))
            elif kind == "out":
                nodes.append(("out", _Expression(value).whole()))
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return nodes, value
                nodes.append(self.block(word, rest))
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return nodes, ""

    def block(self, word: str, rest: str) -> tuple:
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z]\w*)\s+in\s+(.+)", rest, re.S)
            if not m:
                raise TemplateError(f"can't read 'for {rest}'")
            return ("for", m[1], _Expression(m[2]).whole(), self.body("endfor")[0])
        if word == "if":
            branches, other = [], []
            test = _Expression(rest).whole()
            while True:
                nodes, end = self.body("elif", "else", "endif")
                branches.append((test, nodes))
                if end.startswith("elif"):
                    test = _Expression(end[4:]).whole()
                    continue
                if end == "else":
                    other = self.body("endif")[0]
                return ("if", branches, other)
        if word == "set":
            m = re.fullmatch(r"\s*([A-Za-z]\w*)\s*=(?!=)\s*(.+)", rest, re.S)
            if not m:
                raise TemplateError(f"can't read 'set {rest}'")
            return ("set", m[1], _Expression(m[2]).whole())
        if word == "generation":
            return ("generation", self.body("endgeneration")[0])
        raise TemplateError(f"unknown block {word!r}")


def parse(source: str) -> list[tuple]:
    """The syntax tree of a template."""
    return _Parser(source).body()[0]


def fold_expression(node: tuple) -> tuple:
    """The expression with operators on constants worked out."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "binary":
        a, b = fold_expression(node[2]), fold_expression(node[3])
        return ("const", _BINARY[node[1]](a[1], b[1])) if a[0] == b[0] == "const" else (kind, node[1], a, b)
    if kind == "filter":
        a = fold_expression(node[2])
        return ("const", FILTERS[node[1]](a[1])) if a[0] == "const" else (kind, node[1], a)
    if kind == "not":
        a = fold_expression(node[1])
        return ("const", not a[1]) if a[0] == "const" else (kind, a)
    if kind in ("and", "or"):
        a, b = fold_expression(node[1]), fold_expression(node[2])
        if a[0] == "const":
            return b if bool(a[1]) == (kind == "and") else a
        return (kind, a, b)
    if kind == "choose":
        test, yes, no = map(fold_expression, node[1:])
        return (yes if test[1] else no) if test[0] == "const" else (kind, test, yes, no)
    return (kind, *map(fold_expression, node[1:]))


def fold(nodes: list[tuple]) -> list[tuple]:
    """The tree with constants worked out, text joined and dead branches gone."""
    out: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "text":
            if not node[1]:
                return
            if out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + node[1])
                return
        out.append(node)

    for node in nodes:
        kind = node[0]
        if kind == "out":
            e = fold_expression(node[1])
            add(("text", _text(e[1])) if e[0] == "const" else ("out", e))
        elif kind == "set":
            add(("set", node[1], fold_expression(node[2])))
        elif kind == "for":
            add(("for", node[1], fold_expression(node[2]), fold(node[3])))
        elif kind == "generation":
            add(("generation", fold(node[1])))
        elif kind == "if":
            branches, other = [], fold(node[2])
            for test, body in node[1]:
                test, body = fold_expression(test), fold(body)
                if test[0] != "const":
                    branches.append((test, body))
                elif test[1]:
                    other = body
                    break
            if branches:
                add(("if", branches, other))
            else:
                for inner in other:
                    add(inner)
        else:
            add(node)
    return out


Env = dict[str, object]


def _value(node: tuple) -> Callable[[Env], object]:
    """A closure that gives the expression's value."""
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda env: value
    if kind == "name":
        name = node[1]
        return lambda env: env.get(name)
    if kind == "field":
        of, key = _value(node[1]), _value(node[2])

        def field(env: Env) -> object:
            held, k = of(env), key(env)
            if isinstance(held, dict):
                return held.get(k)
            if isinstance(held, list) and isinstance(k, int) and -len(held) <= k < len(held):
                return held[k]
            return None

        return field
    if kind == "binary":
        op, a, b = _BINARY[node[1]], _value(node[2]), _value(node[3])
        return lambda env: op(a(env), b(env))
    if kind == "filter":
        change, a = FILTERS[node[1]], _value(node[2])
        return lambda env: change(a(env))
    if kind == "not":
        a = _value(node[1])
        return lambda env: not a(env)
    if kind == "and":
        a, b = _value(node[1]), _value(node[2])
        return lambda env: a(env) and b(env)
    if kind == "or":
        a, b = _value(node[1]), _value(node[2])
        return lambda env: a(env) or b(env)
    if kind == "choose":
        test, a, b = map(_value, node[1:])
        return lambda env: a(env) if test(env) else b(env)
    message = _value(node[1])

    def fail(env: Env) -> object:
        raise TemplateError(_text(message(env)))

    return fail


class _Writer:
    """Rendered text so far and the spans of generation blocks."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.size = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


Step = Callable[[Env, _Writer], None]


def _steps(nodes: list[tuple]) -> Step:
    made = [_step(n) for n in nodes]

    def run(env: Env, out: _Writer) -> None:
        for step in made:
            step(env, out)

    return made[0] if len(made) == 1 else run


def _step(node: tuple) -> Step:
    kind = node[0]
    if kind == "text":
        text = node[1]
        return lambda env, out: out.write(text)
    if kind == "out":
        value = _value(node[1])
        return lambda env, out: out.write(_text(value(env)))
    if kind == "set":
        name, value = node[1], _value(node[2])

        def put(env: Env, out: _Writer) -> None:
            env[name] = value(env)

        return put
    if kind == "generation":
        body = _steps(node[1])

        def mark(env: Env, out: _Writer) -> None:
            start = out.size
            body(env, out)
            out.spans.append((start, out.size))

        return mark
    if kind == "if":
        branches, other = [(_value(t), _steps(b)) for t, b in node[1]], _steps(node[2])

        def pick(env: Env, out: _Writer) -> None:
            for test, body in branches:
                if test(env):
                    return body(env, out)
            return other(env, out)

        return pick
    name, items, body = node[1], _value(node[2]), _steps(node[3])

    def loop(env: Env, out: _Writer) -> None:
        held = items(env)
        if not isinstance(held, list):
            return
        last = len(held) - 1
        for k, item in enumerate(held):
            body(env | {name: item, "loop": {"index": k + 1, "index0": k, "first": k == 0, "last": k == last}}, out)

    return loop


def compile_template(source: str) -> Callable[[Env], tuple[str, list[tuple[int, int]]]]:
    """A function from variables to the rendered text and its generation spans."""
    run = _steps(fold(parse(source)))

    def render(env: Env) -> tuple[str, list[tuple[int, int]]]:
        out = _Writer()
        run(dict(env), out)
        return "".join(out.parts), out.spans

    return render


def format_chats(turns: DataFrame, template: str = CHATML) -> DataFrame:
    """conv_id, n_messages, rendered text, and starts and ends of what the model is to generate."""
    compile_template(template)  # mistakes show here
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("m"))
    chats = rows.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("m")), lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text"))).alias("messages"))

    def maker():
        render = compile_template(template)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            chats = batch.column(1).to_pylist()
            done = [render({"messages": m}) for m in chats]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(m) for m in chats], pa.int32()),
                    pa.array([t for t, _ in done], pa.string()),
                    *(pa.array([[s[k] for s in spans] for _, spans in done], pa.list_(pa.int32())) for k in (0, 1)),
                ],
                ["conv_id", "n_messages", "text", "starts", "ends"],
            )

        return step

    return common.map_arrow(chats, maker, "conv_id bigint, n_messages int, text string, starts array<int>, ends array<int>")
