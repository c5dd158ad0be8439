"""Trees of calls in brace languages, and of Python, for rules whose patterns look inside arguments.

A pattern such as `$C.find(Filters.and(..., Filters.eq("k", $X), ...))` is read as the source is.  `$X` stands for any one
node, alike wherever it stands again in a pattern, `...` for any number of arguments.  Strings and comments hold no calls.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Iterator
from dataclasses import dataclass

#: Arguments nested deeper than this count as plain text.
DEEPEST = 150
_TOKEN = re.compile(r'(?P<gap>\s+|//[^\n]*|/\*(?:[^*]|\*(?!/))*(?:\*/|\Z))|(?P<text>"""(?:.|\n)*?(?:"""|\Z)|"(?:[^"\\\n]|\\.)*"?|`[^`]*`|\'(?:[^\'\\\n]|\\.)\')|(?P<name>[A-Za-z_$][\w$]*)|(?P<dots>\.\.\.)|(?P<other>\d[\w.]*|.)', re.S)
_PAIRS = {"(": ")", "[": "]", "{": "}"}


@dataclass(frozen=True)
class Node:
    """kind: name, text, select (of head), call (of head on args) or plain (a run of tokens)."""

    kind: str
    value: str = ""
    head: Node | None = None
    args: tuple[Node, ...] = ()


class Source:
    """The tokens of a text; a tree is worked out once for each place."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.tokens = [(m.lastgroup, m[0], m.start(), m.end()) for m in _TOKEN.finditer(text) if m.lastgroup != "gap"]
        self.closing: dict[int, int] = {}
        opened: list[tuple[str, int]] = []
        for i, (kind, value, *_) in enumerate(self.tokens):
            if kind == "other" and value in _PAIRS:
                opened.append((_PAIRS[value], i))
            elif kind == "other" and opened and value == opened[-1][0]:
                self.closing[opened.pop()[1]] = i
        self.known: dict[int, tuple[Node, int, list[tuple[Node, int, int]]]] = {}

    def _is(self, i: int, value: str) -> bool:
        return i < len(self.tokens) and self.tokens[i][0] == "other" and self.tokens[i][1] == value

    def chain(self, i: int, depth: int = 0) -> tuple[Node, int]:
        """The longest chain of selections and calls from token i on, and the token after it."""
        if i in self.known:
            return self.known[i][:2]
        kind, value, *_ = self.tokens[i]
        node, j, calls = Node("name" if kind == "name" else "dots" if kind == "dots" else "text" if kind == "text" else "plain", value), i + 1, []
        if kind in ("name", "text") or (self._is(i, "(") and i in self.closing and depth < DEEPEST):
            if kind == "other":
                node, j = Node("plain", "()", None, self.arguments(i, depth + 1)), self.closing[i] + 1
            while True:
                if self._is(j, ".") and j + 1 < len(self.tokens) and self.tokens[j + 1][0] == "name":
                    node, j = Node("select", self.tokens[j + 1][1], node), j + 2
                elif self._is(j, "[") and j in self.closing and self._is(self.closing[j] + 1, "("):
                    j = self.closing[j] + 1  # type arguments
                elif self._is(j, "(") and j in self.closing and depth < DEEPEST:
                    node, j = Node("call", "", node, self.arguments(j, depth + 1)), self.closing[j] + 1
                    calls.append((node, i, j))
                else:
                    break
        self.known[i] = node, j, calls
        return node, j

    def arguments(self, i: int, depth: int) -> tuple[Node, ...]:
        """The arguments in the bracket at token i."""
        out, j, stop = [], i + 1, self.closing[i]
        while j < stop:
            begin = j
            while j < stop and not self._is(j, ","):
                j = self.closing.get(j, j) + 1
            if j > begin:
                node, after = self.chain(begin, depth)
                if after != j:
                    node = Node("plain", " ".join(t[1] for t in self.tokens[begin:j]))
                out.append(node)
            j += 1
        return tuple(out)

    def calls(self) -> Iterator[tuple[int, int, Node]]:
        """(begin, end, call) of every call, nested ones included, in order of their chains."""
        for i, (kind, *_) in enumerate(self.tokens):
            after_dot = i > 0 and self._is(i - 1, ".")
            if kind in ("name", "text") and not after_dot or (self._is(i, "(") and i in self.closing and not (i and self.tokens[i - 1][0] == "name")):
                self.chain(i)
                for node, a, b in self.known[i][2]:
                    yield self.tokens[a][2], self.tokens[b - 1][3], node


def pattern(source: str) -> Node:
    s = Source(source)
    node, after = s.chain(0)
    if after != len(s.tokens):
        raise ValueError(f"not one expression: {source}")
    return node


def fits(p: Node, n: Node, bound: dict[str, Node]) -> bool:
    """Whether a node is of a pattern; bound: what `$X` stands for, filled in."""
    if p.kind == "name" and p.value.startswith("$"):
        return bound.setdefault(p.value, n) == n
    if (p.kind, p.value, p.head is None) != (n.kind, n.value, n.head is None):
        return False
    return (p.head is None or fits(p.head, n.head, bound)) and _fit_all(p.args, n.args, bound)


def _fit_all(p: tuple[Node, ...], n: tuple[Node, ...], bound: dict[str, Node]) -> bool:
    if not p:
        return not n
    if p[0].kind == "dots":
        for k in range(len(n) + 1):
            trial = dict(bound)
            if _fit_all(p[1:], n[k:], trial):
                bound.update(trial)
                return True
        return False
    return bool(n) and fits(p[0], n[0], bound) and _fit_all(p[1:], n[1:], bound)


def call_matches(either: tuple[Node, ...], none: tuple[Node, ...], text: str) -> Iterator[tuple[int, str]]:
    """Place and text of the calls that are of one pattern of `either` and of none of `none`; a place counts once."""
    seen = set()
    for begin, end, node in Source(text).calls():
        if begin not in seen and any(fits(p, node, {}) for p in either) and not any(fits(p, node, {}) for p in none):
            seen.add(begin)
            yield begin, text[begin:end]


def _place(lines: list[str], starts: list[int], line: int, column: int) -> int:
    return starts[line - 1] + len(lines[line - 1].encode()[:column].decode())


def python_tree(text: str) -> ast.AST | tuple[int, str]:
    """The syntax tree, or the line and message of what makes the text no Python."""
    try:
        return ast.parse(text)
    except SyntaxError as e:
        return e.lineno or 1, e.msg
    except (ValueError, RecursionError, MemoryError) as e:
        return 1, type(e).__name__


def bare_excepts(tree: ast.AST) -> Iterator[ast.AST]:
    return (n for n in ast.walk(tree) if isinstance(n, ast.ExceptHandler) and n.type is None)


def mutable_defaults(tree: ast.AST) -> Iterator[ast.AST]:
    """Functions of two parameters of which the second has an empty list or dictionary as its default."""
    for n in ast.walk(tree):
        if isinstance(n, ast.FunctionDef | ast.AsyncFunctionDef):
            a = n.args
            if len(a.posonlyargs + a.args) == 2 and not (a.vararg or a.kwarg or a.kwonlyargs) and len(a.defaults) == 1:
                d = a.defaults[0]
                if isinstance(d, ast.List) and not d.elts or isinstance(d, ast.Dict) and not d.keys:
                    yield n


#: What may stand between the last default and the end of a list of parameters.
_CLOSES = re.compile(r"(?:[\s,)\\]|#[^\n]*)*\)")
PYTHON = {"bare-except": (bare_excepts, ":"), "mutable-default": (mutable_defaults, ")")}


def python_matches(kind: str, text: str, tree: ast.AST) -> Iterator[tuple[int, str]]:
    """Place and head of the nodes of a kind, up to the colon or the bracket that ends it."""
    find, end = PYTHON[kind]
    lines = re.split(r"(?<=\n)|(?<=\r)(?!\n)", text)  # as the parser counts them
    starts = [0]
    for line in lines:
        starts.append(starts[-1] + len(line))
    for n in find(tree):
        at = _place(lines, starts, n.lineno, n.col_offset)
        if end == ")":
            last = n.args.defaults[-1]
            after = _place(lines, starts, last.end_lineno, last.end_col_offset)
            yield at, text[at : m.end() if (m := _CLOSES.match(text, after)) else after]
        else:
            yield at, text[at : text.index(end, at) + 1]
