"""Declarative rules over source texts: patterns with metavariables and the combinators that join them.

A rule is data.  `either`: a match of any of its patterns is a candidate; `none`: patterns that a candidate's text mustn't
match; `inside` and `outside`: spans that a candidate must, or mustn't, lie in; `where`: what a captured name must look
like.  Patterns are regular expressions over the text, spans may be blocks in matched braces or by indentation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import trees
from .scanners import SLICE, closing, in_slices


@dataclass(frozen=True)
class Block:
    """The text that an opening pattern governs: up to the brace that closes the one it ends with; guard: as in `where`."""

    opening: str
    guard: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Pattern:
    id: str
    languages: tuple[str, ...]
    severity: str
    message: str
    either: tuple[str, ...]
    none: tuple[str, ...] = ()
    inside: tuple[Block, ...] = ()
    outside: tuple[Block, ...] = ()
    where: dict[str, str] = field(default_factory=dict)
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    category: str = "uncategorized"
    #: Patterns of calls, matched as trees: a match of any of the first that is of none of the second.
    calls: tuple[str, ...] = ()
    calls_none: tuple[str, ...] = ()
    #: A kind of node of Python's syntax tree.
    python: str | None = None


#: The row of a text that a rule over syntax trees can't read.
UNPARSED = "unparsed-python"


def _fits(m: re.Match, where: dict[str, str]) -> bool:
    """Names that the match didn't capture are free."""
    return all(m.groupdict().get(k) is None or re.search(v, m[k]) for k, v in where.items())


def _spans(block: Block, text: str) -> list[tuple[int, int]]:
    out = []
    for m in re.finditer(block.opening, text):
        if _fits(m, block.guard) and (brace := text.rfind("{", m.start(), m.end())) >= 0:
            stop = closing(text, brace, "{}")
            out.append((m.start(), stop + 1 if stop >= 0 else len(text)))
    return out


def matches(rule: Pattern, text: str) -> Iterator[tuple[int, str]]:
    """Places and texts of a rule's matches, in order; a place counts once."""
    if rule.calls:
        either, none = (tuple(map(trees.pattern, p)) for p in (rule.calls, rule.calls_none))
        yield from sorted(trees.call_matches(either, none, text))
        return
    if rule.python:
        tree = trees.python_tree(text)
        if not isinstance(tree, tuple):
            yield from sorted(trees.python_matches(rule.python, text, tree))
        return
    inside = [[s for b in rule.inside for s in _spans(b, text)]] if rule.inside else []
    outside = [s for b in rule.outside for s in _spans(b, text)]
    found = {}
    for p in rule.either:
        for m in re.finditer(p, text):
            ok = _fits(m, rule.where) and not any(re.search(n, m[0]) for n in rule.none)
            within = lambda spans: any(a <= m.start() and m.end() <= e for a, e in spans)  # noqa: B023, E731
            if ok and all(map(within, inside)) and not within(outside):
                found.setdefault(m.start(), m[0])
    yield from sorted(found.items())


# fixed values: what the rules are about
TEST_FILES = ("**/*.test.ts", "**/*.spec.ts", "**/*.test.tsx", "**/*.spec.tsx", "**/__tests__/*", "**/__mocks__/*")
TESTKITS = ("**/testkit/*", "**/testkits/*", "**/*TestKit.ts", "**/*TestKit.tsx", "**/*.testkit.ts", "**/*.testkit.tsx", "**/e2e/*", "**/*.example.ts", "**/*.example.tsx")
TIMES = "scheduledAt|startTime|endTime|bookingDate|appointmentTime|eventStart|eventEnd|slotStart|slotEnd"
FORMS = r"(?i)^([a-z][a-z0-9]*)?(submission|formpayload|intakeform)$"
GUARDS = r"^(validate|is|isValid|assert|verify|check).*$"
NUMBERS = r"^(durations?|prices?|amounts?|numbers?|counts?|indexes|indices|ids|timestamps?|years?|months?|days?|minutes?|hours?|seconds?|ms|millis|scores?|sizes?)$"
STAFF_CLIENTS = "staffRepository|staffMembersService|staffMembersAdapter|staffApi"
APP_IDS = "appDefId|applicationDefinitionId|appId"

_ARGS = r"\((?:[^()]|\([^()]*\))*\)"
RULES = (
    Pattern("calendar-scheduled-time-without-explicit-timezone", ("typescript",), "medium", "a scheduled time is made without a zone", (rf"\b(?:{TIMES})\s*:\s*new\s+Date\s*\(\s*\)",), include=("**/*.ts", "**/*.tsx"), exclude=TEST_FILES + TESTKITS),
    Pattern("form-payload-direct-access-without-validation", ("typescript",), "medium", "a form's fields are read before it is validated", (r"\b(?P<X>[A-Za-z_$][\w$]*)\.(?:fields|formFields)\.[A-Za-z_$][\w$]*",), outside=(Block(rf"\bif\s*\(\s*(?P<GUARD>[\w$.]+)\s*{_ARGS}\s*\)\s*\{{", {"GUARD": GUARDS}), Block(r"\bif\s*\(\s*[\w$]+\.isValid(?:\(\s*\))?\s*\)\s*\{")), where={"X": FORMS}, exclude=TEST_FILES),
    Pattern("go-defer-in-loop", ("go",), "medium", "what a loop opens stays open until the function ends", (r"\b\w+\s*,\s*_\s*:=\s*os\.Open\([^)\n]*\)",), inside=(Block(r"\bfor\s+_\s*,\s*\w+\s*:=\s*range\s+[^{\n]+\{"),), category="correctness"),
    Pattern("go-ignored-error", ("go",), "high", "an error is thrown away", (rf"(?m)\b\w+\s*,\s*_\s*=\s*[\w.]+{_ARGS}",), category="correctness"),
    Pattern("py-bare-except", ("python",), "medium", "an except without a type catches everything", (), category="correctness", python="bare-except"),
    Pattern("py-mutable-default-arg", ("python",), "high", "a mutable default is shared by all calls", (), category="correctness", python="mutable-default"),
    Pattern("ts-array-sort-numbers-without-comparator", ("typescript",), "medium", "numbers are sorted as texts", (rf"\bArray\.from\(\s*new\s+Set{_ARGS}\s*\)\.sort\(\s*\)", r"(?<![\w$.)])(?P<ARR>[A-Za-z_$][\w$]*)\.sort\(\s*\)"), where={"ARR": NUMBERS}),
    Pattern("ts-staff-query-missing-appdefid", ("typescript",), "medium", "a staff query isn't scoped to an application", (rf"\b(?:{STAFF_CLIENTS})\.[\w$]+\(\s*\{{[^{{}}]*(?:\{{[^{{}}]*\}}[^{{}}]*)*\}}\s*\)",), none=(rf"[{{,]\s*(?:{APP_IDS})\s*[:,}}]",), exclude=TEST_FILES),
    #: Templates: a team names its own collection and bootstrap files.
    Pattern("no-await-result-in-production", ("scala",), "high", "a thread waits for a future", (), exclude=("**/test/**", "**/it/**", "**/specs2/**", "**/Main.scala"), category="reliability", calls=("scala.concurrent.Await.result(...)", "scala.concurrent.Await.ready(...)", "Await.result(...)", "Await.ready(...)")),
    Pattern("missing-meta-site-filter-mongo", ("scala",), "high", "a query isn't scoped to its site", (), include=("**/*Repo.scala", "**/repo/*.scala", "**/dao/*.scala"), exclude=("**/test/**",), category="tenancy", calls=("$COLL.find($FILTER)", "$COLL.find($FILTER, $OPTS)", "$COLL.findOne($FILTER)", "$COLL.aggregate(...)"), calls_none=('$COLL.find(Filters.and(..., Filters.eq("metaSiteId", $X), ...))', '$COLL.find($FILTER.append("metaSiteId", $X))', '$COLL.find(Filters.eq("metaSiteId", $X))')),
    #: Deferred: too broad to run unless it is named.
    Pattern("calendar-now-without-explicit-timezone", ("typescript",), "medium", "now is taken without a zone", (r"\bnew\s+Date\s*\(\s*\)",), include=("**/*.ts", "**/*.tsx"), exclude=TEST_FILES),
)
ACTIVE = tuple(r.id for r in RULES[:-1])
_EXTENSIONS = {"typescript": ("ts", "tsx"), "javascript": ("js", "jsx"), "python": ("py",), "go": ("go",), "scala": ("scala",)}


def _applies(rule: Pattern) -> Column:
    """By extension and path, in the JVM, so that files no rule reads never reach Python."""
    path = F.col("path")
    keep = path.rlike(r"\.(?:" + "|".join(e for lang in rule.languages for e in _EXTENSIONS[lang]) + ")$")
    if rule.include:
        keep = keep & T.any_of(path, [T.glob_to_regex(g) for g in rule.include])
    return keep & ~T.any_of(path, [T.glob_to_regex(g) for g in rule.exclude])


def pattern_findings(files: DataFrame, rules: tuple[Pattern, ...] = RULES, names: tuple[str, ...] = ACTIVE) -> DataFrame:
    """rule, severity, category, file, line, snippet, message; files: path, text (null: none).

    A Python file that doesn't parse is a row of its own, UNPARSED with line and message, and no other of its tree rules.
    """
    chosen = tuple(r for r in rules if r.id in names)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, text, applies in zip(batch.path, batch.text, batch.applies, strict=True):
                if any(chosen[k].python for k in applies) and isinstance(bad := trees.python_tree(text), tuple):
                    rows.append((UNPARSED, "low", "syntax", path, bad[0], "", bad[1]))
                for k in applies:
                    rule = chosen[k]
                    rows += [(rule.id, rule.severity, rule.category, path, text.count("\n", 0, at) + 1, " ".join(hit.split())[:200], rule.message) for at, hit in matches(rule, text)]
            yield pd.DataFrame(rows, columns=["rule", "severity", "category", "file", "line", "snippet", "message"]).astype({"line": "int32"})

    which = F.filter(F.array(*(F.when(_applies(r), F.lit(k)) for k, r in enumerate(chosen))), lambda x: x.isNotNull())
    wanted = files.select("path", "text", which.alias("applies")).filter((F.size("applies") > 0) & F.col("text").isNotNull())
    return wanted.mapInArrow(in_slices(of), "rule string, severity string, category string, file string, line int, snippet string, message string")


def keyed_findings(files: DataFrame, rules: tuple[Pattern, ...] = RULES) -> DataFrame:
    """files with a row for each finding of the rule that the file names, and its line.  files: pattern, path, text and more.

    Each text meets its own rule only; a pattern that isn't known finds nothing.
    """
    known, kept = {r.id: r for r in rules}, [f for f in files.schema if f.name not in ("path", "text")]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, SLICE) for b in batches for i in range(0, len(b), SLICE)):
            texts = enumerate(zip(batch["pattern"].to_pylist(), batch["text"].to_pylist(), strict=True))
            found = [(k, text.count("\n", 0, at) + 1) for k, (p, text) in texts for at, _ in matches(known[p], text)]
            if found:
                places, lines = zip(*found, strict=True)
                yield batch.select([f.name for f in kept]).take(pa.array(places)).append_column("line", pa.array(lines, pa.int32()))

    wanted = F.coalesce(*(F.when(F.col("pattern") == r.id, _applies(r)) for r in rules), F.lit(False))
    rows = files.filter(wanted & F.col("text").isNotNull()).select(*(f.name for f in kept), "text")
    return rows.mapInArrow(of, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "line int"]))
