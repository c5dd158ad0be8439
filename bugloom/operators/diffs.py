"""Diffs as tables: files with bodies and removed lines, new-side ranges, corpus rows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

_SHOW = re.compile(r"diff --git a/(.+) b/(.+)$")
_HUNK = re.compile(r"^@@ -\d+(?:,\d+)? \+(\d+)(?:,(\d+))? @@")


def _sections(diff: str) -> Iterator[list[str]]:
    """The lines of each file of a diff, its header line first."""
    section: list[str] | None = None
    for line in (diff or "").splitlines():
        if line.startswith("diff --git "):
            if section is not None:
                yield section
            section = [line]
        elif section is not None:
            section.append(line)
    if section is not None:
        yield section


def _path_after(line: str, prefix: str) -> str | None:
    name = line[4:].strip().removeprefix(prefix)
    return None if name == "/dev/null" else name


def files_of_pull(diff: str) -> list[tuple[str, str, str]]:
    """(path, body, removed) of a pull request's diff.

    The path is of the last `+++ ` line that names a file, else of the first such `--- ` line; both kinds of line count as
    headers wherever they stand, so content that begins like them isn't in the body.  Files without a path are left out.
    """
    out = []
    for header, *lines in _sections(diff):
        del header
        new, old, body, removed = None, None, [], []
        for line in lines:
            if line.startswith("+++ "):
                new = _path_after(line, "b/") or new
            elif line.startswith("--- "):
                old = old or (_path_after(line, "a/") if new is None else None)
            elif body or line.startswith("@@"):
                body.append(line)
                if line.startswith("-") and not line.startswith("---"):
                    removed.append(line[1:])
        if new or old:
            out.append((new or old, "\n".join(body), "\n".join(removed)))
    return out


def files_of_show(diff: str) -> list[tuple[str, str, str]]:
    """(path, body, removed) of a commit's diff: paths of the header line, also of deletions; files without a hunk are left out."""
    out = []
    for header, *lines in _sections(diff):
        named = _SHOW.match(header)
        begin = next((i for i, line in enumerate(lines) if line.startswith("@@")), None)
        if named and begin is not None:
            out.append((named[2], body := "\n".join(lines[begin:]), removed_lines(body)))
    return out


def removed_lines(body: str) -> str:
    """Lines that begin with one or two dashes, without the first; three dashes make a header."""
    return "\n".join(line[1:] for line in body.splitlines() if line.startswith("-") and not line.startswith("---"))


def ranges_of(diff: str) -> list[tuple[str, int, int]]:
    """(file, start, end) of the new side of every hunk; a hunk without a count has one line, an empty one none.

    The file is the header line's: `+++ ` and `--- ` also begin lines of content.
    """
    out = []
    for header, *lines in _sections(diff):
        if named := _SHOW.match(header):
            hunks = (m for line in lines if (m := _HUNK.match(line)))
            out += [(named[2], start, start + n - 1) for start, n in ((int(m[1]), int(m[2] or 1)) for m in hunks) if n]
    return out


def _table(diffs: DataFrame, parse, names: list[str], schema: str) -> DataFrame:
    kept = [f for f in diffs.schema if f.name != "diff"]

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(*row, k, *found) for *row, diff in batch.itertuples(index=False) for k, found in enumerate(parse(diff))]
            yield pd.DataFrame(rows, columns=[*(f.name for f in kept), "ord", *names])

    return diffs.select(*(f.name for f in kept), "diff").mapInPandas(of, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "ord int", schema]))


#: What ends a line, besides which a last line needs no end.
_ENDS = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029]"


def lines_of(diffs: DataFrame, key: list[str]) -> DataFrame:
    """key, pos, line of each diff's lines; a key names one diff."""
    lines = F.split("diff", _ENDS, -1)
    lines = F.when(F.element_at(lines, -1) == "", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)
    return diffs.select(*key, F.posexplode(lines).alias("pos", "line"))


def _carried(lines: DataFrame, key: list[str]) -> DataFrame:
    """Lines of files with the header line of their file, its place (section), and of the last hunk's first line.

    lines: key, pos, line, of any source: a diff may be larger than a task's memory, since header and hunk are carried
    forward over its ordered lines.
    """
    w = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins, line = F.startswith("line", F.lit("diff --git ")), F.col("line")
    last = lambda c: F.last(c, ignorenulls=True).over(w)
    new = F.nullif(F.nullif(_named(line, "+++ ", "b/"), F.lit("/dev/null")), F.lit(""))
    old = F.nullif(F.nullif(_named(line, "--- ", "a/"), F.lit("/dev/null")), F.lit(""))
    rows = lines.select("*", begins.alias("begins"), new.alias("new"), old.alias("old"))
    rows = rows.select("*", last(F.when(begins, line)).alias("header"), last(F.when(begins, F.col("pos"))).alias("section"), last(F.when(line.startswith("@@"), F.col("pos"))).alias("hunk"), last(F.when(F.col("new").isNotNull(), F.col("pos"))).alias("named"))
    return rows.filter(F.col("section").isNotNull() & ~F.col("begins")).withColumn("in_hunk", F.coalesce(F.col("hunk") > F.col("section"), F.lit(False)))


def _named(line: Column, mark: str, prefix: str) -> Column:
    bare = F.regexp_replace(F.substring(line, 5, 1 << 30), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    return F.when(line.startswith(mark), F.regexp_replace(bare, "^" + prefix, ""))


def files_in(lines: DataFrame, key: list[str], pull: bool) -> DataFrame:
    """key, ord, path, body, removed: the files of diffs that come as lines, as files_of_pull or files_of_show tell them.

    Only a file's own lines meet in a row.
    """
    rows, line = _carried(lines, key), F.col("line")
    header = (line.startswith("+++ ") | line.startswith("--- ")) if pull else F.lit(False)
    kept, gone = F.col("in_hunk") & ~header, line.startswith("-") & ~line.startswith("---")
    ordered = lambda keep, x: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(keep, F.struct("pos", x.alias("x"))))), lambda v: v["x"]), "\n")
    new, old = F.max(F.when(F.col("new").isNotNull(), F.struct("pos", "new"))), F.min(F.when(F.col("old").isNotNull() & ~F.coalesce(F.col("named") > F.col("section"), F.lit(False)), F.struct("pos", "old")))
    files = rows.groupBy(*key, "section", "header").agg(ordered(kept, line).alias("body"), ordered(kept & gone, F.substring(line, 2, 1 << 30)).alias("removed"), F.bool_or("in_hunk").alias("in_hunk"), new.alias("n"), old.alias("o"))
    shown = F.nullif(F.regexp_extract("header", r"(?s)^diff --git a/(.+) b/(.+)\z", 2), F.lit(""))
    files = files.withColumn("path", F.coalesce("n.new", "o.old") if pull else F.when(F.col("in_hunk"), shown)).filter("path IS NOT NULL")
    return files.select(*key, (F.row_number().over(Window.partitionBy(*key).orderBy("section")) - 1).alias("ord"), "path", "body", "removed")


def ranges_in(lines: DataFrame, key: list[str]) -> DataFrame:
    """key, ord, file, start, end: the new sides of the hunks of diffs that come as lines, as ranges_of tells them."""
    part = lambda k: F.regexp_extract("line", r"^@@ -\d+(?:,\d+)? \+(\d+)(?:,(\d+))? @@", k)
    start, n = part(1).try_cast("int"), F.coalesce(F.nullif(part(2), F.lit("")).try_cast("int"), F.lit(1))
    path = F.nullif(F.regexp_extract("header", r"(?s)^diff --git a/(.+) b/(.+)\z", 2), F.lit(""))
    rows = _carried(lines, key).select(*key, "pos", path.alias("file"), start.alias("start"), (start + n - 1).alias("end")).filter("file IS NOT NULL AND end >= start")
    return rows.select(*key, (F.row_number().over(Window.partitionBy(*key).orderBy("pos")) - 1).alias("ord"), "file", "start", "end")


def parsed(diffs: DataFrame, pull: bool, key: list[str] | None = None) -> DataFrame:
    """The files of each diff, in order; diffs: diff and further columns, which are kept.

    With a key that names a diff its lines are dealt with in the JVM, else each diff is a text of one Python call.
    """
    if key:
        others = [c for c in diffs.columns if c != "diff"]
        found = files_in(lines_of(diffs, key), key, pull)
        return (diffs.select(*others).join(found, key) if set(others) > set(key) else found).select(*others, "ord", "path", "body", "removed")
    return _table(diffs, files_of_pull if pull else files_of_show, ["path", "body", "removed"], "path string, body string, removed string")


def added_ranges(diffs: DataFrame, key: list[str] | None = None) -> DataFrame:
    if key:
        return ranges_in(lines_of(diffs, key), key)
    return _table(diffs, ranges_of, ["file", "start", "end"], "file string, start int, end int")


def removed_of(body: Column) -> Column:
    """removed_lines in the JVM."""
    return F.array_join(F.transform(F.filter(F.split(body, "\n"), lambda x: x.startswith("-") & ~x.startswith("---")), lambda x: F.substring(x, 2, 1 << 30)), "\n")


def commit_corpus(commits: DataFrame, ticket: str = T.TICKET) -> DataFrame:
    """Corpus rows of fix commits.  commits: repo, sha, subject, message, committed_at, diff.

    Diffs of a file are cut at MAX_DIFF_BYTES before removed lines are taken; test files, unknown languages and files
    without removed text go.
    """
    fixes = commits.filter(T.is_fix_title(F.col("subject"), ticket))
    rows = parsed(fixes, pull=False).filter(~T.is_test_path(F.col("path"))).withColumn("language", T.language(F.col("path"))).filter("language IS NOT NULL")
    rows = rows.withColumn("body_cut", T.byte_capped(F.col("body"))).withColumn("buggy_code", removed_of(F.col("body_cut"))).filter(T.not_blank(F.col("buggy_code")))
    return rows.select(T.bug_key(F.lit(None), F.col("sha")).alias("bug_key"), "repo", F.col("path").alias("file_path"), "language", "buggy_code", F.col("body_cut").alias("fix_diff"), T.truncated_title(F.col("subject")).alias("bug_summary"), T.ticket_keys(F.col("subject"), F.col("message"), ticket=ticket).alias("jira_labels"), F.lit(0.7).alias("szz_confidence"), T.pr_number_of(F.col("subject")).alias("pr_number"), T.excerpt(F.col("message")).alias("pr_body_excerpt"), "committed_at", F.col("sha").alias("commit_sha"))


def pull_corpus(pulls: DataFrame) -> DataFrame:
    """Corpus rows of merged fixes; file diffs beyond MAX_DIFF_BYTES are left out whole.  pulls: repo, number, title, message, url, diff."""
    rows = parsed(pulls.filter(T.is_fix_title(F.col("title"))), pull=True).withColumn("language", T.language(F.col("path")))
    rows = rows.filter(F.col("language").isNotNull() & ~T.is_test_path(F.col("path")) & T.not_blank(F.col("removed")) & (T.byte_length(F.col("body")) <= T.MAX_DIFF_BYTES))
    return rows.select(T.bug_key(F.col("number"), F.lit(None)).alias("bug_key"), "repo", F.col("path").alias("file_path"), "language", F.col("removed").alias("buggy_code"), F.col("body").alias("fix_diff"), T.truncated_title(F.col("title")).alias("bug_summary"), F.lit(0.9).alias("szz_confidence"), F.col("url").alias("pr_url"), T.excerpt(F.col("message")).alias("pr_body_excerpt"))
