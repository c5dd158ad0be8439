"""Declarative rules over lines and texts, planned into one pass whatever their number."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T


@dataclass(frozen=True)
class Rule:
    """pattern and no not_pattern in a line; paths: patterns of files that it looks at or leaves."""

    name: str
    severity: str
    pattern: str
    not_pattern: str | None = None
    path_include: str | None = None
    path_exclude: str | None = None


#: Patterns that mean the same to Java's and RE2's engines.
CATALOGUE = (
    Rule("hardcoded-api-key", "high", r'(api[_-]?key|secret|token|password)[a-z0-9_]*\s*=\s*"[a-z0-9_-]{24,}"'),
    Rule("license-line", "low", r"licen[sc]e", r"all rights"),
    Rule("private-address", "medium", r"[a-z0-9._]+@[a-z0-9.]+\.[a-z]{2,}"),
    Rule("network-address", "medium", r"(^|[^0-9.])[0-9]{1,3}(\.[0-9]{1,3}){3}([^0-9.]|$)"),
    Rule("never-seen", "high", r"no text says this, surely"),
)


def hits(line: Column, low: Column, rule: Rule, path: Column | None = None) -> Column:
    found = low.rlike(rule.pattern)
    if rule.not_pattern:
        found = found & ~low.rlike(rule.not_pattern)
    if path is not None and rule.path_include:
        found = found & path.rlike(rule.path_include)
    if path is not None and rule.path_exclude:
        found = found & ~path.rlike(rule.path_exclude)
    return found


def lines_of(files: DataFrame, text: str = "text") -> DataFrame:
    """files with line (from 1) and its text in place of the whole text."""
    keep = [c for c in files.columns if c != text]
    return files.select(*keep, F.posexplode(F.split(text, "\n", -1)).alias("pos", "value")).select(*keep, (F.col("pos") + 1).alias("line"), "value")


def line_findings(files: DataFrame, rules: tuple[Rule, ...] = CATALOGUE, path: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """A finding for each line and rule that hits it.  files: file, text and the columns to keep.

    Each rule looks at each line by itself, as columns of one projection over the exploded lines, lowered once.
    """
    low, p = F.col("_low"), F.col(path) if path else None
    found = F.filter(F.array(*(F.when(hits(F.col("value"), low, r, p), F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"))) for r in rules)), lambda x: x.isNotNull())
    rows = lines_of(files).withColumn("_low", F.lower("value")).select("*", F.explode(found).alias("f"))
    return rows.select("f.rule", "f.severity", "file", "line", F.left(F.btrim("value"), F.lit(200)).alias("snippet"), *keep)


def rule_table(spark: SparkSession, rules: tuple[Rule, ...] = CATALOGUE) -> DataFrame:
    return spark.createDataFrame([(r.name, r.severity) for r in rules], "rule string, severity string")


def summary(findings: DataFrame, rules: DataFrame) -> DataFrame:
    """Findings of each rule, 0 for rules without any; rules that only findings know are added.  One aggregation of one scan."""
    counts = findings.groupBy("rule").agg(F.count("*").alias("n"), F.first("severity").alias("_s"))
    return rules.join(counts, "rule", "full").select("rule", F.coalesce("severity", "_s").alias("severity"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def summary_sets(findings: DataFrame) -> DataFrame:
    """Counts by rule, by severity and of all, in one aggregation."""
    return findings.groupingSets([[F.col("rule")], [F.col("severity")], []], "rule", "severity").agg(F.count("*").alias("n"))


def guarded(lines: DataFrame, key: str, pattern: str, context: str, back: int = 2) -> DataFrame:
    """Lines that match pattern and have context in themselves or in the lines before.  lines: key, line, value."""
    w = Window.partitionBy(key).orderBy("line")
    near = F.concat_ws("\n", *(F.lag("value", k).over(w) for k in range(back, 0, -1)), F.col("value"))
    return lines.withColumn("near", near).filter(F.lower("value").rlike(pattern) & F.lower("near").rlike(context)).drop("near")


def context_window(lines: DataFrame, key: str, marked: Column, around: int = 15) -> DataFrame:
    """For each marked line its neighbourhood as text, numbers right-aligned and the line itself marked."""
    at = F.col("line").alias("at")
    wanted = lines.filter(marked).select(key, at, F.explode(F.sequence(F.col("line") - around, F.col("line") + around)).alias("line"))
    near = wanted.join(lines, [key, "line"])
    text = F.concat(F.when(F.col("line") == F.col("at"), ">>").otherwise("  "), F.lit(" "), F.lpad(F.col("line").cast("string"), 5, " "), F.lit("  "), F.col("value"))
    rows = near.groupBy(key, "at").agg(F.sort_array(F.collect_list(F.struct("line", text.alias("text")))).alias("x"))
    return rows.select(key, F.col("at").alias("line"), F.array_join(F.transform("x", lambda v: v["text"]), "\n").alias("context"))


def deep_prefilter(files: DataFrame, rule: str, hint: str | None, words: list[str]) -> DataFrame:
    """Lines worth a closer look: by the rule's pattern, or its first five words of five letters or more."""
    chosen = sorted({w for w in words if len(w) >= 5})[:5]
    pattern = hint or "|".join(chosen)
    rows = lines_of(files).filter(F.col("value").rlike(pattern) if pattern else F.lit(False))
    rows = rows.filter(~T.is_finding_in_tests(F.col("file").cast("string")))
    return rows.select(F.lit(rule).alias("rule"), F.lit("medium").alias("severity"), "file", "line", F.left(T.strip(F.col("value")), F.lit(200)).alias("snippet"), F.lit("pending_llm_review").alias("message"))


def either_not(files: DataFrame, text: str, either: list[str], none: list[str]) -> DataFrame:
    """Files in which one of some patterns matches and none of others."""
    return files.filter(T.any_of(F.col(text), either) & ~T.any_of(F.col(text), none))


def inside(outer: DataFrame, inner: DataFrame, negate: bool = False, bucket: int = 4096) -> DataFrame:
    """inner spans (file, begin, stop) that lie within an outer span of their file, or don't.

    Outer spans are cut at multiples of bucket, so that an inner one meets those only that reach the bucket it begins in.
    """
    cut = F.explode(F.sequence(F.floor(F.col("begin") / bucket), F.floor(F.col("stop") / bucket))).alias("_k")
    o = outer.select(F.col("file").alias("_f"), F.col("begin").alias("_b"), F.col("stop").alias("_s"), cut)
    on = (F.col("file") == F.col("_f")) & (F.floor(F.col("begin") / bucket) == F.col("_k")) & (F.col("begin") >= F.col("_b")) & (F.col("stop") <= F.col("_s"))
    return inner.join(o, on, "left_anti" if negate else "left_semi")
