"""Readers of the engine's inputs: JSON lines, git logs, source files, rules, bundles, scan reports, configuration."""

from __future__ import annotations

import os
import tomllib
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as T
from ..operators.relational import first_of


def config(text: str, env: dict[str, str] | None = None) -> dict:
    """A TOML configuration.  Values `env:NAME` come from the environment; ticket_pattern is bounded and ignores case;
    repos (or the older name services) are `name:branch`, branch main if there is none."""
    env = dict(os.environ) if env is None else env

    def filled(x):
        if isinstance(x, dict):
            return {k: filled(v) for k, v in x.items()}
        if isinstance(x, list):
            return [filled(v) for v in x]
        return env.get(x[4:], "") if isinstance(x, str) and x.startswith("env:") else x

    out = filled(tomllib.loads(text))
    for section in out.values():
        if isinstance(section, dict):
            if "ticket_pattern" in section:
                section["ticket_pattern"] = rf"(?i)\b({section['ticket_pattern']})\b"
            if repos := section.get("repos", section.get("services")):
                section["repos"] = [dict(zip(("name", "branch"), [*r.split(":", 1), "main"][:2], strict=True)) for r in repos]
    return out


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """strict: a malformed line fails the query; else it is left out."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def rows_of_table(spark: SparkSession, name: str, columns: list[str], where: str | None = None) -> DataFrame:
    """Columns and rows of a table of the catalogue; what `where` says about columns of files or partitions reaches the scan."""
    rows = spark.table(name)
    return (rows.filter(where) if where else rows).select(*columns)


def issues(df: DataFrame, project: str, since: str, limit: int = 500) -> DataFrame:
    """Resolved bugs of a project, latest first."""
    return df.filter((F.col("project") == project) & (F.col("type") == "Bug") & F.col("status").isin("Done", "Closed", "Resolved") & (F.col("resolved_at") >= F.lit(since).cast("timestamp"))).orderBy(F.desc("resolved_at"), "key").limit(limit)


def pull_requests(df: DataFrame, ticket: str = T.TICKET) -> DataFrame:
    """Merged ones that name their bug in title, body or a commit, or any ticket in the body; org, repo and number of the link."""
    part = lambda k: F.regexp_extract("pr_url", r"/([^/]+)/([^/]+)/pull/(\d+)", k)
    named = F.coalesce(F.col("title").contains(F.col("bug_key")), F.lit(False)) | F.coalesce(F.col("body").contains(F.col("bug_key")), F.lit(False)) | F.coalesce(F.exists("commit_messages", lambda m: m.contains(F.col("bug_key"))), F.lit(False)) | F.coalesce(F.col("body").rlike(rf"(?i){ticket}"), F.lit(False))
    return df.filter(F.col("merged") & named).withColumns({"org": part(1), "repo": part(2), "number": part(3).try_cast("int")})


def merged_since(df: DataFrame, since: str, limit: int, key: str = "number") -> DataFrame:
    """The latest merged pull requests since a day."""
    return df.filter(F.col("merged") & (F.col("merged_at") >= F.lit(since).cast("timestamp"))).orderBy(F.desc("merged_at"), key).limit(limit)


def git_log(spark: SparkSession, path: str) -> DataFrame:
    """sha, author, date, subject, body of a log whose fields end with NUL and whose records end with RS; short records go."""
    parts = F.split(F.regexp_replace("value", r"^\n", ""), "\u0000", -1)
    return spark.read.option("lineSep", "\x1e").text(path).select(parts.alias("p")).filter(F.size("p") >= 5).select(*(F.col("p")[i].alias(n) for i, n in enumerate(("sha", "author", "committed_at", "subject", "body"))))


def chosen_files(files: DataFrame, include: list[str] = ("**/*.scala",), exclude: list[str] = (), tests: bool = False, path: str = "path") -> DataFrame:
    """Files whose path matches an include and no exclude; test files only if asked for, tooling files never."""
    p = F.col(path)
    keep = T.any_of(p, [T.glob_to_regex(g) for g in include]) & ~p.rlike(T.TOOLING_PATH) & ~T.any_of(p, [T.glob_to_regex(g) for g in exclude])
    return files.filter(keep if tests else keep & ~p.rlike(T.SCAN_TEST_PATH))


def source_files(spark: SparkSession, root: str, **chosen) -> DataFrame:
    """path (below root) and text of the chosen files."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(root)
    below = F.regexp_replace(F.input_file_name(), r"^.*?" + root.rstrip("/").removeprefix("file://").replace(".", r"\.") + "/", "")
    return chosen_files(files.select(below.alias("path"), F.col("value").alias("text")), **chosen)


def rule_specs(sources: DataFrame, rationales: DataFrame, base: str, repo: str) -> DataFrame:
    """Rules by class name, the first by path; a rationale goes with a rule whose name it holds, the first by path.

    sources, rationales: path, text.
    """
    named = sources.withColumn("name", F.regexp_extract("text", r'class\s+(\w+)[^{]*?extends\s+\w*Rule\s*\(', 1)).filter("name <> ''")
    rules = first_of(named.select("name", "path", "text"), ["name"], "path")
    word = rationales.select(F.col("path").alias("rationale_path"), F.col("text").alias("rationale"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(\w+)"), 1))).alias("name"))
    why = first_of(word, ["name"], "rationale_path")
    out = rules.join(why, "name", "left")
    text = F.coalesce("rationale", F.lit(""))
    links = T.citations(text, base, repo)
    hint = F.regexp_extract(text, r"(?m)^\s*regex_hint\s*[:=]\s*`?(.+?)`?\s*$", 1)
    return out.select("name", F.col("path").alias("source_path"), "rationale_path", T.severity_of(text).alias("severity"), F.regexp_extract_all("text", F.lit(r'Diagnostic\(\s*"[^"]*"\s*,\s*s?"([^"]+)"'), 1).alias("diagnostic_keywords"), F.nullif(hint, F.lit("")).alias("regex_hint"), links.alias("citations"))


def yaml_rule_files(files: DataFrame, preferred: str = "opengrep/") -> DataFrame:
    """Rule files: those of the preferred folder, then others that have a rules key near their start; none deferred."""
    own = F.col("path").contains(preferred)
    yaml = files.filter(F.col("path").rlike(r"\.ya?ml$") & ~F.col("path").contains("deferred/"))
    return yaml.filter(own | F.left("text", F.lit(4000)).rlike(r"(?m)^\s*rules\s*:")).withColumn("preferred", own).dropDuplicates(["path"])


def yaml_rules(files: DataFrame) -> DataFrame:
    """id, severity, languages, message, category of every rule of YAML files; what can't be parsed has none."""

    def of(batches: Iterator) -> Iterator:
        import pandas as pd
        import yaml

        for batch in batches:
            rows = []
            for path, text in zip(batch.path, batch.text, strict=True):
                try:
                    found = (yaml.safe_load(text or "") or {}).get("rules") or []
                except (yaml.YAMLError, AttributeError):
                    found = []
                rows += [(path, str(r.get("id", "")), str(r.get("severity", "")), [str(x) for x in r.get("languages") or []], " ".join(str(r.get("message", "")).split()), str((r.get("metadata") or {}).get("category", "uncategorized"))) for r in found if isinstance(r, dict)]
            yield pd.DataFrame(rows, columns=["path", "id", "severity", "languages", "message", "category"])

    out = files.select("path", "text").mapInPandas(of, "path string, id string, severity string, languages array<string>, message string, category string")
    return out.withColumn("severity", T.engine_severity(F.col("severity")))


def bundles(spark: SparkSession, path: str, files: str = "bundle.json") -> DataFrame:
    """Cluster bundles, one a file below cluster_ folders, with the language that the folder above names."""
    return spark.read.schema(schemas.BUNDLE).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", files).json(path).withColumn("language", F.regexp_extract(F.input_file_name(), r"/([^/]+)/cluster_[^/]*/[^/]+$", 1))


def preferred_bundles(spark: SparkSession, root: str, files: str = "bundle.json", folders: tuple[str, ...] = ("clusters_v2", "clusters")) -> DataFrame:
    """Bundles of the first of some folders that is there, with its name; none if none is."""
    for name in folders:
        try:
            return bundles(spark, f"{root}/{name}", files).withColumn("folder", F.lit(name))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], f"{schemas.BUNDLE}, language string, folder string")


def candidates(files: DataFrame) -> DataFrame:
    """Per cluster folder: rule if there is a rule file, skipped if it says so, else unknown; class name; start of the rationale."""
    cluster = F.regexp_extract("path", r"(cluster_\d+)/", 1)
    kind = F.regexp_extract("path", r"\.([a-z]+)$", 1)
    rule = kind.isin("scala", "yaml")
    out = files.withColumn("cluster", cluster).filter("cluster <> ''").groupBy("cluster").agg(F.bool_or(rule).alias("has_rule"), F.bool_or(F.col("path").rlike(r"/SKIP(PED)?(\.\w+)?$")).alias("skipped"), F.min_by("text", F.when(rule, F.col("path"))).alias("rule_text"), F.min_by("text", F.when(kind == "md", F.col("path"))).alias("why"))
    return out.select("cluster", F.when(F.col("has_rule"), "rule").when(F.col("skipped"), "skipped").otherwise("unknown").alias("status"), F.regexp_extract(F.coalesce("rule_text", F.lit("")), r"class\s+(\w+)[^\n]*extends", 1).alias("class_name"), F.left(F.coalesce("why", F.lit("")), F.lit(500)).alias("rationale"))


def latest_scans(files: DataFrame) -> DataFrame:
    """The scan reports of the highest iteration.  files: path; adds iter, suffix and repo."""
    part = lambda k: F.regexp_extract("path", r"scan_iter(\d+)([a-z]?)_?([a-z_]*)\.json$", k)
    out = files.withColumns({"iter": part(1).try_cast("int"), "suffix": part(2), "repo": part(3)}).filter("iter IS NOT NULL")
    return out.join(out.agg(F.max("iter").alias("iter")), "iter", "left_semi")


def engine_findings(reports: DataFrame, column: str = "report") -> DataFrame:
    """Findings of an external engine's JSON reports; those in test files go."""
    parsed = F.from_json(column, schemas.ENGINE_REPORT)
    r = reports.select(F.explode(parsed["results"]).alias("r")).select("r.*")
    out = r.select(T.last_segment(F.coalesce("check_id", F.lit(""))).alias("rule"), T.engine_severity(F.coalesce("extra.severity", F.lit("WARNING"))).alias("severity"), F.col("path").alias("file"), F.coalesce("start.line", F.lit(0)).alias("line"), F.left(T.strip(F.coalesce("extra.lines", F.lit(""))), F.lit(200)).alias("snippet"), T.strip(F.coalesce("extra.message", F.lit(""))).alias("message"))
    return out.filter(~T.is_finding_in_tests(F.col("file")))


def compiler_findings(lines: DataFrame) -> DataFrame:
    """Findings of a linter's output; lines: run, n, line.  The snippet is of the up to three lines that follow."""
    from pyspark.sql import Window

    w = Window.partitionBy("run").orderBy("n")
    after = [F.lead("line", k).over(w) for k in (1, 2, 3)]
    plain = lambda c: F.when(T.diagnostic(c).isNull(), c)
    a, b, c = (plain(x) for x in after)
    follow = F.concat_ws(" ", a, F.when(a.isNotNull(), b), F.when(a.isNotNull() & b.isNotNull(), c))
    return lines.withColumns({"d": T.diagnostic(F.col("line")), "follow": follow}).filter("d IS NOT NULL").select("run", "d.rule", "d.severity", "d.file", F.col("d.line").alias("line"), F.left(T.strip(F.col("follow")), F.lit(200)).alias("snippet"), "d.message")
