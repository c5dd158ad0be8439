"""Further queries of the catalogue: sources and sinks, columns of commits and answers, diffs, scanners, validation, upkeep.

Inputs that the star schema has no table for (titles, paths, diffs, reports) are made from its rows, differently for each
row; the SQL says what must come out without asking the code under test.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import LINES, query
from .functions import text as T
from .functions import vectors as V
from .operators import corpus, diffs, hdbscan, quality, report, scanners
from .plans import batch
from .session import shared_folder, table
from .sources import readers, sinks
from .streaming import incremental


def _docs(spark: SparkSession, at: str) -> DataFrame:
    return table(spark, "documents", at)


def _pick(number: Column, *values: str) -> Column:
    """One of the values by the number's remainder."""
    return F.element_at(F.array(*(F.lit(v) for v in values)), (number % len(values) + 1).cast("int"))


def _pick_sql(number: str, *values: str) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"][{number} % {len(values)} + 1]"


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _joined(x: Column) -> Column:
    return F.array_join(x, ",")


FIRST = "string_split(text, chr(10))[1]"


def _first(text: str = "text") -> Column:
    return F.split(text, "\n", -1)[0]


# --- columns of commits, paths and texts ---


@query("""SELECT o_orderkey, CASE WHEN even THEN 'PR-' || o_orderkey ELSE 'commit-' || left(sha, 12) END AS bug_key, CASE WHEN even THEN 'PR-' || o_orderkey ELSE left(sha, 10) END AS label,
  'commit-' || left(sha, 12) AS commit_key, ['.scala', '.ts', '.js', '.txt'][o_orderkey % 4 + 1] AS ext FROM (SELECT o_orderkey, o_orderkey % 2 = 0 AS even, md5(CAST(o_orderkey AS VARCHAR)) AS sha FROM orders)""")
def commit_keys(spark, at):
    o = table(spark, "orders", at).select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("Fix it (#"), "o_orderkey", F.lit(")"))).otherwise("Fix it").alias("subject"), F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("sha"))
    n, sha = T.pr_number_of(F.col("subject")), F.col("sha")
    url = F.when(n.isNotNull(), F.concat(F.lit("https://h/o/r/pull/"), n))
    return o.select("o_orderkey", T.bug_key(n, sha).alias("bug_key"), T.pr_label(url, sha).alias("label"), T.bug_key(F.lit(None).cast("int"), sha).alias("commit_key"), T.file_extension(_pick(F.col("o_orderkey"), "scala", "typescript", "javascript", "go")).alias("ext"))


TITLES = ("fix: ", "[x] Fix ", "abc-12 ", "chore: tidy ", "Merge branch ", "prefix fixed ")


@query(f"""SELECT doc_id, title, regexp_matches(title, '(?i)[A-Z][A-Z0-9]+-\\d+') OR regexp_matches(title, '(?i)^(fix|bugfix|hotfix)[\\(\\[:]') OR regexp_matches(title, '(?i)\\bfix:') OR regexp_matches(title, '(?i)^\\[.*\\]\\s*fix') AS is_fix,
  regexp_matches(title, '(?i)(merge pull request|^merge\\b|\\bchore\\b|\\brefactor(ing)?\\b|\\brename(d|s|ing)?\\b|\\bcleanup\\b|\\bformatting\\b|\\bimports?\\b|\\bbump\\b|\\bversion bump\\b|\\breorganize\\b|\\bmove (file|files|folder)\\b)') AS is_noise,
  regexp_matches({FIRST}, '[^ \\t\\n\\f\\r\\v]') AS filled FROM (SELECT doc_id, text, {_pick_sql('doc_id', *TITLES)} || lang || ' ' || source AS title FROM documents)""")
def fix_titles(spark, at):
    title = F.concat(_pick(F.col("doc_id"), *TITLES), "lang", F.lit(" "), "source")
    return _docs(spark, at).select("doc_id", title.alias("title"), T.is_fix_title(title).alias("is_fix"), T.is_noise_summary(title).alias("is_noise"), T.not_blank(_first()).alias("filled"))


FOLDERS = ("a/test/", "test/", "src/it/", "src/main/", "a/b/")
ENDINGS = ("Test.scala", ".spec.tsx", ".test.js", "IT.scala", ".scala", ".py", ".md")


@query(f"""SELECT doc_id, path, path LIKE '%/test/%' OR path LIKE '%/tests/%' OR path LIKE '%Test.scala' OR path LIKE '%IT.scala' OR path LIKE '%.test.js' OR path LIKE '%.spec.tsx' AS is_test,
  path LIKE '%/test/%' OR path LIKE '%/it/%' OR path LIKE '%Test.scala' AS finding_in_tests, split_part(path, '/', 1) = 'test' OR path LIKE '%/test/%' OR path LIKE '%/it/%' OR path LIKE '%Test.scala' OR path LIKE '%IT.scala' AS scan_test, path NOT LIKE '%.md' AS is_source
  FROM (SELECT doc_id, {_pick_sql('doc_id', *FOLDERS)} || 'F' || doc_id || {_pick_sql('doc_id', *ENDINGS)} AS path FROM documents)""")
def path_filters(spark, at):
    path = F.concat(_pick(F.col("doc_id"), *FOLDERS), F.lit("F"), F.col("doc_id").cast("string"), _pick(F.col("doc_id"), *ENDINGS))
    return _docs(spark, at).select("doc_id", path.alias("path"), T.is_test_path(path).alias("is_test"), T.is_finding_in_tests(path).alias("finding_in_tests"), path.rlike(T.SCAN_TEST_PATH).alias("scan_test"), T.is_source_file(path).alias("is_source"))


@query("""SELECT o_orderkey, coalesce(n, 0) = 0 OR coalesce(s % 3, 0) + o_orderkey % 2 < 2 AS trivial FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_linenumber) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def trivial_commits(spark, at):
    files = table(spark, "lineitem", at).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), (F.sum("l_linenumber") % 3).alias("added"))
    return table(spark, "orders", at).join(files, "o_orderkey", "left").select("o_orderkey", T.is_trivial_commit(F.col("n"), F.col("added"), F.col("o_orderkey") % 2).alias("trivial"))


@query(f"""SELECT doc_id, md5('# Bug' || chr(10) || {FIRST} || repeat(chr(10), 2) || '# Buggy code' || chr(10) || text || repeat(chr(10), 2) || '# Fix diff' || chr(10) || left(text, 2000) || repeat(chr(10), 2) || '# Labels' || chr(10) || lang || ', ' || source) AS rich,
  md5(concat_ws(chr(10), {FIRST}, text, '', lang, source)) AS plain, md5({FIRST} || chr(10) || text || chr(10) || left(text, 1500)) AS continuous FROM documents""")
def embedding_texts(spark, at):
    s, t = _first(), F.col("text")
    md5 = lambda c: F.md5(c.cast("binary"))
    return _docs(spark, at).select("doc_id", md5(T.rich_text(s, t, t, F.array("lang", "source"))).alias("rich"), md5(T.plain_text(s, t, F.lit(None).cast("string"), F.col("lang"), F.col("source"))).alias("plain"), md5(T.continuous_text(s, t, t)).alias("continuous"))


def _capped_sql(text: str, most: int) -> str:
    """A text cut at bytes: a character that the cut splits becomes a replacement mark."""
    cuts = ", ".join(f"try(decode(encode({text})[1:{most - k}])) || chr(65533)" for k in (1, 2, 3))
    return f"CASE WHEN octet_length(encode({text})) <= {most} THEN {text} ELSE coalesce(try(decode(encode({text})[1:{most}])), {cuts}) END"


@query(f"SELECT doc_id, {_capped_sql('text', 1001)} AS capped FROM documents")
def byte_cut(spark, at):
    return _docs(spark, at).select("doc_id", T.byte_capped(F.col("text"), 1001).alias("capped"))


@query("""SELECT doc_id, ['high', 'low', 'low', 'high', 'medium'][doc_id % 5 + 1] AS severity, ['high', 'medium', 'low', 'medium'][doc_id % 4 + 1] AS engine, 'rule' || doc_id AS segment FROM documents""")
def severities(spark, at):
    said = F.concat(_pick(F.col("doc_id"), "an author ", "cosmetic ", "x\n Severity: LOW\n", "severity= high\n", "plain "), F.col("source"))
    return _docs(spark, at).select("doc_id", T.severity_of(said).alias("severity"), T.engine_severity(_pick(F.col("doc_id"), "ERROR", "warning", "Info", "odd")).alias("engine"), T.last_segment(F.concat(F.lit("a."), "source", F.lit(".rule"), F.col("doc_id").cast("string"))).alias("segment"))


@query("""SELECT doc_id, 'PROJ-' || doc_id AS first_key, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all('proj-' || doc_id || ' PROJ-' || doc_id || ' ab2-7' || chr(1) || text, '(?i)[A-Z][A-Z0-9]+-\\d+'), lambda k: upper(k)))), ',') AS keys FROM documents""")
def ticket_keys(spark, at):
    d = F.col("doc_id").cast("string")
    keys = T.ticket_keys(F.concat(F.lit("proj-"), d, F.lit(" PROJ-"), d, F.lit(" ab2-7")), F.col("text"))
    return _docs(spark, at).select("doc_id", keys[0].alias("first_key"), _joined(F.array_sort(keys)).alias("keys"))


@query("""SELECT conv_id, turn, role, regexp_replace(CASE turn % 3 WHEN 2 THEN '```' || text ELSE text END, '^[ \\t\\n\\f\\r\\v]+|[ \\t\\n\\f\\r\\v]+$', '', 'g') AS code FROM conversations""")
def fenced_answers(spark, at):
    said = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("said\n```scala\n"), "text", F.lit("\n```\nend"))).when(F.col("turn") % 3 == 1, F.concat(F.lit(" \n"), "text", F.lit("\t "))).otherwise(F.concat(F.lit("```"), "text"))
    return table(spark, "conversations", at).select("conv_id", "turn", "role", T.fenced(said).alias("code"))


@query("""SELECT doc_id, 'https://h/o/repo' || doc_id % 3 || '/pull/' || doc_id AS pr_url, 'fix of ' || source AS title FROM documents UNION ALL SELECT doc_id, 'https://h/o/r/pull/' || (doc_id + 1000), 'later. PR ' || (doc_id + 1000) FROM documents""")
def citations(spark, at):
    n = F.col("doc_id")
    text = F.concat(F.lit("see https://h/o/repo"), n % 3, F.lit("/pull/"), n, F.lit(" (fix of "), "source", F.lit(") and PR-"), n + 1000, F.lit(": later. PR "), n + 1000)
    return _docs(spark, at).select("doc_id", F.inline(T.citations(text, "https://h/o", "r")))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN 'a/F' || doc_id || '.scala' END AS file, CASE WHEN doc_id % 5 > 0 THEN CAST(doc_id % 50 + 1 AS INTEGER) END AS line, CASE WHEN doc_id % 5 > 0 THEN ['high', 'medium', 'low'][doc_id % 3 + 1] END AS severity,
  CASE WHEN doc_id % 5 > 0 THEN 'R' || doc_id % 4 END AS rule, CASE WHEN doc_id % 5 > 0 THEN source END AS message, 'b/G.scala' AS grep_file, CAST(doc_id % 1000 AS INTEGER) AS grep_line, 'x: ' || source AS grep_body, printf('%.2f%%', (doc_id % 1000) / 10.0) AS share FROM documents""")
def linter_lines(spark, at):
    n = F.col("doc_id")
    line = F.when(n % 5 > 0, F.concat(F.lit("[warn] a/F"), n, F.lit(".scala:"), n % 50 + 1, F.lit(":1: "), _pick(n, "error", "warning", "info"), F.lit(": [fix.R"), n % 4, F.lit("] "), "source")).otherwise(F.col("source"))
    d, g = T.diagnostic(line), T.grep_line(F.concat(F.lit("b/G.scala:"), n % 1000, F.lit(":x: "), "source"))
    return _docs(spark, at).select("doc_id", *(d[k].alias(k) for k in ("file", "line", "severity", "rule", "message")), g["file"].alias("grep_file"), g["line"].alias("grep_line"), g["body"].alias("grep_body"), T.percent(n % 1000 / 1000).alias("share"))


# --- sources and sinks ---


@query(f"SELECT md5(CAST(doc_id AS VARCHAR)) AS sha, source AS author, '2024-01-01' AS committed_at, {FIRST} AS subject, text AS body FROM documents WHERE doc_id % 7 > 0")
def git_log_records(spark, at):
    sha = F.md5(F.col("doc_id").cast("string").cast("binary"))
    record = F.when(F.col("doc_id") % 7 > 0, F.concat_ws("\u0000", sha, "source", F.lit("2024-01-01"), _first(), "text")).otherwise(F.concat_ws("\u0000", sha, "source"))
    path = _scratch(spark, "git-log")
    _docs(spark, at).select(F.concat(F.lit("\n"), record).alias("value")).write.option("lineSep", "\x1e").text(path)
    return readers.git_log(spark, path)


@query("SELECT doc_id, source, text FROM documents UNION ALL SELECT doc_id, source, text FROM documents")
def json_lines_appended(spark, at):
    path, rows = _scratch(spark, "json-lines"), _docs(spark, at).select("doc_id", "source", "text")
    sinks.write_json(rows, path)
    sinks.write_json(rows, path, append=True)  # repeats stay
    spark.range(3).select(F.lit('{"doc_id": broken').alias("value")).write.mode("append").text(path)
    return readers.json_lines(spark, path, "doc_id long, source string, text string")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS key, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_custkey % 3 = 1 AND o_orderkey % 5 < 4 AND o_orderstatus <> 'P' AND o_orderdate >= TIMESTAMP '1998-06-01' ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) LIMIT 500""")
def resolved_issues(spark, at):
    o = table(spark, "orders", at)
    rows = o.select(F.col("o_orderkey").cast("string").alias("key"), F.concat(F.lit("P"), F.col("o_custkey") % 3).alias("project"), F.when(F.col("o_orderkey") % 5 < 4, "Bug").otherwise("Task").alias("type"), F.when(F.col("o_orderstatus") == "O", "Done").when(F.col("o_orderstatus") == "F", "Closed").otherwise("Open").alias("status"), F.col("o_orderdate").cast("timestamp").alias("resolved_at"))
    return readers.issues(rows, "P1", "1998-06-01").select("key", T.day_of(F.col("resolved_at")).alias("day"))


def _pulls(spark, at):
    n, key = F.col("o_orderkey"), F.concat(F.lit("B-"), "o_custkey")
    said = [F.when(n % 4 == 0, F.concat(F.lit("Fix "), key)).otherwise("x"), F.when(n % 4 == 1, F.concat(F.lit("closes "), key)).when(n % 8 == 2, "see AB-12"), F.array(F.when(n % 4 == 3, F.concat(key, F.lit(": y"))).otherwise("z"))]
    url = F.concat(F.lit("https://h/org"), F.col("o_custkey") % 5, F.lit("/repo"), n % 7, F.lit("/pull/"), n)
    return table(spark, "orders", at).select("o_orderkey", key.alias("bug_key"), *(c.alias(a) for c, a in zip(said, ("title", "body", "commit_messages"), strict=True)), (n % 3 != 0).alias("merged"), url.alias("pr_url"), F.col("o_orderdate").alias("merged_at"))


@query("SELECT o_orderkey, 'org' || o_custkey % 5 AS org, 'repo' || o_orderkey % 7 AS repo, CAST(o_orderkey AS INTEGER) AS number FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 8 <> 6")
def named_pulls(spark, at):
    return readers.pull_requests(_pulls(spark, at)).select("o_orderkey", "org", "repo", "number")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderdate >= TIMESTAMP '2000-01-01' ORDER BY o_orderdate DESC, o_orderkey LIMIT 1000")
def merged_pulls_since(spark, at):
    return readers.merged_since(_pulls(spark, at), "2000-01-01", 1000, "o_orderkey").select("o_orderkey")


@query("""SELECT c_custkey, n, numbers FROM (SELECT c_custkey, count(*) AS n, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS numbers FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)""")
def nested_bugs(spark, at):
    bugs = table(spark, "customer", at).select(F.col("c_custkey").alias("key"), F.lit(None).cast("timestamp").alias("resolved_at"))
    fixes = table(spark, "orders", at).select(F.col("o_custkey").alias("bug_key"), F.col("o_orderkey").alias("pr_number"), "o_orderstatus")
    return sinks.nested_bugs(bugs, fixes).select(F.col("key").alias("c_custkey"), F.size("fixing_commits").cast("long").alias("n"), _joined(F.transform("fixing_commits", lambda c: c["pr_number"].cast("string"))).alias("numbers"))


@query("""SELECT path, CAST(CAST(strftime(ts, '%d') AS INTEGER) AS INTEGER) AS iter, CASE WHEN event_id % 2 = 0 THEN 'b' ELSE '' END AS suffix, event_type AS repo
  FROM (SELECT *, 's/scan_iter' || strftime(ts, '%d') || CASE WHEN event_id % 2 = 0 THEN 'b' ELSE '' END || '_' || event_type || '.json' AS path FROM events) WHERE event_id % 3 > 0 AND strftime(ts, '%d') = (SELECT max(strftime(ts, '%d')) FROM events WHERE event_id % 3 > 0)""")
def latest_scan_files(spark, at):
    e = table(spark, "events", at)
    name = F.concat(F.lit("s/scan_iter"), F.date_format("ts", "dd"), F.when(F.col("event_id") % 2 == 0, "b").otherwise(""), F.lit("_"), "event_type", F.lit(".json"))
    return readers.latest_scans(e.select(F.when(F.col("event_id") % 3 > 0, name).otherwise("s/other.json").alias("path"))).select("path", "iter", "suffix", "repo")


@query("""SELECT 'cluster_' || doc_id AS cluster, ['rule', 'skipped', 'unknown'][doc_id % 3 + 1] AS status, CASE WHEN doc_id % 3 = 0 THEN 'C' || doc_id ELSE '' END AS class_name, left(text, 500) AS rationale FROM documents""")
def candidate_folders(spark, at):
    d, folder = _docs(spark, at), F.concat(F.lit("out/cluster_"), "doc_id", F.lit("/"))
    one = d.select(F.concat(folder, _pick(F.col("doc_id"), "a.scala", "SKIPPED", "n.txt")).alias("path"), F.concat(F.lit("class C"), "doc_id", F.lit(" extends R")).alias("text"))
    return readers.candidates(one.unionByName(d.select(F.concat(folder, F.lit("why.md")).alias("path"), "text")))


@query("""SELECT 'R' || k AS name, 'f' || lpad(CAST(first_id AS VARCHAR), 8, '0') AS source_path, 'r' || lpad(CAST(why_id AS VARCHAR), 8, '0') AS rationale_path, ['high', 'low', 'medium'][why_id % 3 + 1] AS severity, 'x' || why_id || '+' AS regex_hint, 'Bad ' || first_id AS keyword
  FROM (SELECT doc_id % 40 AS k, min(doc_id) AS first_id FROM documents GROUP BY 1) JOIN (SELECT doc_id % 40 AS w, min(doc_id) AS why_id FROM documents GROUP BY 1) ON w = k""")
def rule_discovery(spark, at):
    d = _docs(spark, at).select("doc_id", F.concat(F.lit("R"), F.col("doc_id") % 40).alias("name"), F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("k"))
    source = d.select(F.concat(F.lit("f"), "k").alias("path"), F.concat(F.lit("class "), "name", F.lit(' extends SemanticRule("x") { Diagnostic("id", "Bad '), "doc_id", F.lit('") }')).alias("text"))
    why = d.select(F.concat(F.lit("r"), "k").alias("path"), F.concat("name", _pick(F.col("doc_id"), " leaks data loss", " is cosmetic", " is"), F.lit("\nregex_hint: `x"), "doc_id", F.lit("+`")).alias("text"))
    return readers.rule_specs(source, why, "https://h/o", "r").select("name", "source_path", "rationale_path", "severity", "regex_hint", F.col("diagnostic_keywords")[0].alias("keyword"))


@query("""SELECT 'opengrep/' || doc_id || '.yaml' AS path, 'r' || doc_id AS id, ['high', 'medium', 'low'][doc_id % 3 + 1] AS severity, lang AS language, 'a message of ' || source AS message, CASE WHEN doc_id % 2 = 0 THEN 'c' || doc_id % 5 ELSE 'uncategorized' END AS category FROM documents WHERE doc_id % 11 > 0""")
def yaml_rule_metadata(spark, at):
    n = F.col("doc_id")
    body = F.concat(F.lit("rules:\n- id: r"), n, F.lit("\n  severity: "), _pick(n, "ERROR", "WARNING", "INFO"), F.lit("\n  languages: ["), "lang", F.lit("]\n  message: >\n    a message\n    of "), "source", F.when(n % 2 == 0, F.concat(F.lit("\n  metadata:\n    category: c"), n % 5)).otherwise(""), F.lit("\n"))
    folder = F.when(n % 11 > 0, "opengrep/").otherwise("deferred/")
    rows = readers.yaml_rules(readers.yaml_rule_files(_docs(spark, at).select(F.concat(folder, n, F.lit(".yaml")).alias("path"), body.alias("text"))))
    return rows.select("path", "id", "severity", F.col("languages")[0].alias("language"), "message", "category")


@query("""SELECT 'rule' || doc_id % 9 AS rule, ['high', 'medium', 'low'][doc_id % 3 + 1] AS severity, 'a/F' || doc_id || '.scala' AS file, CAST(doc_id % 100 AS INTEGER) AS line, left(regexp_replace(text, '^[ \\t\\n\\f\\r\\v]+|[ \\t\\n\\f\\r\\v]+$', '', 'g'), 200) AS snippet, source AS message FROM documents WHERE doc_id % 6 > 0""")
def engine_reports(spark, at):
    n = F.col("doc_id")
    path = F.concat(F.when(n % 6 > 0, "a/F").otherwise("a/test/F"), n, F.lit(".scala"))
    one = F.struct(path.alias("path"), F.concat(F.lit("p.q.rule"), n % 9).alias("check_id"), F.struct((n % 100).cast("int").alias("line")).alias("start"), F.struct(F.concat(F.lit(" "), "source", F.lit(" ")).alias("message"), _pick(n, "ERROR", "WARNING", "INFO").alias("severity"), F.col("text").alias("lines")).alias("extra"))
    return readers.engine_findings(_docs(spark, at).select(F.to_json(F.struct(F.array(one).alias("results"))).alias("report")))


@query("""SELECT doc_id AS run, 'R' || doc_id % 4 AS rule, 'high' AS severity, 'a/F.scala' AS file, 3 AS line, lang || ' ' || source AS snippet, 'bad ' || source AS message FROM documents""")
def compiler_reports(spark, at):
    lines = F.array(F.lit("start"), F.concat(F.lit("a/F.scala:3:1: error: [fix.R"), F.col("doc_id") % 4, F.lit("] bad "), "source"), F.col("lang"), F.col("source"), F.lit("b/G.scala:1: odd"))
    rows = _docs(spark, at).select(F.col("doc_id").alias("run"), F.posexplode(F.slice(lines, 1, 4)).alias("n", "line"))
    return readers.compiler_findings(rows)


@query("""SELECT rule_id || CASE WHEN scalafix THEN '.scala' ELSE '.yaml' END AS path, text AS content FROM (SELECT 'no-' || doc_id AS rule_id, doc_id % 2 = 0 AS scalafix, text FROM documents)
  UNION ALL SELECT 'no-' || doc_id || '.meta.json', '{"rule_id":"no-' || doc_id || '","cluster_id":' || doc_id % 10 || ',"origin_bug_keys":["B' || doc_id || '"],"target":"' || CASE WHEN doc_id % 2 = 0 THEN 'scalafix' ELSE 'opengrep' END || '","rationale":"why ' || source || '"}' FROM documents""")
def candidate_rule_files(spark, at):
    return sinks.candidate_files(_candidates(spark, at))


def _candidates(spark, at):
    n = F.col("doc_id")
    return _docs(spark, at).select(F.concat(F.lit("no-"), n).alias("rule_id"), (n % 10).cast("int").alias("cluster_id"), F.array(F.concat(F.lit("B"), n)).alias("origin_bug_keys"), F.when(n % 2 == 0, "scalafix").otherwise("opengrep").alias("target"), F.col("text").alias("rule_source"), F.concat(F.lit("why "), "source").alias("rationale"))


@query("""SELECT 'rule/no-' || doc_id AS branch, CASE WHEN doc_id % 2 = 0 THEN 'rules/src/main/scala/fix/No' || doc_id || '.scala' ELSE 'rules/correctness/no-' || doc_id || '.yaml' END AS path, text AS content, 'Add rule no-' || doc_id AS title,
  'Precision 90.00%, recall ' || printf('%.2f%%', (doc_id % 100) * 1.0) || repeat(chr(10), 2) || 'why ' || source || repeat(chr(10), 2) || 'From: B' || doc_id AS body FROM documents WHERE doc_id % 3 = 0""")
def ship_plans(spark, at):
    n = F.col("doc_id")
    results = _docs(spark, at).select(F.concat(F.lit("no-"), n).alias("rule_id"), F.lit(0.9).alias("precision"), (n % 100 / 100).alias("recall_in_cluster"), (n % 3 == 0).alias("ship"))
    return sinks.ship_plan(_candidates(spark, at), results, "r", "correctness").select("branch", "path", "content", "title", "body")


@query("""SELECT 'at' AS scanned_at, 'r' AS repo, (SELECT string_agg(event_type || '=' || n, ',' ORDER BY event_type) FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)) AS by_rule, (SELECT string_agg(s || '=' || n, ',' ORDER BY s) FROM (SELECT 's' || user_id % 3 AS s, count(*) AS n FROM events GROUP BY 1)) AS by_severity, (SELECT count(*) FROM events) AS total""")
def scan_reports(spark, at):
    f = table(spark, "events", at).select(F.col("event_type").alias("rule"), F.concat(F.lit("s"), F.col("user_id") % 3).alias("severity"))
    flat = lambda c: _joined(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return sinks.scan_report(f, "r", "at").select("scanned_at", "repo", flat(F.col("summary.by_rule")).alias("by_rule"), flat(F.col("summary.by_severity")).alias("by_severity"), "summary.total")


@query("SELECT s_nationkey AS author, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1 ORDER BY n DESC, author LIMIT 10")
def top_authors(spark, at):
    entries = table(spark, "lineitem", at).select(F.col("l_suppkey").alias("commit_sha"))
    return report.authors(entries, table(spark, "supplier", at).select(F.col("s_suppkey").alias("sha"), F.col("s_nationkey").alias("author")))


@query("SELECT url AS path FROM pages ORDER BY url DESC, page_id LIMIT 3")
def recent_notes(spark, at):
    return report.recent(table(spark, "pages", at).select(F.col("url").alias("path")))


# --- diffs ---

#: A diff of each document: its lines in turn taken out and added; the hunk's new side has doc_id % 4 lines or, unsaid, one.
MARKED = "(SELECT *, CASE WHEN line % 2 = 1 THEN '-' ELSE '+' END || value AS marked FROM " + LINES + ")"
HUNK = "'@@ -1 +' || (doc_id % 100 + 1) || CASE WHEN doc_id % 5 > 0 THEN ',' || doc_id % 4 ELSE '' END || ' @@ x'"
SHOWN = f"(SELECT doc_id, source, lang, {HUNK} || chr(10) || string_agg(marked, chr(10) ORDER BY line) AS body, {HUNK} || coalesce(chr(10) || string_agg(marked, chr(10) ORDER BY line) FILTER (WHERE NOT starts_with(marked, '+++ ') AND NOT starts_with(marked, '--- ')), '') AS pulled, coalesce(string_agg(value, chr(10) ORDER BY line) FILTER (WHERE line % 2 = 1 AND NOT starts_with(value, '--')), '') AS removed FROM {MARKED} GROUP BY doc_id, source, lang)"


def _diffs(spark, at):
    n = F.col("doc_id")
    path = F.concat(F.lit("src/F"), n, F.lit(".scala"))
    marked = F.transform(F.split("text", "\n", -1), lambda x, i: F.concat(F.when(i % 2 == 0, "-").otherwise("+"), x))
    hunk = F.concat(F.lit("@@ -1 +"), n % 100 + 1, F.when(n % 5 > 0, F.concat(F.lit(","), n % 4)).otherwise(""), F.lit(" @@ x"))
    diff = F.concat(F.lit("diff --git a/"), path, F.lit(" b/"), path, F.lit("\nindex 1..2\n--- a/"), path, F.lit("\n+++ b/"), path, F.lit("\n"), hunk, F.lit("\n"), F.array_join(marked, "\n"))
    return _docs(spark, at).select("doc_id", "source", "lang", diff.alias("diff"))


@query(f"SELECT doc_id, 0 AS ord, 'src/F' || doc_id || '.scala' AS path, rtrim(pulled, chr(10)) AS body, removed FROM {SHOWN}")
def parse_diff(spark, at):
    return diffs.parsed(_diffs(spark, at).select("doc_id", "diff"), True, ["doc_id"]).withColumn("body", F.rtrim(F.col("body"), F.lit("\n")))


@query(f"SELECT doc_id, 0 AS ord, 'src/F' || doc_id || '.scala' AS path, rtrim(body, chr(10)) AS body, removed FROM {SHOWN}")
def show_diff(spark, at):
    return diffs.parsed(_diffs(spark, at).select("doc_id", "diff"), False, ["doc_id"]).withColumn("body", F.rtrim(F.col("body"), F.lit("\n")))


@query("SELECT doc_id, 0 AS ord, 'src/F' || doc_id || '.scala' AS file, CAST(doc_id % 100 + 1 AS INTEGER) AS start, CAST(doc_id % 100 + CASE WHEN doc_id % 5 > 0 THEN doc_id % 4 ELSE 1 END AS INTEGER) AS \"end\" FROM documents WHERE doc_id % 5 = 0 OR doc_id % 4 > 0")
def diff_added_ranges(spark, at):
    return diffs.added_ranges(_diffs(spark, at).select("doc_id", "diff"), ["doc_id"])


@query(f"""SELECT 'commit-' || left(md5(CAST(doc_id AS VARCHAR)), 12) AS bug_key, source AS repo, 'src/F' || doc_id || '.scala' AS file_path, 'scala' AS language, code AS buggy_code, cut AS fix_diff, 'Fix: crash (#' || doc_id || ') PROJ-7' AS bug_summary, 'PROJ-7,PROJ-9' AS labels, CAST(0.7 AS DOUBLE) AS szz_confidence, CAST(doc_id AS INTEGER) AS pr_number, lang || ' proj-9' AS pr_body_excerpt
  FROM (SELECT *, array_to_string(list_transform(list_filter(string_split(cut, chr(10)), lambda l: starts_with(l, '-') AND NOT starts_with(l, '---')), lambda l: substr(l, 2)), chr(10)) AS code FROM (SELECT doc_id, source, lang, {_capped_sql("rtrim(body, chr(10))", 51200)} AS cut FROM {SHOWN} WHERE doc_id % 3 = 0)) WHERE regexp_matches(code, '[^ \\t\\n\\f\\r\\v]')""")
def commit_corpus(spark, at):
    n = F.col("doc_id")
    subject = F.when(n % 3 == 0, F.concat(F.lit("Fix: crash (#"), n, F.lit(") PROJ-7"))).otherwise("Add thing")
    commits = _diffs(spark, at).select(F.col("source").alias("repo"), F.md5(n.cast("string").cast("binary")).alias("sha"), subject.alias("subject"), F.concat("lang", F.lit(" proj-9")).alias("message"), F.lit("2024").alias("committed_at"), F.rtrim(F.col("diff"), F.lit("\n")).alias("diff"))
    return diffs.commit_corpus(commits).select("bug_key", "repo", "file_path", "language", "buggy_code", "fix_diff", "bug_summary", _joined(F.col("jira_labels")).alias("labels"), F.col("szz_confidence").cast("double").alias("szz_confidence"), "pr_number", "pr_body_excerpt")


@query(f"""SELECT 'PR-' || doc_id AS bug_key, source AS repo, 'src/F' || doc_id || '.scala' AS file_path, 'scala' AS language, removed AS buggy_code, rtrim(pulled, chr(10)) AS fix_diff, lang AS pr_body_excerpt FROM {SHOWN} WHERE doc_id % 2 = 0 AND regexp_matches(removed, '[^ \\t\\n\\f\\r\\v]') AND octet_length(encode(rtrim(pulled, chr(10)))) <= 51200""")
def pull_corpus(spark, at):
    n = F.col("doc_id")
    pulls = _diffs(spark, at).select(F.col("source").alias("repo"), n.cast("int").alias("number"), F.when(n % 2 == 0, "hotfix[x] y").otherwise("Add").alias("title"), F.col("lang").alias("message"), F.lit("u").alias("url"), F.rtrim(F.col("diff"), F.lit("\n")).alias("diff"))
    return diffs.pull_corpus(pulls).select("bug_key", "repo", "file_path", "language", "buggy_code", "fix_diff", "pr_body_excerpt")


# --- scanners: a text that each fires on and one that it doesn't ---

_ADAPTER = "class FooAdapter(client: BarGrpcClient) {\n  def get(id: String)(implicit c: CallScope): X = {\n    visibility.exposing(a) { CALL }\n  }\n}"
_STATUS = "extends StatusRuntimeException(responseStatus = ResponseStatus.NotFound)"
#: path, text, rule or None, severity, line, what the match begins with
FIXTURES = (
    ("backend/calendar-3/F.scala", "class Foo { f(DateTime.now()) }", "CalendarNowWithoutExplicitTimezone", "medium", 1, "DateTime.now"),
    ("backend/calendar-3/F.scala", "x.getOrElse(DateTime.now()).withZone(z)", None, None, None, None),
    ("a/S.scala", "staffMembersService.queryStaffMembers(id, f(x))", "StaffQueryMissingAppDefId", "high", 1, "staffMembersService"),
    ("a/S.scala", "staffMembersService.queryStaffMembers(appDefId = a)", None, None, None, None),
    ("a/O.scala", "val openSpots = capacity - participants", "UnclampedOpenSpots", "medium", 1, "val openSpots"),
    ("a/O.scala", "val openSpots = Math.max(capacity - participants, 0)", None, None, None, None),
    ("a/D.scala", 'val userId = 1\nlog(s"userId = $userId")\nlog(s"x = userId")', "MissingDollarInInterpolation", "low", 3, 's"x = userId'),
    ("a/D.scala", 'val other = 1\nlog(s"x = other")', None, None, None, None),
    ("a/B.scala", 'logger.info(\n s"form $form.id")', "BrokenInterpolationFieldAccess", "low", 2, "$form.id"),
    ("a/B.scala", 'val p = s"$dir.id"', None, None, None, None),
    ("a/E.scala", f"class A {_STATUS}", "StatusRuntimeExceptionForBusinessError", "medium", 1, "class A"),
    ("a/E.scala", f"class ASystemException {_STATUS}", None, None, None, None),
    ("a/I.scala", _ADAPTER.replace("CALL", "client.get(id)"), "MissingWithAdapterIdentity", "high", 2, "  def get"),
    ("a/I.scala", _ADAPTER.replace("CALL", "signer.withAdapterIdentity { client.get(id) }"), None, None, None, None),
)


def _sql(v) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"


FIXTURE_ROWS = ", ".join("(" + ", ".join(_sql(v) for v in (k, *f)) + ")" for k, f in enumerate(FIXTURES))


@query(f"""SELECT rule, severity, path || '/' || doc_id AS file, line, trim(replace(CASE WHEN rule LIKE 'Calendar%' THEN substr(text, greatest(1, p - 40), p - greatest(1, p - 40) + 80) ELSE substr(text, p, 200) END, chr(10), ' ')) AS snippet
  FROM (SELECT *, strpos(text, mark) AS p FROM (SELECT doc_id, path, body || chr(10) || '// ' || source || chr(10) AS text, rule, severity, line, mark FROM documents JOIN (VALUES {FIXTURE_ROWS}) f(k, path, body, rule, severity, line, mark) ON k = doc_id % {len(FIXTURES)} WHERE rule IS NOT NULL))""")
def emulators_scala(spark, at):
    n = F.col("doc_id")
    text = F.concat(_pick(n, *(f[1] for f in FIXTURES)), F.lit("\n// "), "source", F.lit("\n"))
    files = _docs(spark, at).select(F.concat(_pick(n, *(f[0] for f in FIXTURES)), F.lit("/"), n).alias("path"), text.alias("text"))
    return scanners.scan(files).drop("message")


@query(f"""SELECT rule, severity, doc_id AS file, CAST(line AS INTEGER) AS line, token FROM (SELECT 'Hinted' AS rule, 'low' AS severity, doc_id, line, unnest(regexp_extract_all(value, 'licen[sc]e')) AS token FROM {LINES}
  UNION ALL SELECT 'Worded', 'high', doc_id, line, unnest(regexp_extract_all(value, '\\b(?:License|Copyright)\\b')) FROM {LINES})""")
def generic_scanners(spark, at):
    rows = scanners.scan(_docs(spark, at).select(F.col("doc_id").cast("string").alias("path"), "text"), rules=(), extra=[("Hinted", "low", "licen[sc]e", []), ("Worded", "high", "(", ["the License and its Copyright", "low words"]), ("None", "low", None, ["no capitals"])])
    return rows.select("rule", "severity", F.col("file").cast("long").alias("file"), "line", F.regexp_extract("message", "`(.*)`", 1).alias("token"))


# --- rules, validation, clusters ---

ANCHOR_SQL = "list_distinct(regexp_extract_all(lower(text), '[a-z]{6,}'))[1:8]"


def _rule_sources(spark, at, which: str):
    words = F.slice(F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), 0))), 1, 8)
    source = F.concat(F.lit("/* c"), "doc_id", F.lit(" */ class C"), "doc_id", F.lit(' { Term.Name("'), F.array_join(words, '"); Term.Name("'), F.lit('"); x.endsWith("flatMap") }'))
    return _docs(spark, at).filter(which).filter(F.size(words) > 0).select(F.format_string("p%08d", "doc_id").alias("path"), F.concat(F.lit("C"), "doc_id").alias("class_name"), F.lit(None).cast("string").alias("diagnostic_id"), source.alias("text"), "doc_id")


@query("""WITH r AS (SELECT printf('p%08d', doc_id) AS path, 'C' || doc_id AS class_name, doc_id % 2 = 1 AS candidate, list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z]{6,}')))[1:8] AS items FROM documents WHERE len(regexp_extract_all(lower(text), '[a-z]{6,}')) > 0),
  s AS (SELECT *, list_filter(items, lambda w: NOT list_contains(['position', 'exists', 'collect', 'flatten', 'message', 'values', 'option', 'implicit', 'diagnostic'], w)) AS a FROM r),
  p AS (SELECT x.path, y.class_name AS other, len(list_intersect(x.a, y.a)) / (len(x.a) + len(y.a) - len(list_intersect(x.a, y.a))) AS j FROM s x JOIN s y ON x.path <> y.path WHERE x.candidate AND len(x.a) > 0 AND len(y.a) > 0),
  b AS (SELECT path, max(j) AS j, list(other ORDER BY j DESC, other) AS names FROM p WHERE j >= 0.6 GROUP BY path)
  SELECT s.path, CASE WHEN b.path IS NULL THEN 'DISTINCT' ELSE 'OVERLAP' END AS verdict, coalesce(array_to_string(names, ','), '') AS overlaps_with, coalesce(round(j, 3), 0.0) AS jaccard FROM s LEFT JOIN b ON b.path = s.path WHERE candidate""")
def rule_overlaps(spark, at):
    return quality.dedup_rules(_rule_sources(spark, at, "doc_id % 2 = 1"), _rule_sources(spark, at, "doc_id % 2 = 0")).select("path", "verdict", _joined(F.col("overlaps_with")).alias("overlaps_with"), "jaccard")


@query("""SELECT rule_id, target, CASE WHEN target = 'scalafix' THEN 1 - fp / 20 ELSE 1 - fp / greatest(n, 1) END AS precision, matched / greatest(t, 1) AS recall_in_cluster, clean AS false_positives_on_clean,
  CASE WHEN target = 'scalafix' THEN 1 - fp / 20 ELSE 1 - fp / greatest(n, 1) END >= 0.85 AND matched / greatest(t, 1) >= 0.5 AND (target <> 'scalafix' OR clean <= 20) AS ship
  FROM (SELECT source AS rule_id, CASE WHEN source < 'src5' THEN 'scalafix' ELSE 'opengrep' END AS target, count(*) AS t, count(*) FILTER (WHERE quality = 1) AS matched, count(*) FILTER (WHERE toxic = 1 AND documents.doc_id % 7 = 0) AS fp, count(*) FILTER (WHERE toxic = 1) AS clean, count(*) FILTER (WHERE documents.doc_id % 7 = 0) AS n FROM documents JOIN labels USING (doc_id) GROUP BY source)""")
def validated_rules(spark, at):
    d = _docs(spark, at).join(table(spark, "labels", at), "doc_id").withColumn("rule_id", F.col("source"))
    off = F.col("doc_id") % 7 == 0
    rules = d.groupBy("rule_id").agg(F.count("*").alias("n_tests")).withColumn("target", F.when(F.col("rule_id") < "src5", "scalafix").otherwise("opengrep"))
    hits = d.groupBy("rule_id").agg(F.count_if(F.col("quality") == 1).alias("matched"), F.count_if((F.col("toxic") == 1) & off).alias("fp"), F.count_if(F.col("toxic") == 1).alias("clean"))
    sampled = d.filter(off).groupBy("rule_id").agg(F.count("*").alias("n"))
    return batch.validated(rules, hits, sampled)


@query("""WITH d AS (SELECT l_orderkey, l_linenumber, 'f' || l_partkey % 50 || ['.scala', '.py', '.md'][l_partkey % 3 + 1] AS file, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1, 2, 3), good AS (SELECT s_suppkey FROM supplier WHERE s_nationkey <> 0 AND s_suppkey % 4 >= 2),
  known AS (SELECT * FROM d WHERE file NOT LIKE '%.md' AND l_suppkey IN (SELECT s_suppkey FROM good)), alone AS (SELECT l_orderkey, count(DISTINCT l_suppkey) = 1 AS one FROM known GROUP BY 1)
  SELECT l_orderkey AS fix_sha, l_linenumber AS start_line, file AS file_path, l_suppkey AS sha, CASE WHEN file LIKE '%.scala' THEN 'scala' ELSE 'python' END AS language, CAST(CASE WHEN one THEN 0.9 ELSE 0.7 END AS DOUBLE) AS szz_confidence FROM known JOIN alone USING (l_orderkey)""")
def blamed_lines(spark, at):
    one = table(spark, "lineitem", at).select(F.col("l_orderkey").alias("fix_sha"), F.col("l_linenumber").alias("line"), F.concat(F.lit("f"), F.col("l_partkey") % 50, _pick(F.col("l_partkey"), ".scala", ".py", ".md")).alias("file"), F.col("l_suppkey").alias("sha"))
    one = one.groupBy("fix_sha", "line", "file").agg(F.min("sha").alias("sha"))
    commits = table(spark, "supplier", at).select(F.col("s_suppkey").alias("sha"), F.col("s_nationkey").alias("n_files"), (F.col("s_suppkey") % 4).alias("insertions"), F.lit(0).alias("deletions"))
    deleted = one.select(F.lit("B").alias("bug_key"), "fix_sha", "file", "line", F.lit("x").alias("content"))
    return corpus.blamed(deleted, one, commits).select("fix_sha", "start_line", "file_path", "sha", "language", F.col("szz_confidence").cast("double").alias("szz_confidence"))


@query("SELECT source, lang, n, engine FROM (SELECT source, CASE lang WHEN 'de' THEN 'scala' WHEN 'en' THEN 'go' ELSE 'ruby' END AS lang, count(*) AS n, CASE lang WHEN 'de' THEN 'scalafix' WHEN 'en' THEN 'opengrep' ELSE 'any' END AS engine FROM documents GROUP BY ALL) WHERE n >= 2")
def engine_routes(spark, at):
    lang = F.when(F.col("lang") == "de", "scala").when(F.col("lang") == "en", "go").otherwise("ruby")
    return corpus.routed_clusters(_docs(spark, at).select("source", lang.alias("lang")), "source", "lang")


@query("SELECT vec_id AS id, round(list_aggregate(list_transform(v, lambda x: x * x), 'sum'), 6) AS length, round(v[1] * sqrt(s), 5) AS back FROM (SELECT vec_id, list_transform(e, lambda x: x / sqrt(s)) AS v, s FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, list_aggregate(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x), 'sum') AS s FROM embeddings))")
def unit_vectors(spark, at):
    e = table(spark, "embeddings", at).select(F.col("vec_id").alias("id"), "embedding", V.normalised(F.col("embedding")).alias("v"))
    return e.select("id", F.round(V.dot(F.col("v"), F.col("v")), 6).alias("length"), F.round(F.col("v")[0] * V.norm(F.col("embedding")), 5).alias("back"))


@query("""WITH l AS (SELECT source, doc_id, CASE WHEN doc_id % 4 = 0 THEN -1 ELSE CAST(doc_id % 3 AS INTEGER) END AS label FROM documents), g AS (SELECT source, dense_rank() OVER (ORDER BY source) - 1 AS o FROM l GROUP BY source HAVING count(*) >= 5)
  SELECT doc_id, CAST(CASE WHEN label < 0 THEN -1 ELSE label + o * 1000 END AS INTEGER) AS cluster_id FROM l LEFT JOIN g USING (source)""")
def cluster_numbers(spark, at):
    labels = _docs(spark, at).select("source", "doc_id", F.when(F.col("doc_id") % 4 == 0, -1).otherwise(F.col("doc_id") % 3).cast("int").alias("label"))
    return hdbscan.numbered(labels, ["source"]).select("doc_id", "cluster_id")


@query("""SELECT h.doc_id AS file, '# R (high)' || chr(10) || h.doc_id || ':1' || repeat(chr(10), 2) || 'ctx ' || lang || repeat(chr(10), 2) || left(text, 3000) || repeat(chr(10), 2) || 'l1' || chr(10) || 'l2' AS bundle FROM documents h""")
def review_bundles(spark, at):
    d = _docs(spark, at)
    f = d.select(F.col("doc_id").alias("file"), F.lit(1).alias("line"), F.lit("high").alias("severity"), F.concat(F.lit("R"), "doc_id").alias("rule"))
    ctx = d.select(F.col("doc_id").alias("file"), F.lit(1).alias("line"), F.concat(F.lit("ctx "), "lang").alias("context"))
    why = d.select(F.concat(F.lit("R"), "doc_id").alias("rule"), F.col("text").alias("rationale"), F.array(F.lit("l1"), F.lit("l2")).alias("links"))
    return quality.review_bundle(f, ctx, why).select("file", F.regexp_replace("bundle", r"^# R\d+", "# R").alias("bundle"))


@query("SELECT source, count(*) AS n, least(count(*), 2) AS kept FROM documents WHERE doc_id % 3 > 0 GROUP BY source")
def cleaned_entries(spark, at):
    d = _docs(spark, at).select(F.col("source").alias("bug_key"), F.format_string("%09d", "doc_id").alias("file_path"), F.when(F.col("doc_id") % 3 == 0, "Merge branch x").otherwise("crash").alias("bug_summary"))
    n = d.filter(~T.is_noise_summary(F.col("bug_summary"))).groupBy("bug_key").agg(F.count("*").alias("n"))
    return n.join(corpus.cleaned(d, 2, 7).groupBy("bug_key").agg(F.count("*").alias("kept")), "bug_key").select(F.col("bug_key").alias("source"), "n", "kept")


# --- upkeep ---


@query("SELECT strftime(day, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM (SELECT date_trunc('day', ts) AS day, event_type FROM events) WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY ALL")
def stream_windows(spark, at):
    counts = incremental.windowed_counts(incremental.table_stream(spark, at, "events").select("ts", "event_type"), "ts", "event_type")
    path = _scratch(spark, "windows")
    incremental.run_once(counts.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", F.col("count").alias("n")), path + "-state", path=path)
    return spark.read.schema("day string, event_type string, n long").parquet(path)


@query("SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id")
def stream_upserts(spark, at):
    path, schema = _scratch(spark, "upserts"), "user_id long, event_id long"
    stream = incremental.table_stream(spark, at, "events").select("user_id", "event_id")
    last = lambda df: df.groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    incremental.run_once(stream, path + "-state", each=lambda df, n: incremental.merged_into(path, last(df), n, schema, ["user_id"], lambda c, old, new: F.greatest(old, new)))
    return incremental.merged_rows(spark, path, schema).select("user_id", "event_id")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'")
def mined_since(spark, at):
    return incremental.since(table(spark, "events", at).select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at")), "at", "2024-01-20T00:00:00").select("event_id")


@query("SELECT vec_id FROM embeddings WHERE vec_id % 3 = 0")
def kept_for_batch(spark, at):
    e = table(spark, "embeddings", at)
    routes = e.select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 3 == 0, "batch").otherwise("wait").alias("route"))
    return incremental.kept_for_batch(routes, e, "vec_id").select("vec_id")


# --- declarative rules: a text that each fires on and one that it doesn't ---

#: ending of the path, text, rule or None, line, match
PATTERN_FIXTURES = (
    ("a.ts", "book({\n  id, startTime: new Date(), x })", "calendar-scheduled-time-without-explicit-timezone", 2, "startTime: new Date()"),
    ("a.spec.ts", "book({ startTime: new Date() })", None, None, None),
    ("b.ts", "const a = bookingSubmission.fields.name", "form-payload-direct-access-without-validation", 1, "bookingSubmission.fields.name"),
    ("b.ts", "if (validateForm(submission)) {\n  use(submission.fields.name)\n}\nother.fields.name", None, None, None),
    ("c.go", "for _, p := range paths {\n\tf, _ := os.Open(p)\n}", "go-defer-in-loop", 2, "f, _ := os.Open(p)"),
    ("c.go", "f, _ := os.Open(p)\nfor i := 0; i < 3; i++ {\n}", None, None, None),
    ("d.go", "var x int\nx, _ = parse(s, f(1))", "go-ignored-error", 2, "x, _ = parse(s, f(1))"),
    ("d.go", "x, err = parse(s)", None, None, None),
    ("e.py", "try:\n    f()\nexcept:\n    pass", "py-bare-except", 3, "except:"),
    ("e.py", "try:\n    f()\nexcept ValueError:\n    pass", None, None, None),
    ("f.py", "def f(a, b=[]):\n    b.append(a)", "py-mutable-default-arg", 1, "def f(a, b=[])"),
    ("f.py", "def f(a, b=None):\n    pass", None, None, None),
    ("g.ts", "const d = prices.sort()", "ts-array-sort-numbers-without-comparator", 1, "prices.sort()"),
    ("g.ts", "names.sort(); prices.sort((a, b) => a - b)", None, None, None),
    ("g.ts", "Array.from(new Set(xs)).sort()", "ts-array-sort-numbers-without-comparator", 1, "Array.from(new Set(xs)).sort()"),
    ("h.ts", "await this.staffApi.list({ id, q: { a: 1 } })", "ts-staff-query-missing-appdefid", 1, "staffApi.list({ id, q: { a: 1 } })"),
    ("h.ts", "staffApi.list({ id, appDefId: x }); membersRepository.list({})", None, None, None),
)
PATTERN_ROWS = ", ".join("(" + ", ".join(_sql(v) for v in (k, *f)) + ")" for k, f in enumerate(PATTERN_FIXTURES))


@query(f"""SELECT rule, CASE WHEN rule IN ('go-ignored-error', 'py-mutable-default-arg') THEN 'high' ELSE 'medium' END AS severity, CASE WHEN rule LIKE 'go-%' OR rule LIKE 'py-%' THEN 'correctness' ELSE 'uncategorized' END AS category, doc_id || '/' || path AS file, line, snippet
  FROM documents JOIN (VALUES {PATTERN_ROWS}) f(k, path, body, rule, line, snippet) ON k = doc_id % {len(PATTERN_FIXTURES)} WHERE rule IS NOT NULL""")
def declarative_rules(spark, at):
    from .operators import patterns

    n = F.col("doc_id")
    files = _docs(spark, at).select(F.concat(n, F.lit("/"), _pick(n, *(f[0] for f in PATTERN_FIXTURES))).alias("path"), F.concat(_pick(n, *(f[1] for f in PATTERN_FIXTURES)), F.lit("\n# "), "source").alias("text"))
    return patterns.pattern_findings(files).drop("message")


@query("""SELECT lang, count(*) FILTER (WHERE label >= 0) AS n_clusters, count(*) FILTER (WHERE label >= 0 AND c >= 5) AS n_surviving, count(*) FILTER (WHERE label >= 0 AND c < 5) AS n_dropped, CAST(coalesce(sum(n) FILTER (WHERE label = -1), 0) AS BIGINT) AS n_noise
  FROM (SELECT lang, label, count(*) AS n, count(DISTINCT k) AS c FROM (SELECT 'l' || vec_id % 3 AS lang, CASE WHEN vec_id % 4 = 0 THEN -1 ELSE label END AS label, vec_id % (label + 2) AS k FROM embeddings) GROUP BY ALL) GROUP BY lang""")
def cluster_summary(spark, at):
    n = F.col("vec_id")
    e = table(spark, "embeddings", at).select(F.concat(F.lit("l"), n % 3).alias("lang"), F.when(n % 4 == 0, -1).otherwise(F.col("label")).alias("label"), (n % (F.col("label") + 2)).alias("k"))
    return report.cluster_summary(e, "lang", "label", "k", 5)
