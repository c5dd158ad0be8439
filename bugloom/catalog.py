"""Queries over the star-schema tables, each with the SQL that gives the same rows where SQL can.

Roles: customer bugs, orders fixes, lineitem code blocks, documents source files and summaries (source: repository, lang:
language), labels truth, embeddings entry vectors, events a stream of findings, pages web sources.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .functions import vectors as V
from .operators import corpus, hdbscan, quality, relational, report, rules, vectorise
from .session import shared_folder, table
from .sources import readers
from .streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


LINES = "(SELECT doc_id, source, lang, i AS line, string_split(text, chr(10))[i] AS value FROM (SELECT *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents))"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


RULE_ROWS = ", ".join(f"({_quoted(r.name)}, {_quoted(r.severity)}, {_quoted(r.pattern)}, {_quoted(r.not_pattern) if r.not_pattern else 'NULL'})" for r in rules.CATALOGUE)
RULES_SQL = f"(SELECT * FROM (VALUES {RULE_ROWS}) AS t(rule, severity, pattern, not_pattern))"
HITS = f"""(SELECT rule, severity, doc_id AS file, CAST(line AS INTEGER) AS line, left(trim(value, ' '), 200) AS snippet FROM {LINES} l, {RULES_SQL} r
  WHERE regexp_matches(lower(value), pattern) AND (not_pattern IS NULL OR NOT regexp_matches(lower(value), not_pattern)))"""


def _files(spark: SparkSession, at: str) -> DataFrame:
    return table(spark, "documents", at).select(F.col("doc_id").alias("file"), "text")


@query(f"SELECT * FROM {HITS}")
def scan_findings(spark, at):
    return rules.line_findings(_files(spark, at)).orderBy("rule", "file", "line")


@query(f"SELECT rule, r.severity, CAST(coalesce(n, 0) AS BIGINT) AS n FROM {RULES_SQL} r LEFT JOIN (SELECT rule, count(*) AS n FROM {HITS} GROUP BY rule) USING (rule)")
def scan_summary(spark, at):
    return rules.summary(rules.line_findings(_files(spark, at)), rules.rule_table(spark))


@query(f"SELECT rule, severity, CAST(count(*) AS BIGINT) AS n FROM {HITS} GROUP BY GROUPING SETS ((rule), (severity), ())")
def scan_summary_sets(spark, at):
    return rules.summary_sets(rules.line_findings(_files(spark, at)))


@query(f"SELECT * FROM {HITS} WHERE severity IN ('high', 'medium')")
def scan_severity_filtered(spark, at):
    return rules.line_findings(_files(spark, at)).filter(T.at_least(F.col("severity"), "medium")).orderBy(T.severity_rank(F.col("severity")), "file", "line")


@query("""SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'security|identity leak|data loss|auth|credential|escalat') THEN 'high'
  WHEN regexp_matches(lower(text), 'stylistic|lint-only|cosmetic|style nit') THEN 'low' ELSE 'medium' END AS severity FROM documents""")
def severity_from_text(spark, at):
    return table(spark, "documents", at).select("doc_id", T.severity_of(F.col("text")).alias("severity"))


@query(f"""SELECT doc_id, line FROM (SELECT doc_id, CAST(line AS INTEGER) AS line, value, concat_ws(chr(10), lag(value, 2) OVER w, lag(value, 1) OVER w, value) AS near FROM {LINES} WINDOW w AS (PARTITION BY doc_id ORDER BY line))
  WHERE regexp_matches(lower(value), '[0-9]{{4,}}') AND regexp_matches(lower(near), 'licen[sc]e|token|@')""")
def context_guarded_hits(spark, at):
    lines = rules.lines_of(table(spark, "documents", at).select("doc_id", "text"))
    return rules.guarded(lines, "doc_id", "[0-9]{4,}", "licen[sc]e|token|@").select("doc_id", "line")


@query("SELECT page_id, url FROM pages WHERE (regexp_matches(html, '<b>') OR regexp_matches(html, 'token')) AND NOT regexp_matches(html, 'track\\([0-9]{3,}\\)')")
def pages_pattern_either_not(spark, at):
    return rules.either_not(table(spark, "pages", at), "html", ["<b>", "token"], [r"track\([0-9]{3,}\)"]).select("page_id", "url")


@query("""SELECT page_id, href, CAST(pos AS BIGINT) AS pos FROM (SELECT page_id, hrefs[i] AS href, min(i) AS pos FROM (SELECT page_id, hrefs, unnest(range(1, len(hrefs) + 1)) AS i FROM
  (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs FROM pages)) GROUP BY ALL)""")
def links_extract_dedup(spark, at):
    links = table(spark, "pages", at).select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("pos", "href"))
    return relational.first_of(links.select("page_id", "href", (F.col("pos") + 1).cast("long").alias("pos")), ["page_id", "href"], "pos")


@query("SELECT page_id, url FROM (SELECT *, regexp_replace(url, '^[a-z]+://', '') AS path FROM pages) WHERE regexp_matches(path, '^.*/(en|de)/[^/]*$') AND NOT regexp_matches(path, '\\.html$') AND NOT regexp_matches(path, '/build/')")
def file_enumeration(spark, at):
    pages = table(spark, "pages", at).withColumn("path", F.regexp_replace("url", "^[a-z]+://", ""))
    return readers.chosen_files(pages, ["**/en/*", "**/de/*"], ["**/*.html", "*.html"]).select("page_id", "url")


@query("""WITH bug AS (SELECT c_custkey AS k, c_name, c_mktsegment FROM customer), fix AS (SELECT o_custkey AS k, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS fix_key FROM orders GROUP BY 1),
  inducing AS (SELECT o_orderkey, o_custkey AS k, o_orderpriority FROM orders)
  SELECT CAST(i.k AS VARCHAR) AS bug_key, o_orderpriority AS repo, 'part' || CAST(l_partkey AS VARCHAR) AS file_path, l_linestatus AS language, l_returnflag AS buggy_code, CAST(fix_key AS VARCHAR) AS fix_diff, c_name AS bug_summary, CAST(count(*) AS BIGINT) AS n
  FROM inducing i JOIN bug USING (k) JOIN fix USING (k) JOIN lineitem ON l_orderkey = i.o_orderkey GROUP BY ALL""")
def corpus_build_join(spark, at):
    block = F.struct(F.concat(F.lit("part"), F.col("l_partkey").cast("string")).alias("file_path"), F.col("l_linestatus").alias("language"), F.col("l_returnflag").alias("content"))
    lines, orders = table(spark, "lineitem", at), table(spark, "orders", at)
    blocks = lines.groupBy("l_orderkey").agg(F.collect_list(block).alias("blocks"))
    inducing = orders.join(blocks, orders.o_orderkey == blocks.l_orderkey).select(F.col("o_custkey").cast("string").alias("bug_key"), F.col("o_orderpriority").alias("repo"), "blocks", F.lit(0.7).alias("szz_confidence"))
    bugs = table(spark, "customer", at).select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("summary"), F.array("c_mktsegment").alias("labels"), F.col("c_custkey").alias("ord"))
    fixes = orders.select(F.col("o_custkey").cast("string").alias("bug_key"), F.col("o_orderkey").cast("string").alias("diff"), F.lit(0).alias("lines_removed"), F.struct("o_orderdate", "o_orderkey").alias("ord"))
    return relational.counted(corpus.build(inducing, bugs, fixes), ["bug_key", "repo", "file_path", "language", "buggy_code", "fix_diff", "bug_summary"], lines.count())


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def fix_with_blocks_semi(spark, at):
    return table(spark, "orders", at).select("o_orderkey").join(table(spark, "lineitem", at).select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def fix_without_blocks_anti(spark, at):
    return table(spark, "orders", at).select("o_orderkey").join(table(spark, "lineitem", at).select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("SELECT o_orderkey, coalesce(c_name, '') AS bug_summary FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey")
def left_lookup_default(spark, at):
    bugs = table(spark, "customer", at).filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return table(spark, "orders", at).join(bugs, "o_custkey", "left").select("o_orderkey", F.coalesce("c_name", F.lit("")).alias("bug_summary"))


@query("""WITH a AS (SELECT o_custkey AS bug, o_orderkey AS link FROM orders WHERE o_totalprice > 400000),
  b AS (SELECT o_custkey AS bug, o_orderkey AS link, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS n FROM orders WHERE o_custkey NOT IN (SELECT bug FROM a))
  SELECT bug, link FROM a UNION ALL SELECT bug, link FROM b WHERE n <= 2""")
def primary_fallback_links(spark, at):
    orders = table(spark, "orders", at).select(F.col("o_custkey").alias("bug"), F.col("o_orderkey").alias("link"), "o_orderpriority", "o_totalprice")
    return relational.with_fallback(orders.filter("o_totalprice > 400000"), orders, ["bug"], 2, ["bug", "o_orderpriority"], F.col("link")).select("bug", "link")


@query("""WITH o AS (SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id % 3 <> 0), n AS (SELECT doc_id, upper(lang) AS lang, 'new' AS source, n_chars + 1 AS n_chars FROM documents WHERE doc_id % 2 = 0 AND lang <> 'de')
  SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, CASE WHEN n.doc_id IS NOT NULL THEN n.lang ELSE o.lang END AS lang, coalesce(o.source, n.source) AS source, CASE WHEN n.doc_id IS NOT NULL THEN n.n_chars ELSE o.n_chars END AS n_chars FROM o FULL JOIN n ON o.doc_id = n.doc_id""")
def upsert_partial_columns(spark, at):
    d = table(spark, "documents", at).select("doc_id", "lang", "source", "n_chars")
    new = d.filter("doc_id % 2 = 0").select("doc_id", F.when(F.col("lang") != "de", F.upper("lang")).alias("lang"), F.lit("new").alias("source"), (F.col("n_chars") + 1).alias("n_chars"))
    return relational.upsert(d.filter("doc_id % 3 <> 0"), new, ["doc_id"], ["lang", "n_chars"], ["lang"])


@query("""WITH o AS (SELECT doc_id, source FROM documents WHERE doc_id % 3 = 0), n AS (SELECT doc_id, 'again' AS source FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 2 = 0)
  SELECT * FROM o UNION ALL SELECT * FROM n WHERE doc_id NOT IN (SELECT doc_id FROM o)""")
def append_idempotent(spark, at):
    d = table(spark, "documents", at).select("doc_id", "source")
    new = d.filter("doc_id % 3 <> 0 OR doc_id % 2 = 0").withColumn("source", F.lit("again"))
    once = relational.append_new(d.filter("doc_id % 3 = 0"), new, ["doc_id"], "source")
    return relational.append_new(once, new, ["doc_id"], "source")


PATH_SQL = "(SELECT page_id, regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '') AS path FROM pages)"


def _paths(spark, at):
    return table(spark, "pages", at).select("page_id", F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", "").alias("path"))


@query(f"""SELECT page_id, CASE WHEN ext = 'scala' THEN 'scala' WHEN ext IN ('ts', 'tsx') THEN 'typescript' WHEN ext IN ('js', 'jsx') THEN 'javascript' WHEN ext = 'py' THEN 'python' WHEN ext = 'go' THEN 'go' ELSE 'other' END AS blamed,
  CASE WHEN ext = 'scala' THEN 'scala' WHEN ext IN ('ts', 'tsx') THEN 'typescript' WHEN ext IN ('js', 'jsx') THEN 'javascript' END AS mined FROM (SELECT page_id, regexp_extract(path, '\\.([A-Za-z0-9]+)$', 1) AS ext FROM {PATH_SQL})""")
def lang_from_path(spark, at):
    return _paths(spark, at).select("page_id", T.language(F.col("path"), blamed=True).alias("blamed"), T.language(F.col("path")).alias("mined"))


@query(f"SELECT page_id, string_split(path, '/')[-1] AS base, array_to_string(string_split(path, '/')[1:3], '/') AS dir, string_split(path, '/')[1] AS top FROM {PATH_SQL}")
def dir_parts(spark, at):
    p = F.col("path")
    return _paths(spark, at).select("page_id", T.basename(p).alias("base"), T.directory(p).alias("dir"), T.top_directory(p).alias("top"))


@query("""SELECT doc_id, CASE WHEN length(text) > 200 THEN left(text, 197) || '...' ELSE text END AS title, left(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), 500) AS excerpt FROM documents""")
def title_truncate_excerpt(spark, at):
    return table(spark, "documents", at).select("doc_id", T.truncated_title(F.col("text")).alias("title"), T.excerpt(F.col("text")).alias("excerpt"))


@query("SELECT doc_id, strlen(text) AS n_bytes FROM documents WHERE strlen(text) <= 5000")
def byte_cap(spark, at):
    return table(spark, "documents", at).select("doc_id", T.byte_length(F.col("text")).cast("long").alias("n_bytes")).filter("n_bytes <= 5000")


@query("SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL")
def first_wins(spark, at):
    return relational.first_of(table(spark, "events", at), ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id")


@query("SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL")
def last_wins(spark, at):
    return relational.last_of(table(spark, "events", at), ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id")


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5('13|' || doc_id), doc_id) AS n FROM documents) WHERE n <= 2")
def per_commit_cap_hash(spark, at):
    return relational.sampled_n(table(spark, "documents", at).select("source", "doc_id"), ["source"], 2, 13, F.col("doc_id"))


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents) WHERE n <= 300 OR i % (n // 300 + 1) = 0")
def stride_sample(spark, at):
    return relational.stride(table(spark, "documents", at).select("doc_id"), 300, F.col("doc_id"))


@query("SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) WHERE n <= 3")
def first_n_per_group(spark, at):
    return relational.first_n(table(spark, "conversations", at), ["conv_id"], 3, F.col("turn")).select("conv_id", "turn", "role")


@query("SELECT event_id FROM (SELECT event_id FROM events ORDER BY md5('7|' || event_id), event_id LIMIT 20) UNION SELECT event_id FROM (SELECT event_id FROM events ORDER BY md5('x|' || event_id), event_id LIMIT 20)")
def multiseed_union(spark, at):
    return relational.sampled_seeds(table(spark, "events", at).select("event_id"), 20, ["7", "x"], F.col("event_id"))


@query("SELECT source, lang, n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, f) AS k FROM (SELECT source, lang, count(*) AS n, min(doc_id) AS f FROM documents GROUP BY source, lang)) WHERE k = 1")
def dominant_language(spark, at):
    return report.dominant(table(spark, "documents", at), "source", "lang", "doc_id")


@query("SELECT event_type, user_id, n FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, f) AS k FROM (SELECT event_type, user_id, count(*) AS n, min(event_id) AS f FROM events GROUP BY event_type, user_id)) WHERE k <= 5")
def top_files_most_common(spark, at):
    return relational.most_common(table(spark, "events", at), ["event_type"], "user_id", 5, "event_id")


LANGS = ("de", "en", "es", "fr")


@query("SELECT source, " + ", ".join(f"count(*) FILTER (WHERE lang = '{k}') AS {k}" for k in LANGS) + ", count(*) AS total FROM documents WHERE lang IN ('de', 'en', 'es', 'fr') GROUP BY source")
def coverage_matrix(spark, at):
    return report.coverage(table(spark, "documents", at).filter(F.col("lang").isin(*LANGS)), "source", "lang", list(LANGS))


@query("SELECT left(CAST(o_orderdate AS VARCHAR), 7) AS month, count(*) AS n FROM orders GROUP BY ALL")
def monthly_series(spark, at):
    return report.monthly(table(spark, "orders", at), "o_orderdate")


@query("SELECT CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day FROM orders")
def date_range(spark, at):
    return report.date_range(table(spark, "orders", at), "o_orderdate")


@query("SELECT max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) AS by_text, max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) AS by_time FROM events")
def high_watermark(spark, at):
    return report.high_watermark(table(spark, "events", at).select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("s")), "s")


@query("SELECT count(DISTINCT l_orderkey) AS n_l_orderkey, count(DISTINCT l_partkey) AS n_l_partkey, count(DISTINCT l_suppkey) AS n_l_suppkey, count(DISTINCT nullif(l_returnflag, '')) AS n_l_returnflag FROM lineitem")
def distinct_cards(spark, at):
    return report.cards(table(spark, "lineitem", at), "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")


@query("SELECT lang, count(*) AS size, count(DISTINCT source) AS n_commits FROM documents JOIN labels USING (doc_id) GROUP BY lang HAVING count(DISTINCT source) >= 3")
def cluster_profile(spark, at):
    return report.cluster_profile(table(spark, "documents", at).join(table(spark, "labels", at), "doc_id"), "lang", "source", 3)


@query("SELECT lang, size FROM (SELECT lang, count(*) AS size FROM documents GROUP BY lang) ORDER BY size DESC, lang LIMIT 2")
def top_clusters(spark, at):
    return report.top_clusters(report.cluster_profile(table(spark, "documents", at), "lang", "source", 1), 2, "lang").select("lang", "size")


@query("WITH s AS (SELECT count(*) AS n FROM embeddings WHERE label >= 0 GROUP BY label) SELECT min(n) AS least, list_sort(list(n))[len(list(n)) // 2 + 1] AS middle, max(n) AS greatest FROM s")
def cluster_size_distribution(spark, at):
    return report.size_distribution(table(spark, "embeddings", at), "label")


@query("SELECT count(*) FILTER (WHERE l = -1) AS noise, count(*) AS n, count(*) FILTER (WHERE l = -1) / count(*) AS rate FROM (SELECT CASE WHEN label % 4 = 0 THEN -1 ELSE label END AS l FROM embeddings)")
def noise_rate(spark, at):
    return report.noise_rate(table(spark, "embeddings", at).select(F.when(F.col("label") % 4 == 0, -1).otherwise(F.col("label")).alias("l")), "l")


@query("""SELECT lang, CAST(sum(n) AS BIGINT) AS n_raw, CAST(sum(k) AS BIGINT) AS n_filtered, CAST(sum(least(k, 20)) AS BIGINT) AS n_capped FROM
  (SELECT lang, source, count(*) AS n, count(*) FILTER (WHERE NOT regexp_matches(lower(text), 'licen[sc]e')) AS k FROM documents GROUP BY lang, source) GROUP BY lang""")
def pipeline_summary_per_language(spark, at):
    return report.language_summary(table(spark, "documents", at), "lang", F.lower("text").rlike("licen[sc]e"), 20, "source")


@query("SELECT label, i AS place, round(x, 5) AS mean, n AS size FROM (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x, count(*) AS n FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY label, i)")
def centroids(spark, at):
    c = vectorise.centroids(table(spark, "embeddings", at), "label", "embedding")
    return c.select("label", "size", F.posexplode("centroid").alias("pos", "x")).select("label", (F.col("pos") + 1).cast("long").alias("place"), F.round("x", 5).alias("mean"), "size")


CENTROIDS_SQL = "(SELECT label AS k, list(x ORDER BY i) AS c FROM (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY label, i) GROUP BY label)"


def _vectors(spark, at):
    return table(spark, "embeddings", at).select(F.col("vec_id").alias("id"), V.doubles(F.col("embedding")).alias("vector"))


@query(f"SELECT id, CASE WHEN cos >= 0.3 THEN k END AS label, round(cos, 6) AS cos FROM (SELECT vec_id AS id, k, list_cosine_similarity(CAST(embedding AS DOUBLE[]), c) AS cos, row_number() OVER (PARTITION BY vec_id ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), c) DESC, k) AS n FROM embeddings, {CENTROIDS_SQL}) WHERE n = 1")
def nearest_centroid(spark, at):
    cents = vectorise.centroids(table(spark, "embeddings", at), "label", "embedding")
    return vectorise.nearest(_vectors(spark, at), cents, "label", 0.3).withColumn("cos", F.round("cos", 6))


@query("SELECT query, id, cos, rank FROM (SELECT q.vec_id AS query, v.vec_id AS id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 6) AS cos, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])) DESC, v.vec_id) AS rank FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id) WHERE rank <= 5")
def knn_cosine(spark, at):
    v = _vectors(spark, at)
    return vectorise.knn(v.filter("id % 50 = 0"), v, 5).select("query", "id", F.round("cos", 6).alias("cos"), F.col("rank").cast("long").alias("rank"))


@query("""WITH tok AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '([a-z_][a-z0-9_]+|[+\\-=!<>]+)', 1)) AS term FROM documents), tf AS (SELECT id, term, count(*) AS tf FROM tok GROUP BY ALL),
  vocab AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY term HAVING count(*) >= 2 ORDER BY total DESC, term LIMIT 200),
  w AS (SELECT id, term, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w FROM tf JOIN vocab USING (term)), n AS (SELECT id, sqrt(sum(w * w)) AS n FROM w GROUP BY id)
  SELECT term, round(sum(w / n), 4) AS weight, count(*) AS n FROM w JOIN n USING (id) GROUP BY term""")
def tfidf_terms(spark, at):
    docs = table(spark, "documents", at).select(F.col("doc_id").alias("id"), "text")
    rows = vectorise.tfidf(docs, F.regexp_extract_all(F.lower("text"), F.lit(r"([a-z_][a-z0-9_]+|[+\-=!<>]+)"), 1), 200, 2)
    return rows.groupBy("term").agg(F.round(F.sum("weight"), 4).alias("weight"), F.count("*").alias("n"))


#: Written out, so that the SQL doesn't ask the code under test.
STOP_SQL = """string_split('myself our ours ourselves you your yours yourself yourselves him his himself she her hers herself its itself they them their theirs themselves what which who whom this that these those are was were been being have has had having does did doing the and but because until while for with about against between into through during before after above below from down out off over under again further then once here there when where why how all any both each few more most other some such nor not only own same than too very can will just don should now cannot could ought would', ' ')"""


def _tokens_sql(text: str) -> str:
    return f"list_filter(list_distinct(regexp_extract_all(lower({text}), '[a-z]+')), lambda t: length(t) >= 3 AND NOT list_contains({STOP_SQL}, t))"


FIRST_LINE = "string_split(text, chr(10))[1]"


@query(f"SELECT token, count(*) AS n FROM (SELECT unnest({_tokens_sql('s')}) AS token FROM (SELECT DISTINCT {FIRST_LINE} AS s FROM documents)) GROUP BY token")
def doc_frequency_tokens(spark, at):
    s = table(spark, "documents", at).select(F.split("text", "\n", -1)[0].alias("s")).distinct()
    return s.select(F.explode(T.tokens(F.col("s"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


@query(f"""WITH s AS (SELECT DISTINCT source AS repo, {FIRST_LINE} AS s FROM documents WHERE source IN ('src0', 'src1') AND {FIRST_LINE} <> ''), total AS (SELECT repo, count(*) AS total FROM s GROUP BY repo),
  c AS (SELECT repo, token, count(*) AS n FROM (SELECT repo, unnest({_tokens_sql('s')}) AS token FROM s) GROUP BY ALL),
  sides AS (SELECT token, max(CASE WHEN repo = 'src0' THEN n ELSE 0 END) AS n_a, max(CASE WHEN repo = 'src1' THEN n ELSE 0 END) AS n_b, bool_or(n > 0.3 * total) AS generic FROM c JOIN total USING (repo) GROUP BY token)
  SELECT token, n_a, n_b, row_number() OVER (ORDER BY n_a + n_b DESC, least(n_a, n_b) DESC, token) AS rank FROM sides WHERE NOT generic AND greatest(n_a, n_b) >= 3 AND least(n_a, n_b) >= 1 AND token NOT IN ({', '.join(_quoted(w) for w in T.NON_DOMAIN)})""")
def cross_repo_patterns(spark, at):
    s = table(spark, "documents", at).select(F.col("source").alias("repo"), F.split("text", "\n", -1)[0].alias("summary"))
    return report.cross_patterns(s, "src0", "src1", 3, 1)


SET_SQL = "list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}'))"


def _sets(spark, at, name, key):
    return table(spark, name, at).select(F.col(key).alias("id"), F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), 0)).alias("items")).filter(F.size("items") > 0)


@query(f"""SELECT d AS doc_id, b AS item_id, round(j, 4) AS jaccard FROM (SELECT d.doc_id AS d, b.item_id AS b, len(list_intersect(d.s, b.s)) / (len(d.s) + len(b.s) - len(list_intersect(d.s, b.s))) AS j
  FROM (SELECT doc_id, {SET_SQL} AS s FROM documents) d, (SELECT item_id, {SET_SQL} AS s FROM benchmark) b WHERE len(d.s) > 0 AND len(b.s) > 0) WHERE j >= 0.3""")
def jaccard_overlap_pairs(spark, at):
    rows = relational.similar_sets(_sets(spark, at, "documents", "doc_id"), _sets(spark, at, "benchmark", "item_id"), 0.3)
    return rows.select(F.col("left_id").alias("doc_id"), F.col("right_id").alias("item_id"), F.round("jaccard", 4).alias("jaccard"))


@query("""WITH f AS (SELECT doc_id, left(sha1(regexp_replace(regexp_replace(regexp_replace(text, '/\\*(.|\\n)*?\\*/', '', 'g'), '//[^\\n]*', '', 'g'), '\\s+', '', 'g')), 16) AS fingerprint FROM documents),
  o AS (SELECT fingerprint, min(doc_id) AS original FROM f WHERE doc_id % 2 = 0 GROUP BY fingerprint)
  SELECT doc_id, f.fingerprint, CASE WHEN original IS NOT NULL THEN 'EXACT' ELSE 'DISTINCT' END AS verdict, original FROM f LEFT JOIN o USING (fingerprint) WHERE doc_id % 2 = 1""")
def fingerprint_dedup(spark, at):
    f = table(spark, "documents", at).select("doc_id", T.fingerprint(F.col("text")).alias("fingerprint"))
    old = f.filter("doc_id % 2 = 0").groupBy("fingerprint").agg(F.min("doc_id").alias("original"))
    return f.filter("doc_id % 2 = 1").join(old, "fingerprint", "left").select("doc_id", "fingerprint", F.when(F.col("original").isNotNull(), "EXACT").otherwise("DISTINCT").alias("verdict"), "original")


@query(f"""WITH c AS (SELECT rule, count(*) FILTER (WHERE quality = 1) AS tp, count(*) FILTER (WHERE quality <> 1) AS fp FROM {HITS} h JOIN labels l ON l.doc_id = h.file GROUP BY rule)
  SELECT rule, CAST(coalesce(tp, 0) AS BIGINT) AS tp, CAST(coalesce(fp, 0) AS BIGINT) AS fp, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, coalesce(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END >= 0.75, false) AS passed FROM {RULES_SQL} LEFT JOIN c USING (rule)""")
def precision_gate(spark, at):
    hits = rules.line_findings(_files(spark, at)).join(table(spark, "labels", at).withColumnRenamed("doc_id", "file"), "file").select("rule", (F.col("quality") == 1).alias("positive"))
    return quality.precision_gate(hits, rules.rule_table(spark))


@query("""WITH v AS (SELECT source AS rule_id, CASE WHEN source < 'src5' THEN 'scalafix' ELSE 'opengrep' END AS target, avg(quality) AS precision, 1 - avg(toxic) AS recall_in_cluster, CAST(sum(toxic) AS BIGINT) AS false_positives_on_clean FROM documents JOIN labels USING (doc_id) GROUP BY source)
  SELECT rule_id, target, round(precision, 6) AS precision, precision >= 0.85 AND recall_in_cluster >= 0.5 AND (target <> 'scalafix' OR false_positives_on_clean <= 20) AS ship FROM v""")
def validation_ship_gate(spark, at):
    rows = table(spark, "documents", at).join(table(spark, "labels", at), "doc_id").groupBy(F.col("source").alias("rule_id")).agg(F.avg("quality").alias("precision"), (1 - F.avg("toxic")).alias("recall_in_cluster"), F.sum("toxic").alias("false_positives_on_clean"))
    rows = rows.withColumn("target", F.when(F.col("rule_id") < "src5", "scalafix").otherwise("opengrep"))
    return quality.ship_gate(rows).select("rule_id", "target", F.round("precision", 6).alias("precision"), "ship")


@query("""SELECT rule_id, CAST(cluster AS INTEGER) AS cluster, vec_id FROM (SELECT r.label AS rule_id, r.label AS cluster, vec_id, row_number() OVER (PARTITION BY r.label ORDER BY vec_id) AS n FROM embeddings e, (SELECT DISTINCT label FROM embeddings) r WHERE e.label <> r.label) WHERE n <= 20""")
def off_cluster_sample(spark, at):
    e = table(spark, "embeddings", at).select("vec_id", F.col("label").alias("cluster_id"), F.lit("any").alias("language"), F.col("vec_id").alias("ord"))
    r = e.select(F.col("cluster_id").alias("rule_id"), "cluster_id", "language").distinct()
    return quality.off_cluster(e, r).select("rule_id", F.col("rule_id").alias("cluster"), "vec_id")


@query("""WITH f AS (SELECT l_orderkey % 1000 AS file, l_partkey % 500 AS line, count(*) AS n FROM lineitem GROUP BY ALL), r AS (SELECT o_orderkey % 1000 AS file, o_custkey % 500 AS s, o_custkey % 500 + o_orderkey % 7 AS e FROM orders)
  SELECT file, line, n, EXISTS (SELECT 1 FROM r WHERE r.file = f.file AND f.line BETWEEN s AND e) AS in_diff FROM f""")
def diff_ranges_in_diff(spark, at):
    f = table(spark, "lineitem", at).groupBy((F.col("l_orderkey") % 1000).alias("file"), (F.col("l_partkey") % 500).alias("line")).agg(F.count("*").alias("n"))
    r = table(spark, "orders", at).select((F.col("o_orderkey") % 1000).alias("file"), (F.col("o_custkey") % 500).alias("start"), (F.col("o_custkey") % 500 + F.col("o_orderkey") % 7).alias("end"))
    return relational.in_ranges(f, r).select("file", "line", "n", "in_diff").orderBy(F.desc("in_diff"), "file", "line")


@query("""SELECT page_id, CASE WHEN regexp_matches(lower(url), 'test|spec|mock|stub|testkit|fixture|__tests__') THEN 'FP: test path' WHEN regexp_matches(html, '^\\s*(//|/\\*|\\*)') THEN 'FP: comment'
  WHEN contains(html, 'TODO') OR contains(html, 'FIXME') THEN 'AMBIG: known' WHEN contains(html, 'token') THEN 'AMBIG: likely' ELSE 'AMBIG: none' END AS verdict FROM pages""")
def heuristic_verdict(spark, at):
    return table(spark, "pages", at).select("page_id", quality.verdict(F.col("url"), F.col("html"), F.col("html"), F.when(F.col("html").contains("token"), "high").otherwise("medium")).alias("verdict"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_findings_flatten(spark, at):
    return table(spark, "events", at).select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT DISTINCT user_id FROM events WHERE event_type = (SELECT min(event_type) FROM events) EXCEPT SELECT user_id FROM events WHERE event_id % 100 = 0")
def generic_subtract(spark, at):
    e = table(spark, "events", at)
    low = e.agg(F.min("event_type").alias("event_type"))
    return e.join(low, "event_type", "left_semi").select("user_id").distinct().join(e.filter("event_id % 100 = 0").select("user_id"), "user_id", "left_anti")


@query(f"""SELECT h.doc_id, CAST(h.line AS INTEGER) AS line, string_agg(CASE WHEN n.line = h.line THEN '>>' ELSE '  ' END || ' ' || lpad(CAST(n.line AS VARCHAR), 5, ' ') || '  ' || n.value, chr(10) ORDER BY n.line) AS context
  FROM {LINES} h JOIN {LINES} n ON n.doc_id = h.doc_id AND n.line BETWEEN h.line - 2 AND h.line + 2 WHERE regexp_matches(lower(h.value), 'licen[sc]e') GROUP BY ALL""")
def line_context_window(spark, at):
    lines = rules.lines_of(table(spark, "documents", at).select("doc_id", "text"))
    return rules.context_window(lines, "doc_id", F.lower("value").rlike("licen[sc]e"), 2)


@query("SELECT CASE WHEN year(o_orderdate) <= 2018 THEN '2014-2018' WHEN year(o_orderdate) <= 2022 THEN '2019-2022' ELSE '2023-2026' END AS era, count(*) AS n FROM orders GROUP BY ALL")
def era_buckets(spark, at):
    return table(spark, "orders", at).groupBy(T.era(F.lit(None).cast("string"), F.col("o_orderdate").cast("string")).alias("era")).agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CAST(length(left(text, p - 1)) - length(replace(left(text, p - 1), chr(10), '')) + 1 AS INTEGER) AS line, trim(replace(substr(text, p, 200), chr(10), ' ')) AS snippet
  FROM (SELECT doc_id, text, strpos(lower(text), 'license') AS p FROM documents) WHERE p > 0""")
def match_places(spark, at):
    p = F.expr("instr(lower(text), 'license')")
    return table(spark, "documents", at).withColumn("p", p).filter("p > 0").select("doc_id", T.line_at(F.col("text"), F.col("p")).alias("line"), T.snippet_at(F.col("text"), F.col("p")).alias("snippet"))


@query("SELECT count(*) AS n, count(*) FILTER (WHERE l) AS linked, 100.0 * count(*) FILTER (WHERE l) / greatest(count(*), 1) AS percentage FROM (SELECT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS l FROM orders)")
def linked_percentage(spark, at):
    return report.linked_percentage(table(spark, "orders", at), table(spark, "lineitem", at).withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


@query("SELECT lang, avg(CASE WHEN n_chars > 2000 THEN 1 ELSE 0 END) AS share FROM documents GROUP BY lang")
def share_by_language(spark, at):
    return report.share(table(spark, "documents", at), "lang", F.col("n_chars") > 2000)


@query("SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def latest_iteration_only(spark, at):
    return report.latest_only(table(spark, "events", at).withColumn("day", F.to_date("ts")), "day").select("event_id", "user_id")


@query("SELECT arg_max(event_id, (ts, event_id)) AS commit_sha FROM events")
def last_commit(spark, at):
    return report.last_commit(table(spark, "events", at).select(F.col("event_id").alias("commit_sha"), F.col("ts").alias("committed_at")))


@query("SELECT c_custkey, coalesce(k, -1) AS cluster_id FROM customer LEFT JOIN (SELECT o_custkey, arg_max(CAST(o_orderkey % 7 AS INTEGER), o_orderkey) AS k FROM orders WHERE o_totalprice > 300000 GROUP BY o_custkey) ON o_custkey = c_custkey")
def scatter_colour(spark, at):
    c = table(spark, "orders", at).filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"), (F.col("o_orderkey") % 7).cast("int").alias("cluster_id"), F.col("o_orderkey").alias("ord"))
    return report.scatter_colour(table(spark, "customer", at).select("c_custkey"), c, "c_custkey")


@query("SELECT verdict, coalesce(n, 0) AS n FROM (VALUES ('EXACT'), ('OVERLAP'), ('DISTINCT')) v(verdict) LEFT JOIN (SELECT CASE WHEN quality = 1 THEN 'DISTINCT' ELSE 'EXACT' END AS verdict, count(*) AS n FROM labels GROUP BY 1) USING (verdict)")
def verdict_counts(spark, at):
    rows = table(spark, "labels", at).select(F.when(F.col("quality") == 1, "DISTINCT").otherwise("EXACT").alias("verdict"))
    return report.verdict_counts(rows, ["EXACT", "OVERLAP", "DISTINCT"])


@query("SELECT c_custkey, c_name FROM customer JOIN (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE s = 'F'")
def shippable_rules(spark, at):
    results = table(spark, "orders", at).select(F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderkey", (F.col("o_orderstatus") == "F").alias("ship"))
    return corpus.shippable(table(spark, "customer", at).select("c_custkey", "c_name"), results, "c_custkey", "o_orderdate", "o_orderkey")


@query(f"SELECT 'deep' AS rule, 'medium' AS severity, doc_id AS file, CAST(line AS INTEGER) AS line, left(regexp_replace(value, '^\\s+|\\s+$', '', 'g'), 200) AS snippet, 'pending_llm_review' AS message FROM {LINES} WHERE regexp_matches(value, 'license|License|token')")
def deep_prefilter(spark, at):
    return rules.deep_prefilter(_files(spark, at), "deep", None, ["token", "License", "license", "abc"])


@query("SELECT a.vec_id AS id, round(sqrt(greatest(2 - 2 * list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 0)), 5) AS distance FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def unit_distances(spark, at):
    v = _vectors(spark, at)
    other = v.select((F.col("id") - 1).alias("id"), F.col("vector").alias("next"))
    return v.join(other, "id").select("id", F.round(V.unit_distance(V.cosine(F.col("vector"), F.col("next"))), 5).alias("distance"))


@query(f"""SELECT rule, count(*) AS n, '## ' || rule || ' (' || count(*) || ')' || chr(10) || string_agg('- `' || file || ':' || line || '` ' || snippet, chr(10) ORDER BY k) FILTER (WHERE k <= 50) || CASE WHEN count(*) > 50 THEN chr(10) || '- and ' || (count(*) - 50) || ' more' ELSE '' END AS markdown
  FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY file, line, snippet) AS k FROM {HITS}) GROUP BY rule""")
def scan_markdown(spark, at):
    from .sources import sinks

    return sinks.scan_markdown(rules.line_findings(_files(spark, at)))


@query("""WITH e AS (SELECT label AS cluster_id, vec_id, 'd/' || vec_id % 3 || '/c/x/f' || vec_id % 7 AS path FROM embeddings WHERE label >= 0),
  files AS (SELECT cluster_id, string_agg('f' || f || '=' || n, ',' ORDER BY n DESC, 'f' || f) AS top_files FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, o) AS k FROM (SELECT cluster_id, vec_id % 7 AS f, count(*) AS n, min(vec_id) AS o FROM e GROUP BY ALL)) WHERE k <= 5 GROUP BY cluster_id),
  dirs AS (SELECT cluster_id, string_agg('d/' || f || '/c=' || n, ',' ORDER BY n DESC, f) AS top_dirs FROM (SELECT cluster_id, vec_id % 3 AS f, count(*) AS n FROM e GROUP BY ALL) GROUP BY cluster_id),
  shown AS (SELECT cluster_id, string_agg('s' || vec_id, ',' ORDER BY vec_id) AS summaries, string_agg('s' || vec_id, chr(10) ORDER BY vec_id) || repeat(chr(10), 2) || string_agg('## ' || path || chr(10) || 'c' || vec_id, repeat(chr(10), 2) ORDER BY vec_id) AS tail FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY vec_id) AS k FROM e) WHERE k <= 8 GROUP BY cluster_id),
  sizes AS (SELECT cluster_id, CAST(count(*) AS INTEGER) AS size, CAST(count(DISTINCT vec_id % 7) AS INTEGER) AS n_commits FROM e GROUP BY 1 HAVING count(DISTINCT vec_id % 7) >= 3)
  SELECT cluster_id, size, n_commits, top_files, top_dirs, summaries, '# Cluster ' || cluster_id || ': ' || size || ' entries, ' || n_commits || ' commits' || repeat(chr(10), 2) || tail AS prompt FROM sizes JOIN files USING (cluster_id) JOIN dirs USING (cluster_id) JOIN shown USING (cluster_id)""")
def cluster_bundles(spark, at):
    from .sources import sinks

    n = F.col("vec_id")
    e = table(spark, "embeddings", at).select(F.col("label").alias("cluster_id"), (n % 7).cast("string").alias("bug_key"), F.concat(F.lit("d/"), n % 3, F.lit("/c/x/f"), n % 7).alias("file_path"), F.concat(F.lit("s"), n).alias("bug_summary"), F.concat(F.lit("c"), n).alias("buggy_code"), n.alias("ord"))
    listed = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["name"], F.lit("="), x["count"])), ",")
    return sinks.cluster_bundles(e).select("cluster_id", "size", "n_commits", listed("top_files").alias("top_files"), listed("top_dirs").alias("top_dirs"), F.array_join("bug_summaries", ",").alias("summaries"), "prompt")


@query("SELECT doc_id, lang || ',' || source AS parts, upper(left(lang, 1)) || lower(substr(lang, 2)) || 'Rule' AS class_name FROM documents")
def parsed_answers(spark, at):
    d = table(spark, "documents", at).withColumn("answer", F.concat(F.lit("<rule_id> "), F.upper("lang"), F.lit("_rule! </rule_id><rule>```\nx\n```</rule><bad>"), "lang", F.lit("\n// ---\n"), "source", F.lit("</bad><rationale>w</rationale>")))
    return corpus.parsed_answer(d, dashes=False).select("doc_id", F.array_join("test_inputs", ",").alias("parts"), T.class_name(F.col("rule_id")).alias("class_name"))


@query()
def hdbscan_clusters(spark, at):
    vectors = table(spark, "embeddings", at).select(F.col("vec_id").alias("id"), V.normalised(F.col("embedding")).alias("vector"), F.lit(0).alias("part"))
    return hdbscan.clustered(vectors, ["part"], 5, 2, True)


@query()
def svd_scatter(spark, at):
    docs = table(spark, "documents", at).select(F.col("doc_id").alias("id"), "text")
    return vectorise.svd_view(docs, vectorise.code_tokens(F.col("text")), 500, 6)


def _run(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """The stream's rows over what is there, kept in the shared folder."""
    import uuid

    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    incremental.run_once(stream, path + "-state", path=path)
    return spark.read.schema(stream.schema).parquet(path)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(spark, at):
    events = incremental.table_stream(spark, at, "events")
    return _run(spark, incremental.first_seen(events, ["user_id", "event_type"], "ts", "60 days").select("user_id", "event_type"), "first-seen")


@query(f"""SELECT id, CASE WHEN cos >= 0.3 THEN k END AS cluster_id, CASE WHEN cos < 0.3 THEN 'batch' WHEN k % 3 = 0 THEN 'regression' WHEN size >= 50 THEN 'synthesise' ELSE 'wait' END AS route
  FROM (SELECT vec_id AS id, k, size, list_cosine_similarity(CAST(embedding AS DOUBLE[]), c) AS cos, row_number() OVER (PARTITION BY vec_id ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), c) DESC, k) AS n
  FROM embeddings, {CENTROIDS_SQL} JOIN (SELECT label AS k, count(*) AS size FROM embeddings GROUP BY label) USING (k)) WHERE n = 1""")
def stream_assign_route(spark, at):
    cents = vectorise.centroids(table(spark, "embeddings", at), "label", "embedding").select(F.col("label").alias("cluster_id"), "centroid", "size", (F.col("label") % 3 == 0).alias("has_rule"))
    vectors = incremental.table_stream(spark, at, "embeddings").select(F.col("vec_id").alias("id"), V.doubles(F.col("embedding")).alias("vector"))
    return _run(spark, incremental.routed(vectors, cents, 0.3, 50), "routes")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) >= 5")  # all files are one batch, in which each key crosses
def stream_threshold_cross(spark, at):
    return _run(spark, incremental.threshold_crossings(incremental.table_stream(spark, at, "events").select("user_id"), "user_id", 5), "crossings")


from . import catalog_more, catalog_further  # noqa: E402, F401  they register further queries
