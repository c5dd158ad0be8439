"""Writers: nested JSON lines, Parquet tables, bundles, scan reports, Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.relational import first_n, most_common


def nested_bugs(bugs: DataFrame, fixes: DataFrame) -> DataFrame:
    """A row for each bug that has fixes, with these nested; times as ISO texts."""
    rest = [c for c in fixes.columns if c not in ("bug_key", "pr_number")]
    own = fixes.groupBy("bug_key").agg(F.sort_array(F.collect_list(F.struct("pr_number", *rest))).alias("fixing_commits"))
    return bugs.join(own, bugs["key"] == own["bug_key"]).drop("bug_key").withColumn("resolved_at", F.date_format("resolved_at", "yyyy-MM-dd'T'HH:mm:ss"))


def write_json(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", False).json(path)


def write_table(df: DataFrame, path: str, partition: str | None = None, append: bool = False) -> None:
    """Parquet; never onto a path that df is read from."""
    w = df.write.mode("append" if append else "overwrite")
    (w.partitionBy(partition) if partition else w).parquet(path)


def cluster_bundles(entries: DataFrame, min_commits: int = 3, top: int = 5, shown: int = 8) -> DataFrame:
    """A row for each cluster of enough commits: counts, most common files and folders, first summaries and examples.

    entries: cluster_id, bug_key, file_path, bug_summary, buggy_code, ord.
    """
    from ..functions import text as T

    e = entries.filter("cluster_id >= 0")
    sizes = e.groupBy("cluster_id").agg(F.count("*").cast("int").alias("size"), F.countDistinct("bug_key").cast("int").alias("n_commits")).filter(F.col("n_commits") >= min_commits)

    def common(item: Column, name: str) -> DataFrame:
        rows = most_common(e.withColumn("name", item), ["cluster_id"], "name", top, "ord")
        return rows.groupBy("cluster_id").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "name", "n"))), lambda x: F.struct(x["name"].alias("name"), x["n"].alias("count"))).alias(name))

    some = first_n(e, ["cluster_id"], shown, F.col("ord")).groupBy("cluster_id").agg(F.sort_array(F.collect_list(F.struct("ord", "bug_summary", "file_path", F.left("buggy_code", F.lit(2000)).alias("code")))).alias("x"))
    some = some.select("cluster_id", F.transform("x", lambda v: v["bug_summary"]).alias("bug_summaries"), F.array_join(F.transform("x", lambda v: F.concat(F.lit("## "), v["file_path"], F.lit("\n"), v["code"])), "\n\n").alias("examples"))
    out = sizes.join(common(T.basename(F.col("file_path")), "top_files"), "cluster_id").join(common(T.directory(F.col("file_path")), "top_dirs"), "cluster_id").join(some, "cluster_id")
    prompt = F.concat(F.format_string("# Cluster %d: %d entries, %d commits\n\n", "cluster_id", "size", "n_commits"), F.array_join("bug_summaries", "\n"), F.lit("\n\n"), F.col("examples"))
    return out.withColumn("prompt", prompt).drop("examples")


def scan_markdown(findings: DataFrame, most: int = 50) -> DataFrame:
    """rule, n, markdown: a section for each rule that lists its first findings by file and line."""
    w = Window.partitionBy("rule").orderBy("file", "line", "snippet")
    listed = findings.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= most)
    text = listed.groupBy("rule").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "file", "line", "snippet"))), lambda x: F.format_string("- `%s:%d` %s", x["file"], x["line"], x["snippet"])), "\n").alias("body"))
    n = findings.groupBy("rule").agg(F.count("*").alias("n"))
    more = F.when(F.col("n") > most, F.format_string("\n- and %d more", F.col("n") - most)).otherwise("")
    return n.join(text, "rule").select("rule", "n", F.concat(F.format_string("## %s (%d)\n", "rule", "n"), "body", more).alias("markdown"))


def scan_report(findings: DataFrame, repo: str, scanned_at: str) -> DataFrame:
    """One row: the report with its summary maps."""
    by = lambda k: findings.groupBy(k).agg(F.count("*").alias("n")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(k, "n")))).alias(f"by_{k}"))
    total = findings.agg(F.count("*").alias("total"))
    return by("rule").crossJoin(by("severity")).crossJoin(total).select(F.lit(scanned_at).alias("scanned_at"), F.lit(repo).alias("repo"), F.struct("by_rule", "by_severity", "total").alias("summary"))  # one row each


def candidate_files(rules: DataFrame) -> DataFrame:
    """path and content of each candidate's rule file and meta file."""
    ending = F.when(F.col("target") == "scalafix", ".scala").otherwise(".yaml")
    meta = F.to_json(F.struct("rule_id", "cluster_id", "origin_bug_keys", "target", "rationale"))
    rows = F.array(F.struct(F.concat("rule_id", ending).alias("path"), F.col("rule_source").alias("content")), F.struct(F.concat("rule_id", F.lit(".meta.json")).alias("path"), meta.alias("content")))
    return rules.select(F.inline(rows))


def ship_plan(rules: DataFrame, validation: DataFrame, repo: str, category: str = "uncategorized") -> DataFrame:
    """What a pull request for each rule that may ship would hold; of several results of a rule the last by all values counts."""
    from ..functions import text as T
    from ..operators.relational import last_of

    ok = last_of(validation, ["rule_id"], *[c for c in validation.columns if c != "rule_id"]).filter("ship")
    c = rules.join(ok, "rule_id")
    path = F.when(F.col("target") == "scalafix", F.concat(F.lit("rules/src/main/scala/fix/"), T.class_name(F.col("rule_id")), F.lit(".scala"))).otherwise(F.concat(F.lit(f"rules/{category}/"), "rule_id", F.lit(".yaml")))
    body = F.concat(F.lit("Precision "), T.percent(F.col("precision")), F.lit(", recall "), T.percent(F.col("recall_in_cluster")), F.lit("\n\n"), "rationale", F.lit("\n\nFrom: "), F.array_join("origin_bug_keys", ", "))
    return c.select(F.lit(repo).alias("repo"), F.concat(F.lit("rule/"), "rule_id").alias("branch"), path.alias("path"), F.col("rule_source").alias("content"), F.concat(F.lit("Add rule "), "rule_id").alias("title"), body.alias("body"))


def bucketed(df: DataFrame, path: str, key: str, buckets: int = 64) -> str:
    """Writes a table of the catalogue below a path, hashed by a key into sorted buckets; gives its name, new with each call.

    Two such tables of one key and number of buckets are joined, and each is grouped by the key, without a shuffle.  The
    files stay when the table is dropped.
    """
    import uuid

    name = f"bucketed_{uuid.uuid4().hex}"
    # one file for each bucket, not one for each task and bucket
    df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return name
