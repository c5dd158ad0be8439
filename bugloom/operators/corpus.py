"""The corpus: bugs with their fixes and the code that brought them in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .relational import first_n, last_of, sampled_n


def build(inducing: DataFrame, bugs: DataFrame, fixes: DataFrame, largest_fix: bool = False) -> DataFrame:
    """A row for each block of code with text, of commits whose bug and fix are known.

    Of several bugs or fixes of a key the last by ord counts; largest_fix: the one with the most removed lines.
    inducing: bug_key, repo, blocks (array of file_path, language, content), szz_confidence; bugs: key, summary, labels,
    ord; fixes: bug_key, diff, lines_removed, ord.  Joins are on the key; the optimiser picks how by the sides' sizes.
    """
    bug = last_of(bugs, ["key"], "ord").select(F.col("key").alias("bug_key"), "summary", "labels")
    fix = last_of(fixes, ["bug_key"], *(["lines_removed", "ord"] if largest_fix else ["ord"])).select("bug_key", F.col("diff").alias("fix_diff"))
    rows = inducing.join(bug, "bug_key").join(fix, "bug_key").withColumn("block", F.explode("blocks")).filter(T.not_blank(F.col("block.content")))
    return rows.select("bug_key", "repo", "block.file_path", "block.language", F.col("block.content").alias("buggy_code"), "fix_diff", F.col("summary").alias("bug_summary"), F.col("labels").alias("jira_labels"), "szz_confidence")


def blamed(deleted: DataFrame, blame: DataFrame, commits: DataFrame) -> DataFrame:
    """Code that fixes took out, with the commit that wrote it.

    deleted: bug_key, fix_sha, file, line, content; blame: fix_sha, file, line, sha; commits: sha, n_files, insertions,
    deletions.  Source files only, no trivial commits; where one commit wrote all of a fix's lines confidence is .9, else .7.
    """
    known = deleted.filter(T.language(F.col("file"), blamed=True) != "other").join(blame, ["fix_sha", "file", "line"])
    real = commits.filter(~T.is_trivial_commit(F.col("n_files"), F.col("insertions"), F.col("deletions"))).select("sha")
    rows = known.join(real, "sha", "left_semi")
    alone = rows.groupBy("fix_sha").agg((F.countDistinct("sha") == 1).alias("alone"))
    return rows.join(alone, "fix_sha").select("bug_key", "fix_sha", "sha", F.col("file").alias("file_path"), F.col("line").alias("start_line"), F.col("line").alias("end_line"), T.language(F.col("file"), blamed=True).alias("language"), "content", F.when(F.col("alone"), 0.9).otherwise(0.7).alias("szz_confidence"))


def cleaned(entries: DataFrame, cap: int, seed: int) -> DataFrame:
    """Without noise summaries, and at most cap entries of a commit."""
    return sampled_n(entries.filter(~T.is_noise_summary(F.col("bug_summary"))), ["bug_key"], cap, seed, F.col("file_path"))


def prompt_examples(entries: DataFrame, n: int = 5) -> DataFrame:
    """cluster_id and the text of its first n entries by ord."""
    one = F.format_string("### %s\n%s\n--- fix ---\n%s", "bug_summary", F.left("buggy_code", F.lit(2000)), F.left("fix_diff", F.lit(2000)))
    rows = first_n(entries.withColumn("text", one), ["cluster_id"], n, F.col("ord"))
    return rows.groupBy("cluster_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "\n\n").alias("examples"))


def routed_clusters(entries: DataFrame, cluster: str, language: str, least: int = 2) -> DataFrame:
    """cluster, language, n, engine of each language of a cluster with enough entries to write a rule from."""
    n = entries.groupBy(cluster, language).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return n.withColumn("engine", T.engine_of(F.col(language)))


def parsed_answer(answers: DataFrame, dashes: bool = True) -> DataFrame:
    """A rule synthesiser's answers (column answer) as rule id, source, snippets and rationale; answers that lack a part go."""
    s = lambda tag: T.section(F.col("answer"), tag)
    out = answers.select("*", T.rule_id(s("rule_id"), dashes).alias("rule_id"), T.fenced(s("rule")).alias("rule_source"), T.snippets(T.fenced(s("bad"))).alias("test_inputs"), T.snippets(T.fenced(s("good"))).alias("test_outputs"), s("rationale").alias("rationale"))
    return out.filter("rule_id <> '' AND rule_source <> '' AND rationale <> ''")


def shippable(rules: DataFrame, results: DataFrame, key: str, *order: str) -> DataFrame:
    """Rules whose last result by order lets them ship."""
    return rules.join(last_of(results, [key], *order).filter("ship").select(key), key, "left_semi")


def latest_by(df: DataFrame, key: list[str], stamp: str) -> DataFrame:
    """One row for each key with the greatest stamp; of equal stamps the least row."""
    w = Window.partitionBy(*key).orderBy(F.desc(stamp), *[c for c in df.columns if c not in key and c != stamp])
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
