"""Counts and series for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .relational import first_n, last_of


def coverage(findings: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Counts by row and column as a matrix with totals; values: the columns' names, so that no extra pass finds them."""
    out = findings.groupBy(row).pivot(column, values).count().na.fill(0)
    return out.withColumn("total", sum((F.col(str(v)) for v in values), F.lit(0)).cast("long"))


def coverage_of_all(findings: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """As coverage, but rows of other values, null included, are counted too, as `other` and in the total."""
    named = F.coalesce(F.col(column).isin(*values), F.lit(False))
    return coverage(findings.withColumn(column, F.when(named, F.col(column)).otherwise("other")), row, column, [*values, "other"])


def monthly(rows: DataFrame, stamp: str) -> DataFrame:
    return rows.groupBy(T.month_of(F.col(stamp).cast("string")).alias("month")).agg(F.count("*").alias("n"))


def date_range(rows: DataFrame, stamp: str) -> DataFrame:
    return rows.agg(F.min(F.to_date(stamp)).alias("first_day"), F.max(F.to_date(stamp)).alias("last_day"))


def high_watermark(rows: DataFrame, stamp: str) -> DataFrame:
    """The greatest text, and the text of the greatest moment: they differ where offsets are mixed."""
    return rows.agg(F.max(stamp).alias("by_text"), F.max_by(stamp, F.try_to_timestamp(stamp)).alias("by_time"))


def cards(rows: DataFrame, *columns: str) -> DataFrame:
    """Different values of columns; empty texts are none."""
    return rows.agg(*(F.countDistinct(F.when(F.col(c).cast("string") != "", F.col(c))).alias(f"n_{c}") for c in columns))


def dominant(rows: DataFrame, group: str, item: str, order: str) -> DataFrame:
    """The most frequent item of each group; of equal counts the one seen first."""
    counts = rows.groupBy(group, item).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counts.groupBy(group).agg(F.max_by(item, F.struct("n", -F.col("first"))).alias(item), F.max("n").alias("n"))


def size_distribution(rows: DataFrame, key: str) -> DataFrame:
    """Least, upper-middle and greatest size of clusters, noise apart."""
    sizes = rows.filter(F.col(key) >= 0).groupBy(key).agg(F.count("*").alias("n"))
    return sizes.agg(F.sort_array(F.collect_list("n")).alias("s")).select(F.col("s")[0].alias("least"), F.element_at("s", (F.size("s") / 2).cast("int") + 1).alias("middle"), F.element_at("s", -1).alias("greatest"))


def noise_rate(rows: DataFrame, key: str) -> DataFrame:
    return rows.agg(F.count_if(F.col(key) == -1).alias("noise"), F.count("*").alias("n")).withColumn("rate", F.when(F.col("n") > 0, F.col("noise") / F.col("n")).otherwise(0.0))


def cluster_profile(rows: DataFrame, key: str, commit: str, least: int) -> DataFrame:
    """Size and commits of each cluster with enough commits."""
    return rows.groupBy(key).agg(F.count("*").alias("size"), F.countDistinct(commit).alias("n_commits")).filter(F.col("n_commits") >= least)


def top_clusters(profile: DataFrame, n: int, order: str) -> DataFrame:
    return profile.orderBy(F.desc("size"), order).limit(n)


def language_summary(entries: DataFrame, group: str, noise, cap: int, key: str, *order) -> DataFrame:
    """Rows, rows without noise and rows that a cap for each key leaves, in one pass over flags.

    The cap is counted on sizes of (group, key), which combine before the shuffle.
    """
    sizes = entries.groupBy(group, key).agg(F.count("*").alias("n"), F.count_if(~noise).alias("kept"))
    return sizes.groupBy(group).agg(F.sum("n").alias("n_raw"), F.sum("kept").alias("n_filtered"), F.sum(F.least("kept", F.lit(cap))).cast("long").alias("n_capped"))


def cluster_summary(entries: DataFrame, group: str, cluster: str, commit: str, least: int) -> DataFrame:
    """n_clusters, n_surviving (with enough commits), n_dropped and n_noise of each group."""
    sizes = entries.groupBy(group, cluster).agg(F.count("*").alias("n"), F.countDistinct(commit).alias("commits"))
    real, enough = F.col(cluster) >= 0, F.col("commits") >= least
    out = sizes.groupBy(group).agg(F.count_if(real).alias("n_clusters"), F.count_if(real & enough).alias("n_surviving"), F.coalesce(F.sum(F.when(F.col(cluster) == -1, F.col("n"))), F.lit(0)).alias("n_noise"))
    return out.withColumn("n_dropped", F.col("n_clusters") - F.col("n_surviving"))


def verdict_counts(rows: DataFrame, names: list[str]) -> DataFrame:
    """A row for each name, also of verdicts that don't occur."""
    zero = rows.sparkSession.createDataFrame([(n,) for n in names], "verdict string")
    return zero.join(rows.groupBy("verdict").agg(F.count("*").alias("n")), "verdict", "left").na.fill(0, ["n"])


def share(rows: DataFrame, group: str, flag) -> DataFrame:
    return rows.groupBy(group).agg(F.avg(flag.cast("int")).alias("share"))


def linked_percentage(rows: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """Of rows that have a link, in a hundred; 0 without rows."""
    flagged = rows.join(links.select(key).distinct().withColumn("_l", F.lit(1)), key, "left")
    return flagged.agg(F.count("*").alias("n"), F.count("_l").alias("linked")).withColumn("percentage", 100.0 * F.col("linked") / F.greatest("n", F.lit(1)))


def scatter_colour(points: DataFrame, clusters: DataFrame, key: str) -> DataFrame:
    """points with the cluster of their key, the last one by ord; -1 if it has none."""
    last = last_of(clusters.select(key, "cluster_id", "ord"), [key], "ord").drop("ord")
    return points.join(last, key, "left").withColumn("cluster_id", F.coalesce("cluster_id", F.lit(-1)))


def authors(entries: DataFrame, commits: DataFrame, n: int = 10) -> DataFrame:
    """The authors of most entries."""
    counts = entries.join(commits.select("sha", "author"), entries.commit_sha == commits.sha, "left").groupBy("author").agg(F.count("*").alias("n"))
    return counts.filter("author IS NOT NULL").orderBy(F.desc("n"), "author").limit(n)


def recent(notes: DataFrame, n: int = 3) -> DataFrame:
    return notes.orderBy(F.desc("path")).limit(n)


def latest_only(rows: DataFrame, stamp: str) -> DataFrame:
    return rows.join(rows.agg(F.max(stamp).alias(stamp)), stamp, "left_semi")


def last_commit(entries: DataFrame) -> DataFrame:
    return entries.agg(F.max_by("commit_sha", F.struct("committed_at", "commit_sha")).alias("commit_sha"))


def cube(rows: DataFrame, keys: list[str], value: str, quantiles: tuple[float, ...] = (0.5, 0.9), accuracy: int = 1000) -> DataFrame:
    """Counts and percentiles of a value by every subset of keys, exact and of a sketch; level: bits of the keys summed over.

    Exact percentiles keep each different value with its count; a sketch keeps some `accuracy` values whatever the rows,
    and errs by at most 1 / accuracy of the rows in rank.  Both combine before the shuffle.
    """
    names = [f"p{round(100 * q)}" for q in quantiles]
    exact = [F.percentile(value, q).alias(n) for q, n in zip(quantiles, names, strict=True)]
    sketched = [F.percentile_approx(value, q, accuracy).alias(f"{n}_sketched") for q, n in zip(quantiles, names, strict=True)]
    return rows.cube(*keys).agg(F.grouping_id().alias("level"), F.count("*").alias("n"), *exact, *sketched)


def recurring(rows: DataFrame, keys: list[str], repo: str, order: str, least: int, lang: str) -> DataFrame:
    """keys, n, n_sources, first_file, n_langs of what stands in `least` repositories or more; order: the least is the first."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(repo).alias("n_sources"), F.min(order).alias("first_file"), F.count_distinct(lang).alias("n_langs"))
    return counts.filter(F.col("n_sources") >= least)


def first_examples(rows: DataFrame, group: list[str], n: int, *order) -> DataFrame:
    return first_n(rows, group, n, *order)


def cross_patterns(summaries: DataFrame, a: str, b: str, major: int = 20, minor: int = 5, generic: float = 0.3, stop: list[str] | None = None) -> DataFrame:
    """Words of fixes that recur in two repositories.

    summaries: repo, summary.  A word counts once for each different summary; words in more than `generic` of either
    repository's summaries and words of mere change go; major occurrences on one side and minor on the other are needed.
    rank: by the sum, then the lesser count, then the word.
    """
    s = summaries.filter(F.col("repo").isin(a, b) & (F.coalesce("summary", F.lit("")) != "")).select("repo", "summary").distinct()
    total = s.groupBy("repo").agg(F.count("*").alias("total"))
    counts = s.select("repo", F.explode(T.tokens(F.col("summary"), stop)).alias("token")).groupBy("repo", "token").agg(F.count("*").alias("n"))
    flagged = counts.join(total, "repo").withColumn("generic", F.col("n") > generic * F.col("total"))
    sides = flagged.groupBy("token").agg(F.coalesce(F.max(F.when(F.col("repo") == a, F.col("n"))), F.lit(0)).alias("n_a"), F.coalesce(F.max(F.when(F.col("repo") == b, F.col("n"))), F.lit(0)).alias("n_b"), F.bool_or("generic").alias("generic"))
    lo, hi = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    kept = sides.filter(~F.col("generic") & ~F.col("token").isin(*T.NON_DOMAIN) & (hi >= major) & (lo >= minor))
    return kept.select("token", "n_a", "n_b", F.row_number().over(Window.orderBy(F.desc(F.col("n_a") + F.col("n_b")), F.desc(F.least("n_a", "n_b")), "token")).cast("long").alias("rank"))


def pattern_examples(summaries: DataFrame, tokens: DataFrame, n: int = 5) -> DataFrame:
    """The first n different summaries by ord that hold each token, with their pull request.  summaries: repo, summary, pr_url, commit_sha, ord."""
    rows = summaries.withColumn("token", F.explode(T.tokens(F.col("summary")))).join(tokens.select("token"), "token", "left_semi")
    once = rows.groupBy("repo", "token", "summary").agg(F.min_by(F.struct("pr_url", "commit_sha"), "ord").alias("x"), F.min("ord").alias("ord"))
    return first_n(once, ["repo", "token"], n, F.col("ord")).select("repo", "token", "summary", T.pr_label(F.col("x.pr_url"), F.col("x.commit_sha")).alias("pr"), T.rule_shape(F.col("token")).alias("shape"))
