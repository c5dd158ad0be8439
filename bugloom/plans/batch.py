"""The batch pipeline as one plan: corpus, clusters, validation, shipping.  Only writes run it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.vectors import normalised
from ..operators import corpus, hdbscan, patterns, quality, report, vectorise
from ..sources import sinks


@dataclass
class Settings:
    repo: str | None = None
    min_cluster_size: int = 5
    min_samples: int = 2
    leaf: bool = True
    cap: int = 2
    seed: int = 13
    min_commits: int = 3
    max_rules: int = 30
    tables: dict[str, DataFrame] = field(default_factory=dict)


def mined(bugs: DataFrame, fixes: DataFrame, repo: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Bugs that have a fix, and the fixes, of one repository if it is named."""
    fixes = fixes.filter(F.col("repo") == repo) if repo else fixes
    return bugs.join(fixes.select(F.col("bug_key").alias("key")), "key", "left_semi"), fixes


def hashed_terms(rows: DataFrame) -> DataFrame:
    """id, language, vector: hashed runs of one to three code tokens, where no embedding service is named."""
    vectors = vectorise.hashed(rows, vectorise.ngrams(vectorise.code_tokens(F.col("text")), 1, 3), 256)
    return rows.select("id", "language").join(vectors, "id")


def run(inducing: DataFrame, bugs: DataFrame, fixes: DataFrame, embed=hashed_terms, settings: Settings | None = None) -> dict[str, DataFrame]:
    """corpus, clusters, bundles and summary.  embed: rows (id, language, text) to rows with a vector."""
    settings = settings or Settings()
    bugs, fixes = mined(bugs, fixes, settings.repo)
    rows = corpus.cleaned(corpus.build(inducing, bugs, fixes), settings.cap, settings.seed)
    rows = rows.withColumn("id", F.xxhash64("bug_key", "file_path", "buggy_code")).withColumn("text", T.rich_text(F.col("bug_summary"), F.col("buggy_code"), F.col("fix_diff"), F.col("jira_labels")))
    vectors = embed(rows.select("id", "language", "text"))
    labels = hdbscan.numbered(hdbscan.clustered(vectors, ["language"], settings.min_cluster_size, settings.min_samples, settings.leaf), ["language"], least=settings.min_cluster_size)
    entries = rows.join(labels.select("id", "cluster_id"), "id", "left").withColumn("ord", F.col("id"))
    cents = vectorise.centroids(vectors.join(labels.select("id", "cluster_id"), "id"), "cluster_id", "vector")
    top = report.top_clusters(report.cluster_profile(entries.filter("cluster_id >= 0"), "cluster_id", "bug_key", settings.min_commits), settings.max_rules, "cluster_id")
    return {"corpus": entries.drop("ord"), "clusters": cents, "bundles": sinks.cluster_bundles(entries, settings.min_commits), "top": top}


def clustered_by_era(rows: DataFrame, cap: int, seed: int, min_cluster_size: int, min_samples: int = 2) -> tuple[DataFrame, DataFrame]:
    """(entries without noise and beyond the cap, with id and era; id and cluster_id).  Each language's eras are clustered apart.

    rows: corpus rows with embeddings.  Eras with too few rows have no clusters and take no numbers.
    """
    kept = corpus.cleaned(rows, cap, seed).withColumn("id", F.xxhash64("bug_key", "file_path", "buggy_code")).dropDuplicates(["id"])
    entries = kept.drop("cluster_id").withColumn("era", T.era(F.col("committed_at")))
    vectors = entries.select("language", "era", "id", normalised(F.col("embedding")).alias("vector"))
    labels = hdbscan.clustered(vectors, ["language", "era"], min_cluster_size, min_samples, True)
    return entries, hdbscan.numbered(labels, ["language", "era"], least=min_cluster_size)


def validated(rules: DataFrame, hits: DataFrame, n_sampled: DataFrame) -> DataFrame:
    """rule_id, precision, recall, ship.  rules: rule_id, target, n_tests; hits: rule_id, matched, fp, clean; n_sampled: rule_id, n."""
    r = rules.join(hits, "rule_id", "left").join(n_sampled, "rule_id", "left").na.fill(0, ["matched", "fp", "clean", "n"])
    p = F.when(F.col("target") == "scalafix", quality.validation_precision(F.col("fp"), F.col("n"), True)).otherwise(quality.validation_precision(F.col("fp"), F.col("n"), False))
    return quality.ship_gate(r.select("rule_id", "target", p.alias("precision"), (F.col("matched") / F.greatest("n_tests", F.lit(1))).alias("recall_in_cluster"), F.col("clean").alias("false_positives_on_clean")))


def rule_validation(entries: DataFrame, rules: DataFrame, clean: DataFrame | None = None, n_off: int = 20) -> DataFrame:
    """Each rule run over its own cluster's entries, a sample of others and clean texts: counts, precision, recall, ship.

    entries: id, cluster_id, language, ord, path, text; rules: rule_id, pattern, cluster_id, language, target; clean: id,
    language, path, text.  matched: entries of its cluster with a finding, of n_tests; fp: of the first n_off others with
    one; clean: clean texts with one, 0 if there are none to scan.  A rule meets no other text than these.  Rules are shipped
    to the texts.
    """
    r = F.broadcast(rules.select("rule_id", "pattern", "cluster_id", "language"))  # few: texts must not meet by cluster or language
    texts = ["rule_id", "pattern", "kind", "id", "path", "text"]
    own = entries.join(r, ["cluster_id", "language"]).withColumn("kind", F.lit("own")).select(texts)
    off = quality.off_cluster(entries, rules, n_off).join(F.broadcast(r.select("rule_id", "pattern")), "rule_id").withColumn("kind", F.lit("off")).select(texts)
    scanned = own.unionByName(off)
    if clean is not None:
        scanned = scanned.unionByName(clean.join(F.broadcast(r.drop("cluster_id")), "language").withColumn("kind", F.lit("clean")).select(texts))
    found = patterns.keyed_findings(scanned).select("rule_id", "kind", "id").distinct()
    of = lambda kind: F.count_if(F.col("kind") == kind)
    hits = found.groupBy("rule_id").agg(of("own").alias("matched"), of("off").alias("fp"), of("clean").alias("clean"))
    sizes = own.select("rule_id", "kind").unionByName(off.select("rule_id", "kind")).groupBy("rule_id").agg(of("own").alias("n_tests"), of("off").alias("n"))
    counted = rules.select("rule_id", "target").join(sizes, "rule_id", "left").na.fill(0, ["n_tests", "n"])
    verdicts = validated(counted.select("rule_id", "target", "n_tests"), hits, counted.select("rule_id", "n"))
    return counted.join(hits, "rule_id", "left").na.fill(0, ["matched", "fp", "clean"]).drop("target").join(verdicts, "rule_id")
