"""How good rules are: precision, recall, gates, overlap, heuristics."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import shared_folder
from .relational import first_n, first_of, similar_sets

# fixed values
ANCHORS = (r'Term\.Name\s*\(\s*"([^"]+)"\s*\)', r'Type\.Name\s*\(\s*"([^"]+)"\s*\)', r'endsWith\s*\(\s*"([^"]+)"\s*\)', r'startsWith\s*\(\s*"([^"]+)"\s*\)')
ANCHOR_NOISE = "fix doc tree pos init rhs values args argss argClauses other t n id message position lint empty collect exists flatten map flatMap nonEmpty true false Some None Seq Set List String Boolean Tree Term Type Patch Diagnostic SyntacticDocument SemanticDocument implicit".split()
TEST_MARKS = ("test", "spec", "mock", "stub", "testkit", "fixture", "__tests__")
OVERLAP = 0.6


def precision(tp: Column, fp: Column) -> Column:
    """0 if there are no hits."""
    return F.coalesce(F.try_divide(tp.cast("double"), tp + fp), F.lit(0.0))


def precision_gate(hits: DataFrame, rules: DataFrame, least: float = 0.75) -> DataFrame:
    """tp, fp, precision and passed of each rule; hits: rule, positive."""
    counts = hits.groupBy("rule").agg(F.count_if(F.col("positive")).alias("tp"), F.count_if(~F.col("positive")).alias("fp"))
    rows = rules.select("rule").join(counts, "rule", "left").select("rule", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("tp", "fp")))
    p = precision(F.col("tp"), F.col("fp"))
    return rows.select("*", p.alias("precision"), (p >= least).alias("passed"))


def validation_precision(fp: Column, n: Column, scalafix: bool) -> Column:
    """Of a sample without the rule's cluster: over a fixed 20 for one engine, over the sample for the other."""
    return 1 - fp / (F.lit(20) if scalafix else F.greatest(n, F.lit(1)))


def ship_gate(validation: DataFrame, p: float = 0.85, r: float = 0.50, fp_rate: float = 0.02) -> DataFrame:
    """ship: precision and recall; for scalafix rules clean findings within the rate of 1,000 too."""
    good = (F.col("precision") >= p) & (F.col("recall_in_cluster") >= r)
    return validation.withColumn("ship", F.when(F.col("target") == "scalafix", good & (F.col("false_positives_on_clean") <= int(fp_rate * 1000))).otherwise(good))


def off_cluster(entries: DataFrame, rules: DataFrame, n: int = 20) -> DataFrame:
    """For each rule the first n entries by ord of its language and another cluster or none.  entries: cluster_id, language, ord."""
    # of a language's first 2 n entries, n a cluster at most, n or all that there are aren't of any one cluster
    first = first_n(first_n(entries, ["language", "cluster_id"], n, F.col("ord")), ["language"], 2 * n, F.col("ord"))
    r = rules.select("rule_id", F.col("cluster_id").alias("_c"), F.col("language").alias("_l"))
    others = first.join(r, (F.col("language") == F.col("_l")) & ~F.col("cluster_id").eqNullSafe(F.col("_c")))
    return first_n(others, ["rule_id"], n, F.col("ord")).drop("_c", "_l")


def anchors(source: Column, *own: Column) -> Column:
    """Names that a rule's source looks for: call arguments and word-like literals, without noise and the rule's own names."""
    plain = T.without_comments(source)
    calls = [F.regexp_extract_all(plain, F.lit(p), 1) for p in ANCHORS]
    literals = F.filter(F.regexp_extract_all(plain, F.lit(r'"([^"\n]{2,})"'), 1), lambda x: x.rlike(r"^[A-Za-z_][A-Za-z0-9_.]*$"))
    drop = F.array(*map(F.lit, ANCHOR_NOISE), *(F.coalesce(o, F.lit("")) for o in own))
    return F.array_sort(F.array_except(F.array_distinct(F.concat(*calls, literals)), drop))


def rule_verdicts(candidates: DataFrame, integrated: DataFrame, overlap: float = OVERLAP, listed: bool = False) -> DataFrame:
    """EXACT (an integrated rule has the fingerprint), OVERLAP (anchors of another rule of either pool are alike) or DISTINCT.

    Both: path, class_name, diagnostic_id, text.  A path names one rule; of several the first counts, of candidates before
    integrated ones.  Sources are read once, and rules with the same anchors are compared as one.  listed: with names, those
    of the rules alike by falling similarity, each once.
    """
    prep = lambda df, pool: df.select("path", "class_name", "diagnostic_id", T.fingerprint(F.col("text")).alias("fingerprint"), anchors(F.col("text"), F.col("class_name"), F.col("diagnostic_id")).alias("items"), F.lit(pool).alias("pool"))
    both = prep(candidates, "candidate").unionByName(prep(integrated, "integrated")).withColumn("set", F.md5(F.to_json("items").cast("binary")))
    path = f"{shared_folder(both.sparkSession)}/rules-{uuid.uuid4().hex}"
    both.write.parquet(path)
    both = both.sparkSession.read.schema(both.schema).parquet(path)
    c = both.filter("pool = 'candidate'")
    exact = first_of(both.filter("pool = 'integrated'").select("fingerprint", F.col("class_name").alias("exact_name"), "path"), ["fingerprint"], "path").drop("path")
    rules = first_of(both.drop("fingerprint"), ["path"], "pool", "class_name", "set")
    sets = rules.groupBy(F.col("set").alias("id")).agg(F.first("items").alias("items"), F.count("*").alias("n"), F.max(F.col("pool") == "candidate").alias("asked"))
    pairs = similar_sets(sets.filter("asked").select("id", "items"), sets.select("id", "items"), overlap)
    alone = sets.filter("n = 1").select(F.col("id").alias("left_id"), F.col("id").alias("right_id"))
    others = pairs.join(alone, ["left_id", "right_id"], "left_anti")
    score = others.groupBy(F.col("left_id").alias("set")).agg(F.max("jaccard").alias("score"))
    of = rules.filter("pool = 'candidate'").select("path", "set")
    out = c.drop("set").join(exact, "fingerprint", "left").join(of.join(score, "set"), "path", "left")
    verdict = F.when(F.col("exact_name").isNotNull(), "EXACT").when(F.col("score").isNotNull(), "OVERLAP").otherwise("DISTINCT")
    found = F.when(F.col("exact_name").isNotNull(), 1.0).otherwise(F.coalesce("score", F.lit(0.0)))
    kept = ["path", "class_name", "diagnostic_id", "fingerprint", "exact_name", verdict.alias("verdict"), F.round(found, 3).alias("jaccard")]
    if not listed:
        return out.select(kept)
    named = rules.select(F.col("set").alias("right_id"), F.struct(F.col("class_name").alias("name"), "path").alias("r"))
    alike = others.join(named, "right_id").groupBy(F.col("left_id").alias("set")).agg(F.sort_array(F.collect_list(F.struct((-F.col("jaccard")).alias("s"), "r.name", F.col("r.path").alias("of")))).alias("x"))
    names = F.array_distinct(F.transform(F.filter("x", lambda v: v["of"] != F.col("path")), lambda v: v["name"]))
    return out.join(alike, "set", "left").select(*kept, F.when(F.col("exact_name").isNull(), names).alias("names"))


def dedup_rules(candidates: DataFrame, integrated: DataFrame, overlap: float = OVERLAP) -> DataFrame:
    """rule_verdicts with overlaps_with: the integrated rule of the fingerprint, else names by falling similarity, each once."""
    rows = rule_verdicts(candidates, integrated, overlap, listed=True)
    with_ = F.when(F.col("exact_name").isNotNull(), F.array("exact_name")).otherwise(F.coalesce("names", F.array().cast("array<string>")))
    return rows.select("path", "class_name", "diagnostic_id", "fingerprint", "verdict", with_.alias("overlaps_with"), "jaccard")


def verdict(file: Column, snippet: Column, context: Column, severity: Column) -> Column:
    """A first guess at a finding; the order of the tests decides."""
    low = F.lower(F.coalesce(file, F.lit("")))
    return (
        F.when(T.any_of(low, TEST_MARKS), "FP: test path").when(T.strip(snippet).rlike(r"^(//|/\*|\*)"), "FP: comment").when(context.contains("TODO") | context.contains("FIXME"), "AMBIG: known")
        .when(severity == "high", "AMBIG: likely").otherwise("AMBIG: none")
    )


def review_bundle(findings: DataFrame, contexts: DataFrame, rationales: DataFrame) -> DataFrame:
    """A text for each finding: rule, place, code around, rationale, links."""
    rows = findings.join(contexts, ["file", "line"], "left").join(rationales.select("rule", F.left("rationale", F.lit(3000)).alias("rationale"), "links"), "rule", "left")
    text = F.concat_ws("\n\n", F.format_string("# %s (%s)\n%s:%d", "rule", "severity", "file", "line"), "context", "rationale", F.array_join(F.coalesce("links", F.array().cast("array<string>")), "\n"))
    return rows.withColumn("bundle", text)
