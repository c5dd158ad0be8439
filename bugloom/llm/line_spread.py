"""Line dedup by the number of different sites that a line stands on.

1. Each line's HyperLogLog sketch of sites merges by aggregation; lines whose estimate is near the threshold get exact
   counts.  Lines on MIN_SITES sites or more are candidates.
2. An article copied to many sites has such lines too.  What tells boilerplate is that it stands beside text of its
   document's own: only documents with at most MOST_SHARE of their characters in candidates vouch for a candidate, and
   one with vouching documents on MIN_SITES sites or more is boilerplate.
3. Boilerplate goes from every document, also from those that hold little else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, stored, table

MIN_SITES = 10
MOST_SHARE = 0.5
LG_K = 10
#: Estimates within this share of the threshold, and one, are near it: over four standard errors of 1.04 / sqrt(2 ^ LG_K).
NEAR = 0.15


def bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\v\f"))


def keyed(docs: DataFrame) -> DataFrame:
    """d: a row of docs; rid: alike for rows alike in doc_id and text."""
    return docs.select(F.struct(*docs.columns).alias("d"), F.xxhash64("doc_id", "text").alias("rid"))


def line_rows(docs: DataFrame) -> DataFrame:
    """A row for every line with more than white space: rid, source, total (characters of all lines), pos, size, key, key2.

    Lines alike but for white space at their ends share the keys.
    """
    lines = F.split("d.text", "\n", -1)
    total = F.length("d.text") - F.size(lines) + 1
    rows = docs.select("rid", F.col("d.source").cast("string").alias("source"), total.alias("total"), F.posexplode(lines).alias("pos", "line"))
    rows = rows.select("rid", "source", "total", "pos", F.length("line").alias("size"), bare(F.col("line")).alias("line")).filter("line <> ''")
    return rows.select("rid", "source", "total", "pos", "size", F.xxhash64("line").alias("key"), F.xxhash64(F.reverse("line")).alias("key2"))


def candidates(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """key and key2 of the lines on min_sites sites or more, stored; a null site is none."""
    sketched = lines.groupBy("key", "key2").agg(F.count("source").alias("n"), F.hll_sketch_agg(F.col("source"), LG_K).alias("sketch")).filter(F.col("n") >= min_sites)
    guessed = stored(sketched.select("key", "key2", F.hll_sketch_estimate("sketch").alias("sites")), "op9-sketches")
    reach = NEAR * min_sites + 1
    sure = guessed.filter(F.col("sites") > min_sites + reach).select("key", "key2")
    unsure = guessed.filter(F.abs(F.col("sites") - min_sites) <= reach).select("key", "key2")
    exact = lines.join(unsure, ["key", "key2"]).groupBy("key", "key2", "source").count().filter("source IS NOT NULL").groupBy("key", "key2").agg(F.count("*").alias("sites"))
    found = stored(sure.unionByName(exact.filter(F.col("sites") >= min_sites).select("key", "key2")), "op9-candidates")
    dropped(guessed)
    return found


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, most_share: float = MOST_SHARE) -> DataFrame:
    """rid and gone: the keys of the lines that go from each document that holds any."""
    found = candidates(lines, min_sites)
    line = F.struct("pos", "key", "size")  # in a set, so that rows that repeat count once
    held = lines.join(found.hint("merge"), ["key", "key2"]).groupBy("rid").agg(F.collect_set(line).alias("lines"), F.collect_set("source").alias("sources"), F.max("total").alias("total"))
    size = F.aggregate("lines", F.lit(0), lambda a, x: a + x["size"])
    held = stored(held.select("rid", F.array_distinct("lines.key").alias("keys"), "sources", (size <= most_share * F.col("total")).alias("vouches")), "op9-held")
    spread = held.filter("vouches").select("sources", F.explode("keys").alias("key")).select("key", F.explode("sources").alias("source"))
    sure = stored(spread.distinct().groupBy("key").agg(F.count("*").alias("sites")).filter(F.col("sites") >= min_sites).select("key"), "op9-boilerplate")
    gone = stored(held.select("rid", F.explode("keys").alias("key")).join(sure.hint("merge"), "key").groupBy("rid").agg(F.collect_list("key").alias("gone")), "op9-gone")
    dropped(found, held, sure)
    return gone


def judged(docs: DataFrame, min_sites: int = MIN_SITES, most_share: float = MOST_SHARE) -> DataFrame:
    """d: the rows of docs with their text cleaned; n_lines and n_removed.

    Null texts stay null, without lines; rows that repeat are judged alike; a null doc_id or source stays.
    """
    rows = keyed(docs)
    gone = boilerplate(line_rows(rows), min_sites, most_share)
    out = rows.join(gone.hint("merge"), "rid", "left").withColumn("lines", F.split("d.text", "\n", -1))
    stays = lambda x: ~F.array_contains("gone", F.xxhash64(bare(x))) | (bare(x) == "")
    out = out.withColumn("kept", F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.filter("lines", stays)))
    none = F.col("d.text").isNull()
    out = out.withColumn("n_lines", F.when(none, 0).otherwise(F.size("lines")).cast("long")).withColumn("n_removed", F.when(none, 0).otherwise(F.size("lines") - F.size("kept")).cast("long"))
    text = F.when(F.col("n_removed") > 0, F.array_join("kept", "\n")).otherwise(F.col("d.text"))
    return out.select(F.col("d").withField("text", text).alias("d"), "n_lines", "n_removed")


def without_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, most_share: float = MOST_SHARE) -> DataFrame:
    """docs, all columns and rows, with texts cleaned; n_chars, if there, follows a changed text."""
    rows = judged(docs, min_sites, most_share)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("d", F.when(F.col("n_removed") > 0, F.col("d").withField("n_chars", F.length("d.text").cast(kind))).otherwise(F.col("d")))
    return rows.select("d.*")


def op9_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document its lines, how many went and the hash of what is left."""
    rows = judged(table(spark, "documents", sf_dir).select("doc_id", "source", "text"))
    return rows.select("d.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("d.text", F.lit("")), 256).alias("kept_sha256"))


OP9_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, i, string_split(text, chr(10))[i] AS line,
         trim(string_split(text, chr(10))[i], ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS bare
  FROM (SELECT doc_id, source, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
), candidates AS (
  SELECT bare FROM lines WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= {MIN_SITES}
), marked AS (
  SELECT *, bare IN (SELECT bare FROM candidates) AS candidate FROM lines
), shares AS (
  SELECT doc_id, coalesce(sum(length(line)) FILTER (WHERE candidate), 0) <= {MOST_SHARE} * sum(length(line)) AS vouches FROM marked GROUP BY doc_id
), boilerplate AS (
  SELECT bare FROM marked JOIN shares USING (doc_id) WHERE candidate AND vouches GROUP BY bare HAVING count(DISTINCT source) >= {MIN_SITES}
), judged AS (
  SELECT *, bare IN (SELECT bare FROM boilerplate) AS gone FROM lines
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text
  FROM judged GROUP BY doc_id
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, sha256(text) AS kept_sha256 FROM kept
"""
