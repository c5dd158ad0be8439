"""Not-modified revisits of a web archive, resolved against the latest earlier full response of the same canonical URL.

The as-of search runs in two steps so that a URL with very many captures is not one task's: within stretches of time by
a window, and across a URL's stretches by the latest response of each, of which there are at most STRETCHES.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

STRETCHES = 1024
#: Query parameters that don't name a resource.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
#: Fields of a not-modified answer that take the place of the stored response's.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, www., default port, fragment, tracking parameters and closing slashes; parameters in order."""
    bare = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    params = F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))


def resolved(captures: DataFrame, stretches: int = STRETCHES) -> DataFrame:
    """One row for each revisit of captures.

    captures: record_id long, url string, ts long, kind (response or revisit), status int, headers map<string,string> with
    names in lower case, digest string.  Full responses are those with kind response and status 200.  Of responses at one
    time the largest record_id counts; a response at the revisit's own time isn't earlier.

    outcome: resolved; no_response; validator_mismatch (the entity tags differ, weak marks apart, or without a pair of
    tags the dates of change); no_validator.  headers: of the response, with PERMITTED ones of the revisit in their place,
    and digest: of the response; both null unless resolved.  A null url or ts matches nothing; null headers are none;
    further columns are ignored; of several like rows each counts.
    """
    c = captures.select("record_id", canonical_url(F.col("url")).alias("url_key"), "ts", "kind", "status", F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"), "digest").filter("kind = 'revisit' OR (kind = 'response' AND status = 200)")
    c = stored(c, "op2-captures")
    lo, hi = c.agg(F.min("ts"), F.max("ts")).first()
    width = max(1, ((hi or 0) - (lo or 0)) // stretches + 1)
    c = c.withColumn("stretch", ((F.col("ts") - F.lit(lo or 0)) / width).cast("long"))
    full = F.when((F.col("kind") == "response") & F.col("url_key").isNotNull() & F.col("ts").isNotNull(), F.struct("ts", "record_id", F.map_entries("headers").alias("headers"), "digest"))
    c = c.withColumn("full", full)
    within = Window.partitionBy("url_key", "stretch").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    # rows without a url or time match nothing, and would meet in one partition
    known = "url_key IS NOT NULL AND ts IS NOT NULL"
    here = c.filter(known).withColumn("near", F.max("full").over(within)).filter("kind = 'revisit'")
    latest = c.filter("full IS NOT NULL").groupBy("url_key", "stretch").agg(F.max("full").alias("last"))
    # a stretch with revisits only also needs what came before it
    slots = latest.unionByName(c.filter("kind = 'revisit' AND url_key IS NOT NULL AND ts IS NOT NULL").select("url_key", "stretch").distinct().withColumn("last", F.lit(None).cast(latest.schema["last"].dataType)))
    slots = slots.groupBy("url_key", "stretch").agg(F.max("last").alias("last"))
    before = Window.partitionBy("url_key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.withColumn("far", F.max("last").over(before)).select("url_key", "stretch", "far")
    out = here.join(carried, ["url_key", "stretch"], "left").withColumn("found", F.coalesce("near", "far")).drop("near", "far")
    lost = c.filter(f"kind = 'revisit' AND NOT ({known})").withColumn("found", F.lit(None).cast(c.schema["full"].dataType))
    out = out.unionByName(lost)

    stored_headers = F.map_from_entries("found.headers")
    tag = lambda m: F.regexp_replace(F.element_at(m, F.lit("etag")), r"^W/", "")
    changed = lambda m: F.element_at(m, F.lit("last-modified"))
    out = out.withColumn("stored", F.when(F.col("found").isNotNull(), stored_headers))
    mine, theirs = F.col("headers"), F.col("stored")
    same = F.when(tag(mine).isNotNull() & tag(theirs).isNotNull(), tag(mine) == tag(theirs)).when(changed(mine).isNotNull() & changed(theirs).isNotNull(), changed(mine) == changed(theirs))
    outcome = F.when(F.col("found").isNull(), "no_response").when(same.isNull(), "no_validator").when(same, "resolved").otherwise("validator_mismatch")
    fresh = F.map_filter(mine, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    merged = F.map_concat(F.map_filter(theirs, lambda k, v: ~F.array_contains(F.map_keys(fresh), k)), fresh)
    out = out.withColumn("outcome", outcome)
    good = F.col("outcome") == "resolved"
    return out.select("record_id", "url_key", "ts", "outcome", F.when(F.col("found").isNotNull(), F.col("found.record_id")).alias("response_id"), F.when(good, merged).alias("headers"), F.when(good, F.col("found.digest")).alias("digest"))


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl's log made of pages: each is answered in full, asked again under another spelling of its url later and once
    before, and answered in full and asked again once more if page_id is a multiple of 3.  Tags are of the content; every
    fifth later answer names another one, every seventh none."""
    day = F.col("page_id") * 60
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))

    def fields(**named: Column) -> Column:
        return F.map_filter(F.create_map(*(x for k, v in named.items() for x in (F.lit(k.replace("_", "-")), v))), lambda k, v: v.isNotNull())

    later_tag = F.when(F.col("page_id") % 7 == 0, F.lit(None)).when(F.col("page_id") % 5 == 0, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag))
    answer = fields(content_type=F.lit("text/html"), content_length=F.length(F.coalesce("html", F.lit(""))).cast("string"), etag=tag, date=day.cast("string"))
    again = lambda at: fields(etag=later_tag, date=at.cast("string"), expires=(at + 600).cast("string"), content_length=F.lit("0"))
    digest = F.sha2(F.coalesce("html", F.lit("")), 256)
    other = F.concat(F.regexp_replace("url", r"#.*$", ""), F.lit("#again"))
    none = F.lit(None).cast("string")
    rows = F.array(
        F.struct((F.col("page_id") * 5).alias("record_id"), F.col("url").alias("url"), day.alias("ts"), F.lit("response").alias("kind"), F.lit(200).alias("status"), answer.alias("headers"), digest.alias("digest")),
        F.struct((F.col("page_id") * 5 + 1).alias("record_id"), other.alias("url"), (day + 86_400).alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), again(day + 86_400).alias("headers"), none.alias("digest")),
        F.struct((F.col("page_id") * 5 + 2).alias("record_id"), F.col("url").alias("url"), (day - 86_400).alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), again(day - 86_400).alias("headers"), none.alias("digest")),
        F.struct((F.col("page_id") * 5 + 3).alias("record_id"), F.upper("url").alias("url"), (day + 172_800).alias("ts"), F.lit("response").alias("kind"), F.when(F.col("page_id") % 3 == 0, 200).otherwise(503).alias("status"), answer.alias("headers"), digest.alias("digest")),
        F.struct((F.col("page_id") * 5 + 4).alias("record_id"), F.col("url").alias("url"), (day + 259_200).alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), again(day + 259_200).alias("headers"), none.alias("digest")),
    )
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").select(F.inline(rows))


def header_text(headers: Column) -> Column:
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")


def op2_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revisit of the log that captures_of makes of all pages."""
    rows = resolved(captures_of(table(spark, "pages", sf_dir)))
    return rows.select("record_id", "url_key", "ts", "outcome", "response_id", header_text(F.col("headers")).alias("headers"), "digest")


_KEY = r"""
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(list_sort(params), '&') ELSE '' END AS url_key
  FROM (SELECT *, list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)')) AS params
        FROM (SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.\-]*://', '') AS bare FROM log))
"""

OP2_SQL = f"""
WITH p AS (SELECT *, page_id * 60 AS day, '"' || substr(md5(html), 1, 16) || '"' AS tag, regexp_replace(url, '#.*$', '') || '#again' AS other,
           CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 5 = 0 THEN '"other"' ELSE 'W/"' || substr(md5(html), 1, 16) || '"' END AS later FROM pages),
log AS (
  SELECT page_id * 5 AS record_id, url, day AS ts, 'response' AS kind, 200 AS status, tag AS etag, html FROM p UNION ALL
  SELECT page_id * 5 + 1, other, day + 86400, 'revisit', 304, later, NULL FROM p UNION ALL
  SELECT page_id * 5 + 2, url, day - 86400, 'revisit', 304, later, NULL FROM p UNION ALL
  SELECT page_id * 5 + 3, upper(url), day + 172800, 'response', CASE WHEN page_id % 3 = 0 THEN 200 ELSE 503 END, tag, html FROM p UNION ALL
  SELECT page_id * 5 + 4, url, day + 259200, 'revisit', 304, later, NULL FROM p
), keyed AS ({_KEY}), full_ AS (SELECT * FROM keyed WHERE kind = 'response' AND status = 200),
best AS (
  SELECT r.record_id, r.url_key, r.ts, r.etag, max(struct_pack(ts := f.ts, id := f.record_id)) AS hit
  FROM keyed r LEFT JOIN full_ f ON f.url_key = r.url_key AND f.ts < r.ts WHERE r.kind = 'revisit' GROUP BY ALL
), told AS (
  SELECT b.record_id, b.url_key, b.ts, b.etag AS mine, f.record_id AS response_id, f.etag, f.html,
    CASE WHEN f.record_id IS NULL THEN 'no_response' WHEN b.etag IS NULL THEN 'no_validator'
         WHEN regexp_replace(b.etag, '^W/', '') = f.etag THEN 'resolved' ELSE 'validator_mismatch' END AS outcome
  FROM best b LEFT JOIN full_ f ON f.record_id = b.hit.id
)
SELECT CAST(record_id AS BIGINT) AS record_id, url_key, CAST(ts AS BIGINT) AS ts, outcome, CAST(response_id AS BIGINT) AS response_id,
  CASE WHEN outcome = 'resolved' THEN 'content-length: ' || length(html) || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || ts || chr(10) || 'etag: ' || mine || chr(10) || 'expires: ' || (ts + 600) END AS headers,
  CASE WHEN outcome = 'resolved' THEN sha256(html) END AS digest
FROM told
"""
