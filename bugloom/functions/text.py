"""Columns over text: titles, paths, sections, severities, tokens.  All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
TICKET = r"[A-Z][A-Z0-9]+-\d+"
FIX_TITLES = (r"(?i)^(fix|bugfix|hotfix)[\(\[:]", r"(?i)\bfix:", r"(?i)^\[.*\]\s*fix")
TEST_PATHS = (r"/tests?/", r"Test\.scala$", r"\.test\.(t|j)sx?$", r"\.spec\.(t|j)sx?$", r"IT\.scala$")
SCAN_TEST_PATH = r"(?:^|/)(?:test|tests|it)/|Test\.scala$|IT\.scala$|Spec\.scala$|-test-kit/|/test-kit/|/testkit/|TestKit\.scala$|TestKit/"
TOOLING_PATH = r"(?:^|/)\.(?:claude|git)/|/worktrees?/|/bazel-(?:bin|out|testlogs)/|/target/|/node_modules/|/build/"
NOISE_SUMMARY = r"(?i)(merge pull request|^merge\b|\bchore\b|\brefactor(ing)?\b|\brename(d|s|ing)?\b|\bcleanup\b|\bformatting\b|\bimports?\b|\bbump\b|\bversion bump\b|\breorganize\b|\bmove (file|files|folder)\b)"
HIGH_WORDS = ("security", "identity leak", "data loss", "auth", "credential", "escalat")
LOW_WORDS = ("stylistic", "lint-only", "cosmetic", "style nit")
OPENGREP_LANGUAGES = ("typescript", "javascript", "python", "go")
SEVERITY_RANK = {"high": 0, "medium": 1, "low": 2}
ENGINE_SEVERITY = {"error": "high", "warning": "medium", "info": "low"}
MINED_LANGUAGES = {"scala": "scala", "ts": "typescript", "tsx": "typescript", "js": "javascript", "jsx": "javascript"}
BLAMED_LANGUAGES = MINED_LANGUAGES | {"py": "python", "go": "go"}
MAX_DIFF_BYTES = 50 * 1024


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def any_of(c: Column, patterns) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | c.rlike(p)
    return out


def is_fix_title(title: Column, ticket: str = TICKET) -> Column:
    return any_of(title, (rf"(?i){ticket}", *FIX_TITLES))


def is_test_path(path: Column) -> Column:
    return any_of(path, TEST_PATHS)


def is_finding_in_tests(path: Column) -> Column:
    """Narrower than is_test_path: a leading test/ doesn't count."""
    return path.contains("/test/") | path.contains("/it/") | path.endswith("Test.scala")


def is_noise_summary(summary: Column) -> Column:
    return F.coalesce(summary, F.lit("")).rlike(NOISE_SUMMARY)


def not_blank(c: Column) -> Column:
    return c.rlike(r"\S")


def is_trivial_commit(n_files: Column, added: Column, removed: Column) -> Column:
    return (F.coalesce(n_files, F.lit(0)) == 0) | (F.coalesce(added, F.lit(0)) + F.coalesce(removed, F.lit(0)) < 2)


def extension(path: Column) -> Column:
    return F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)


def looked_up(key: Column, values: dict, default: Column) -> Column:
    out = default
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def is_source_file(path: Column) -> Column:
    return path.rlike(r"\.(scala|jsx?|tsx?|java|py|go)$")


def language(path: Column, blamed: bool = False) -> Column:
    """Of the file's extension; others are `other` for blamed files, null for mined ones."""
    return looked_up(extension(path), BLAMED_LANGUAGES if blamed else MINED_LANGUAGES, F.lit("other") if blamed else F.lit(None).cast("string"))


def engine_of(lang: Column) -> Column:
    """The engine that a cluster's rule is written for, by its language."""
    return F.when(lang == "scala", "scalafix").when(lang.isin(*OPENGREP_LANGUAGES), "opengrep").otherwise("any")


def file_extension(lang: Column) -> Column:
    return looked_up(lang, {"typescript": ".ts", "javascript": ".js", "scala": ".scala"}, F.lit(".txt"))


def bug_key(pr_number: Column, sha: Column) -> Column:
    return F.when(pr_number.isNotNull(), F.concat(F.lit("PR-"), pr_number.cast("string"))).otherwise(F.concat(F.lit("commit-"), F.substring(sha, 1, 12)))


def pr_number_of(subject: Column) -> Column:
    return F.regexp_extract(subject, r"\(#(\d+)\)", 1).try_cast("int")


def truncated_title(title: Column, most: int = 200) -> Column:
    return F.when(F.length(title) > most, F.concat(F.left(title, F.lit(most - 3)), F.lit("..."))).otherwise(title)


def excerpt(body: Column, most: int = 500) -> Column:
    return F.left(strip(F.coalesce(body, F.lit(""))), F.lit(most))


def byte_length(c: Column) -> Column:
    return F.octet_length(c)


def byte_capped(c: Column, most: int = MAX_DIFF_BYTES) -> Column:
    """The first bytes; a character that the cut splits becomes a replacement mark."""
    return F.make_valid_utf8(F.substring(F.encode(c, "UTF-8"), 1, most).cast("string"))


def rich_text(summary: Column, code: Column, diff: Column, labels: Column) -> Column:
    """Text to embed: headed sections, 2,000 characters of the fix, labels."""
    return F.concat_ws("\n\n", F.concat(F.lit("# Bug\n"), summary), F.concat(F.lit("# Buggy code\n"), code), F.concat(F.lit("# Fix diff\n"), F.left(diff, F.lit(2000))), F.concat(F.lit("# Labels\n"), F.array_join(labels, ", ")))


def continuous_text(summary: Column, code: Column, diff: Column) -> Column:
    """Text to embed of what arrives one by one: no headings or labels, 1,500 characters of the fix."""
    return F.concat_ws("\n", summary, code, F.left(diff, F.lit(1500)))


def plain_text(*parts: Column) -> Column:
    return F.concat_ws("\n", *(F.coalesce(p, F.lit("")) for p in parts))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def directory(path: Column, depth: int = 3) -> Column:
    return F.array_join(F.slice(F.split(path, "/"), 1, depth), "/")


def top_directory(path: Column) -> Column:
    return F.split_part(path, F.lit("/"), F.lit(1))


def era(*dates: Column) -> Column:
    """Of the first date that begins with a year; 2022 if none does."""
    year = F.coalesce(*(F.when(d.rlike(r"^\d{4}"), F.left(d, F.lit(4)).cast("int")) for d in dates), F.lit(2022))
    return F.when(year <= 2018, "2014-2018").when(year <= 2022, "2019-2022").otherwise("2023-2026")


def pr_label(url: Column, sha: Column) -> Column:
    number = F.regexp_extract(url, r"/pull/(\d+)", 1)
    return F.when(F.coalesce(url, F.lit("")) == "", F.left(F.coalesce(sha, F.lit("")), F.lit(10))).when(number != "", F.concat(F.lit("PR-"), number)).otherwise(url)


def class_name(rule_id: Column) -> Column:
    return F.array_join(F.transform(F.split(F.replace(rule_id, F.lit("-"), F.lit("_")), "_"), lambda w: F.initcap(w)), "")


def rule_id(c: Column, dashes: bool = True) -> Column:
    return F.regexp_replace(strip(F.lower(c)), "[^a-z0-9-]" if dashes else "[^a-z0-9_]", "")


def snippet_at(text: Column, place: Column, most: int = 200) -> Column:
    """place counts from 1."""
    return strip(F.translate(F.substring(text, place, F.lit(most)), "\n", " "))


def line_at(text: Column, place: Column) -> Column:
    before = F.left(text, place - 1)
    return F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1


def severity_of(text: Column) -> Column:
    """High words, then low words, then a severity line, then medium; words count inside others."""
    low = F.lower(text)
    has = lambda words: any_of(low, words)
    named = F.lower(F.regexp_extract(text, r"(?im)^\s*severity\s*[:=]\s*(high|medium|low)", 1))
    return F.when(has(HIGH_WORDS), "high").when(has(LOW_WORDS), "low").when(named != "", named).otherwise("medium")


def severity_rank(severity: Column, unknown: int = 1) -> Column:
    return looked_up(severity, SEVERITY_RANK, F.lit(unknown))


def at_least(severity: Column, minimum: str) -> Column:
    return severity_rank(severity) <= SEVERITY_RANK.get(minimum, 2)


def engine_severity(c: Column) -> Column:
    return looked_up(F.lower(c), ENGINE_SEVERITY, F.lit("medium"))


def last_segment(check_id: Column) -> Column:
    return F.substring_index(check_id, ".", -1)


def ticket_keys(*texts: Column, ticket: str = TICKET) -> Column:
    """All keys in upper case, each once, in order of appearance."""
    joined = F.concat_ws("\u0001", *texts)
    return F.array_distinct(F.transform(F.regexp_extract_all(joined, F.lit(rf"(?i)({ticket})"), 1), lambda k: F.upper(k)))


def without_comments(source: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(source, r"(?s)/\*.*?\*/", ""), r"//[^\n]*", "")


def fingerprint(source: Column) -> Column:
    """The first 16 hex digits of the SHA-1 of a source without comments and white space."""
    return F.left(F.sha1(F.regexp_replace(without_comments(source), r"\s+", "")), F.lit(16))


def seed_number(seed: str | int) -> int:
    import hashlib

    try:
        return int(seed)
    except ValueError:
        return int(hashlib.sha256(str(seed).encode()).hexdigest(), 16) % (1 << 32)


def section(text: Column, tag: str) -> Column:
    return strip(F.regexp_extract(text, rf"(?s)<{tag}>(.*?)</{tag}>", 1))


def fenced(text: Column) -> Column:
    fence = r"(?s)```[A-Za-z0-9_-]*\n(.*?)```"
    return F.when(text.rlike(fence), strip(F.regexp_extract(text, fence, 1))).otherwise(strip(text))


def snippets(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "// ---"), lambda x: strip(x)), lambda x: x != "")


def citation_urls(text: Column, base: str, repo: str) -> Column:
    """Full links, then numbers named with PR, each link once."""
    full = F.regexp_extract_all(text, F.lit(rf"({base}/[\w\-]+/pull/\d+)"), 1)
    bare = F.transform(F.regexp_extract_all(text, F.lit(r"\bPR[ \-#]?(\d{3,6})\b"), 1), lambda n: F.concat(F.lit(f"{base}/{repo}/pull/"), n))
    return F.array_distinct(F.concat(full, bare))


def citations(text: Column, base: str, repo: str) -> Column:
    """The links of citation_urls with their titles: in brackets after a full link, after a dash or colon else."""
    full = F.transform(F.regexp_extract_all(text, F.lit(rf"({base}/[\w\-]+/pull/\d+(?:\s*\([^)]{{1,200}}\))?)"), 1), lambda m: F.struct(F.regexp_extract(m, r"^(\S+?/pull/\d+)", 1).alias("pr_url"), strip(F.regexp_extract(m, r"\(([^)]+)\)$", 1)).alias("title")))
    bare = F.transform(F.regexp_extract_all(text, F.lit(r"(\bPR[ \-#]?\d{3,6}\b(?:\s*[\u2014\-:]\s*[^\n]{1,160})?)"), 1), lambda m: F.struct(F.concat(F.lit(f"{base}/{repo}/pull/"), F.regexp_extract(m, r"^PR[ \-#]?(\d{3,6})", 1)).alias("pr_url"), strip(F.regexp_extract(m, r"(?s)^PR[ \-#]?\d{3,6}\s*[\u2014\-:]\s*(.*)$", 1)).alias("title")))
    every = F.concat(full, bare)
    urls = F.transform(every, lambda c: c["pr_url"])
    return F.filter(every, lambda c, i: F.array_position(urls, c["pr_url"]) == i + 1)


def glob_to_regex(pattern: str) -> str:
    """`**/` spans folders, also none; `*` and `?` stay within one."""
    import re

    out, i = "", 0
    while i < len(pattern):
        if pattern.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif pattern.startswith("**", i):
            out, i = out + ".*", i + 2
        else:
            out, i = out + {"*": "[^/]*", "?": "[^/]"}.get(pattern[i], re.escape(pattern[i])), i + 1
    return f"^{out}$"


def percent(ratio: Column, places: int = 2) -> Column:
    return F.format_string(f"%.{places}f%%", 100 * ratio)


def day_of(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd")


def month_of(timestamp: Column) -> Column:
    """Of an ISO text, in its own offset."""
    return F.left(timestamp, F.lit(7))


def diagnostic(line: Column) -> Column:
    """file:line: severity: [rule] message, null if it is no such line."""
    p = r"^(?:\[\w+\]\s*)?([^:\s]+\.\w+):(\d+):(?:\d+:)?\s*(error|warning|info):\s*\[([\w.]+)\]\s*(.*)$"
    part = lambda k: F.regexp_extract(line, p, k)
    return F.when(line.rlike(p), F.struct(part(1).alias("file"), part(2).cast("int").alias("line"), engine_severity(part(3)).alias("severity"), F.substring_index(part(4), ".", -1).alias("rule"), part(5).alias("message")))


def grep_line(line: Column) -> Column:
    parts = F.split(line, ":", 3)
    return F.when(F.size(parts) == 3, F.struct(parts[0].alias("file"), parts[1].try_cast("int").alias("line"), parts[2].alias("body")))


# --- words of summaries ---

# fixed values: words of change, which name no domain
NON_DOMAIN = (
    "fix add update remove use make new support refactor feat chore test improve allow enable disable revert release version deps bump rename move cleanup clean implement create build log handle show hide open close send receive"
).split()


def stop_words() -> list[str]:
    """The English stop words of Spark's own StopWordsRemover, of three letters or more; needs a session."""
    from pyspark.ml.feature import StopWordsRemover

    return sorted({w for w in StopWordsRemover.loadDefaultStopWords("english") if w.isalpha() and len(w) >= 3})


def seed_of(name: Column) -> Column:
    """seed_number of a name that is no number: the last 32 bits of its SHA-256."""
    return F.conv(F.right(F.sha2(name.cast("binary"), 256), F.lit(8)), 16, 10).cast("long")


def tokens(text: Column, stop: list[str] | None = None) -> Column:
    """Runs of ASCII letters of the text in lower case, three letters or more, without stop words (stop: a list of one's own)."""
    found = F.filter(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]+"), 0), lambda t: F.length(t) >= 3)
    return F.array_except(F.array_distinct(found), F.array(*map(F.lit, stop_words() if stop is None else stop)))


# fixed values: what rule a recurring word hints at
RULE_SHAPES = {
    "timezone": "require an explicit zone wherever a date is made or moved", "null": "flag access to optional values without a guard", "error": "flag catch blocks that swallow", "type": "flag unchecked casts and inexhaustive matches",
    "async": "flag promises and futures that nobody awaits", "session": "require auth context as an argument", "translation": "flag hard-coded user-facing strings", "permission": "require a guard on every public endpoint", "currency": "flag arithmetic on raw amounts",
    "validation": "require validated requests before use", "duration": "require units with time values", "calendar": "require zone and daylight-safe date arithmetic", "booking": "require allowed status transitions", "payment": "require idempotency keys",
    "notification": "require locale, channel and a key against repeats", "cache": "require expiry and shared keys", "retry": "require bounded back-off", "filter": "require the tenant predicate first", "redux": "require memoised selectors", "navigation": "require a typed router",
}


def rule_shape(token: Column) -> Column:
    return looked_up(token, RULE_SHAPES, F.concat(F.lit("look into fixes that mention "), token))
