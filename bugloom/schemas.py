"""Schemas of the engine's tables: explicit, never inferred."""

CODE_BLOCK = "struct<file_path: string, start_line: int, end_line: int, language: string, content: string>"
CITATION = "struct<pr_url: string, title: string>"

BUGS = "key string, summary string, description string, resolved_at timestamp, labels array<string>, components array<string>, severity string"
FIXES = "bug_key string, repo string, pr_number int, pr_url string, merge_commit_sha string, fix_commit_shas array<string>, diff string, changed_files array<string>, lines_added int, lines_removed int"
INDUCING = f"bug_key string, repo string, sha string, author string, authored_at timestamp, files array<string>, buggy_code_blocks array<{CODE_BLOCK}>, fix_diff string, fix_commit_sha string, szz_confidence double"
#: One superset of the corpus rows of all miners; what a miner doesn't know is null.
CORPUS = "bug_key string, repo string, file_path string, language string, buggy_code string, fix_diff string, bug_summary string, jira_labels array<string>, szz_confidence double, embedding array<float>, cluster_id int, pr_url string, pr_body_excerpt string, committed_at string, commit_sha string"
CLUSTERS = "cluster_id int, centroid array<float>, size long, description string"
RULES = "rule string, severity string, language string, pattern string, not_pattern string, path_include string, path_exclude string"
RULE_SPECS = f"name string, source_path string, rationale_path string, severity string, diagnostic_keywords array<string>, regex_hint string, citations array<{CITATION}>"
FINDINGS = f"rule string, severity string, file string, line int, snippet string, message string, citations array<{CITATION}>"
CANDIDATE_RULES = "rule_id string, cluster_id int, origin_bug_keys array<string>, target string, rule_source string, test_inputs array<string>, test_outputs array<string>, rationale string"
VALIDATION = "rule_id string, precision double, recall_in_cluster double, false_positives_on_clean int, error string, ship boolean"
SCAN_REPORT = f"scanned_at string, repo string, rules_run array<string>, rule_meta array<struct<name: string, severity: string, rationale_path: string, citations: array<{CITATION}>>>, findings array<struct<rule: string, severity: string, file: string, line: int, snippet: string, message: string, citations: array<{CITATION}>>>, summary struct<by_rule: map<string,bigint>, by_severity: map<string,bigint>, total: bigint>, runtime_seconds double"
ENGINE_REPORT = "results array<struct<path: string, check_id: string, start: struct<line: int>, extra: struct<message: string, severity: string, lines: string>>>"
BUNDLE = "cluster_id int, size int, n_commits int, top_files array<struct<name: string, count: bigint>>, top_dirs array<struct<name: string, count: bigint>>, bug_summaries array<string>"
RANGES = "file string, start int, end int"
