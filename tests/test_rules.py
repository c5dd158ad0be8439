"""Line rules look at lines one by one, whatever other rules there are."""

import pytest

from bugloom.operators.rules import Rule, line_findings


def lines(spark, text, *patterns):
    rules = tuple(Rule(f"r{i}", "low", p) for i, p in enumerate(patterns))
    return sorted((r.rule, r.line) for r in line_findings(spark.createDataFrame([(1, text)], "file long, text string"), rules).collect())


@pytest.mark.parametrize(
    ("text", "patterns", "found"),
    [
        ("x 'ab' ", (r"zz(z)", r"(['\"])[a-z]+\1 "), [("r1", 1)]),  # a group's number is the rule's own
        ("abc\ndef", (r"abc\z",), [("r0", 1)]),
        ("abc\ndef", (r"(?<!\s)def",), [("r0", 2)]),
        ("abc\ndef", (r"abc(?!\s)",), [("r0", 1)]),
        ("abc\ndef", (r"^def$", r"^abc$"), [("r0", 2), ("r1", 1)]),
        ("abc", (r"(?<n>a)", r"(?<n>b)"), [("r0", 1), ("r1", 1)]),  # one group name in two rules
        ("abc\ndef", (r"(?s)abc.def",), []),
        ("", (r"^$",), [("r0", 1)]),
    ],
)
def test_rules_stand_alone(spark, text, patterns, found):
    assert lines(spark, text, *patterns) == found


def test_null_texts_and_kept_columns(spark):
    files = spark.createDataFrame([(1, None, "a"), (2, "hit\n\nhit", "b")], "file long, text string, lang string")
    assert [(r.file, r.line, r.lang) for r in line_findings(files, (Rule("h", "low", "hit"),), keep=("lang",)).orderBy("line").collect()] == [(2, 1, "b"), (2, 3, "b")]
