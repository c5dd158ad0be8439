"""Phrases against a brute-force count, over odd texts, several ranges and both ways to look words up."""

import collections
import random
import re

import pytest

from bugloom.llm import collocations

from .conftest import DOCS

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def expected(rows, least, longest, top):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(low)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    gone = {(lang, w[i:j]) for (lang, w), a in candidates.items() for i in range(len(w)) for j in range(i + 2, len(w) + 1) if j - i < len(w) and a >= f[lang, w[i:j]]}
    found = collections.defaultdict(list)
    for (lang, w), a in candidates.items():
        if (lang, w) not in gone:
            score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            found[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, all_ in found.items() for i, (s, a, p, x, y) in enumerate(sorted(all_)[:top]))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    some = ["New", "york", "the", "of", "The", "ÄB", "äb", "a\x01", "a", "a\x02b", "don't", "x\xa0y", "99", "<p>", "zz"]
    texts = ["".join(rng.choice(some) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ",", "!?", "\x0b"]) for _ in range(rng.randint(1, 60))) for _ in range(120)]
    texts += ["new york city hall of " * 300, "of the", "of the", "of the", " of the ", "", None, " \t.\n", "word", "a a a a a a", ":of the:", "über-rare alone", "of\tthe\r\nof the"]
    rows = [(i, t, rng.choice(["en", "en", "de", None, "und"]), "s", 0) for i, t in enumerate(texts)]
    return rows + rows[-6:] + [(None, "of the a", "xx", None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    wide = spark.createDataFrame(rows, DOCS).repartition(3)
    for c in ("word", "id", "key", "a", "n", "seg", "codes", "range"):
        wide = wide.selectExpr("*", f"'clash' AS {c}")
    return wide


def taken(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize(("least", "top"), [(1, 10_000), (3, 40), (20, 5)])
def test_against_brute_force(docs, rows, least, top):
    assert taken(collocations.collocations(docs, least, 5, top)) == expected(rows, least, 5, top)


def test_many_ranges_segments_and_a_joined_dictionary(docs, rows, monkeypatch):
    for k, v in (("RANGE", 40), ("SEGMENT", 500), ("BROADCAST_WORDS", 0)):
        monkeypatch.setattr(collocations, k, v)
    assert taken(collocations.collocations(docs, 2, 5, 3000)) == expected(rows, 2, 5, 3000)
    assert taken(collocations.collocations(docs, 2, 3, 3000)) == expected(rows, 2, 3, 3000)


def test_a_pair_in_a_third_of_all_places_spans_ranges(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, " ".join(f"hot pair w{rng.randint(0, 40)}" for _ in range(30)), "en", "s", 0) for i in range(60)]
    monkeypatch.setattr(collocations, "RANGE", 50)
    monkeypatch.setattr(collocations, "SEGMENT", 2000)
    assert taken(collocations.collocations(spark.createDataFrame(rows, DOCS).repartition(4), 5, 5, 500)) == expected(rows, 5, 5, 500)


def test_scores_are_exact_beyond_64_bits(spark):
    phrases = spark.createDataFrame([(bytearray([1, 2]), 10**12 + 7)], "key binary, a long")
    singles = spark.createDataFrame([(bytearray([1]), 10**12 + 9, "en"), (bytearray([2]), 3 * 10**12 + 1, "en")], "key binary, f long, lang string")
    totals = spark.createDataFrame([("en", 9 * 10**14 + 11)], "lang string, n long")
    r = collocations.scored(phrases, singles, totals, 1).first()
    assert r["score"] == 1000 * (10**12 + 7) * (9 * 10**14 + 11) // ((10**12 + 9) * (3 * 10**12 + 1))
    assert (r["l"], r["r"]) == (10**12 + 9, 3 * 10**12 + 1)


def test_radix_order():
    import numpy as np

    rng = np.random.default_rng(0)
    for width in (5, 10, 15):
        rows = rng.integers(0, 4, (500, width)).astype(np.uint8)
        assert [bytes(r) for r in rows[collocations.radix_sorted(rows)]] == sorted(bytes(r) for r in rows)
