"""The quality models a second time: trees walked and tables added up one row at a time, and accuracy on labels held out."""

import bisect
import math
import zlib

import numpy as np
import pytest

from bugloom.llm import gam_quality, gbt_quality, textstats

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def features(docs):
    """Of each text by itself, as operators see them in blocks."""
    out = {}
    for r in docs.collect():
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        s = textstats.stats(data, np.array([0, len(data)]))
        out[r.doc_id] = [float(s[f][0]) for f in textstats.FEATURES], int(s["n_words"][0]), int(s["n_repeat_words"][0])
    return out


def walked(model, x):
    total = model.base
    for root, _ in model.roots:
        at = root
        while model.feature[at] >= 0:
            at = model.left[at] if x[model.feature[at]] <= model.threshold[at] else model.right[at]
        total += model.value[at]
    return 1 / (1 + math.exp(-total))


def test_op1_scores_and_verdicts(spark, docs, labels, features):
    model = gbt_quality.grow(*textstats.labelled_sample(docs, labels, gbt_quality.SAMPLE))
    assert len(model.roots) == gbt_quality.TREES
    for r in gbt_quality.op1_quality_rules(spark, SF).collect():
        x, n_words, repeated = features[r.doc_id]
        score = walked(model, x)
        failed = n_words < 20 or 100 * repeated > 30 * n_words
        assert abs(r.score - score) < 1e-9 and r.base_failed == failed
        assert r.kept == (not failed and score >= gbt_quality.KEEP)


def test_op1_accuracy_on_held_out_labels(docs, labels):
    held = {r.doc_id for r in labels.select("doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    learnt = labels.filter(~labels.doc_id.isin(sorted(held)))
    model = gbt_quality.grow(*textstats.labelled_sample(docs, learnt, gbt_quality.SAMPLE))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = [(r.score >= gbt_quality.KEEP) == (truth[r.doc_id] == 1) for r in gbt_quality.judged(docs, model).collect() if r.doc_id in held]
    assert len(got) > 20 and sum(got) / len(got) > 0.9


def added(model, x):
    total = model.base + sum(t[bisect.bisect_left(c, v)] for t, c, v in zip(model.tables, (list(c) for c in model.cuts), x, strict=True))
    coarse = [bisect.bisect_left(list(c), v) for c, v in zip(model.coarse, x, strict=True)]
    total += sum(t[coarse[f], coarse[k]] for f, k, t in model.pairs)
    return 1 / (1 + math.exp(-total))


def test_op6_scores(spark, docs, labels, features):
    model = gam_quality.fitted(docs, labels)
    assert model.pairs
    for r in gam_quality.op6_quality_classifier(spark, SF).collect():
        assert abs(r.score - added(model, features[r.doc_id][0])) < 1e-9
