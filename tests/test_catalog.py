"""Every query of the catalogue against its SQL."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from bugloom.catalog import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(row):
    return tuple("NULL" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v) for v in row)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    if name not in ORACLE_SQL:
        assert got.count() > 0
        return
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(plain, got.select(*want.columns).collect())) == sorted(map(plain, want.fetchall()))


def test_entry(spark):
    assert {r.rule: r.n for r in entry.entry(spark).collect()}["never-seen"] == 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_hdbscan_clusters_the_whole_table(spark):
    import numpy as np

    from bugloom.operators import hdbscan

    rows = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect())
    x = np.array([v for _, v in rows], float)
    want = hdbscan.labels_of(x / np.linalg.norm(x, axis=1, keepdims=True), 5, 2, True)
    got = {r.id: r.label for r in QUERIES["hdbscan_clusters"](spark, SF).collect()}
    assert got == dict(zip((i for i, _ in rows), want.tolist(), strict=True))


def test_rule_duplicates_use_all_words(spark, tmp_path):
    """Texts alike in their first eight words only are different rules; words that come later make others alike."""
    same, word = [f"aaaaaa{c}" for c in "abcdefgh"], lambda k, n: ["zz" + "".join(chr(97 + int(x)) for x in f"{k}{i:05d}") for i in range(n)]
    texts = [same + word(1, 20), same + word(2, 20), ["bbbbbb"] + word(3, 30), ["cccccc"] + word(3, 29), word(4, 12), word(4, 12)[::-1]]
    spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.path: (r.verdict, r.exact_name, r.jaccard) for r in QUERIES["rule_duplicates"](spark, str(tmp_path)).collect()}
    assert got == {"p00000001": ("DISTINCT", None, 0.0), "p00000003": ("OVERLAP", None, 0.906), "p00000005": ("EXACT", "C4", 1.0)}
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert {x[0]: x[1:] for x in c.sql(ORACLE_SQL["rule_duplicates"]).fetchall()} == got
