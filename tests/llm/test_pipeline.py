"""The pipeline's stages against brute force, on the smallest driver data."""

import corpus_pipeline as pipeline
from bugloom.llm import icws, qgram_decon
from bugloom.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), "test")
        assert out.columns == columns, name
        kept.append((docs, out))
        docs = out
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = [{r.doc_id for r in b.collect()} for _, b in kept]
    clean = [i for i, q in labels.items() if q]
    assert len(ids[0] & set(clean)) / len(clean) > 0.97
    assert ids[1] == ids[0]
    classes = {r.doc_id: r.class_id for r in icws.near_classes(kept[2][0]).collect()}
    assert ids[2] == {i for i, c in classes.items() if i == c}
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert ids[3] == {r.doc_id for r in kept[3][0].collect() if not any(b in r.text for b in bench)}
    packed = pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids[3]
    assert qgram_decon.Q > 1


def test_run(spark):
    assert pipeline.run(spark, SF).select("sequence_id").distinct().count() > 0


def test_near_duplicates_keep_one_row(spark):
    t = " ".join(f"w{i}" for i in range(60))
    rows = [(1, t, "b"), (1, t, "a"), (2, t, "c"), (2, "quite another text", "d"), (None, t, "e"), (None, t, "e"), (3, "", "f"), (3, "", "f"), (4, None, "g"), (5, t + " more", "h"), (1, "a text of its own", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'x' AS rid", "'y' AS root", "'z' AS d")
    out = pipeline.near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id or 0, r.text or "", r.source) for r in out.collect()))
    assert got == sorted([(1, t, "a"), (2, "quite another text", "d"), (0, t, "e"), (0, t, "e"), (3, "", "f"), (4, "", "g"), (1, "a text of its own", "i")])


def odd_tables(spark, store):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (7001, "", "en", "s", 0), (7001, "", "en", "s", 0), (7002, None, "en", None, None), (None, "some text without an id " * 9, "en", "s", 1)], docs.schema)
    every = docs.unionByName(odd).unionByName(docs.limit(3))
    for c in ("rid", "d", "key", "gone", "score", "kept", "th", "root"):
        every = every.selectExpr("*", f"'clash' AS {c}")
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    return store(documents=every, labels=read("labels"), benchmark=read("benchmark")), store(documents=every.limit(0), labels=read("labels").limit(0), benchmark=read("benchmark").limit(0))


def test_stages_on_odd_tables(spark, store):
    for at in odd_tables(spark, store):
        docs = stored(spark.read.parquet(f"{at}/documents.parquet"), "test")
        for _, stage in pipeline.STAGES[:-1]:
            out = stored(stage(spark, docs, at), "test")
            assert out.columns == docs.columns and out.count() <= docs.count()
            if len(docs.columns) > 5:
                assert out.filter("rid <> 'clash' OR d <> 'clash' OR key <> 'clash' OR root <> 'clash'").count() == 0
            docs = out
        assert pipeline.pack(spark, docs, at).count() >= docs.count()
