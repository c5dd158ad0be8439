"""Rules over argument trees and over Python's syntax, by example."""

import pytest

from bugloom.operators import patterns, trees

MONGO, AWAIT, BARE, MUTABLE = ("missing-meta-site-filter-mongo", "no-await-result-in-production", "py-bare-except", "py-mutable-default-arg")
RULES = {r.id: r for r in patterns.RULES}


def found(rule, text):
    return [(text.count("\n", 0, at) + 1, hit) for at, hit in patterns.matches(RULES[rule], text)]


@pytest.mark.parametrize(
    ("text", "hits"),
    [
        ("coll.find(f)", ["coll.find(f)"]),
        ("this.db.coll.find(f, opts)", ["this.db.coll.find(f, opts)"]),
        ("coll.find()", []),
        ("coll.find(a, b, c)", []),
        ("find(f)", []),
        ('coll.find(Filters.eq("metaSiteId", id))', []),
        ('coll.find(Filters.eq("other", id))', ['coll.find(Filters.eq("other", id))']),
        ('coll.find(Filters.and(Filters.eq("a", 1), Filters.eq("metaSiteId", m(x, y)), Filters.gt("t", 2)))', []),
        ('coll.find(Filters.and(Filters.eq("metaSiteId", m)))', []),
        ('coll.find(Filters.and(Filters.eq("a", 1), Filters.or(Filters.eq("metaSiteId", m))))', ['coll.find(Filters.and(Filters.eq("a", 1), Filters.or(Filters.eq("metaSiteId", m))))']),
        ('coll.find(Filters.and(\n  Filters.eq("a", 1), // Filters.eq("metaSiteId", m)\n  other))', ['coll.find(Filters.and(\n  Filters.eq("a", 1), // Filters.eq("metaSiteId", m)\n  other))']),
        ('coll.find(base.append("metaSiteId", id))', []),
        ('coll.find(f(1).g.append("metaSiteId", id))', []),
        ('coll.find(base.append("x", id))', ['coll.find(base.append("x", id))']),
        ("coll.findOne(f)", ["coll.findOne(f)"]),
        ("coll.aggregate()", ["coll.aggregate()"]),
        ("coll.aggregate[Doc](p, q)", ["coll.aggregate[Doc](p, q)"]),
        ("coll.find(f).sort(s).limit(2)", ["coll.find(f)"]),
        ("a(coll.find(f), other.find(g))", ["coll.find(f)", "other.find(g)"]),
        ("coll.find(if (x) a else b)", ["coll.find(if (x) a else b)"]),
        ("coll.find(x => coll2.find(y))", ["coll.find(x => coll2.find(y))", "coll2.find(y)"]),
        ('val s = "coll.find(f)"; /* coll.find(f) */ // coll.find(f)', []),
        ('"""\ncoll.find(f)\n"""', []),
        ("coll.find(f", []),
        ("(a + b).find(f)", ["(a + b).find(f)"]),
    ],
)
def test_mongo(text, hits):
    assert [h for _, h in found(MONGO, text)] == hits


def test_await():
    text = "Await.result(f, 5.seconds)\nscala.concurrent.Await.ready(f(Await.result(g, d)), d)\nmyAwait.result(f)\nx.Await.result(f)\nAwait.result"
    assert found(AWAIT, text) == [(1, "Await.result(f, 5.seconds)"), (2, "scala.concurrent.Await.ready(f(Await.result(g, d)), d)"), (2, "Await.result(g, d)")]


def test_metavariables_bind():
    p = trees.pattern("f($X, $X)")
    hits = lambda text: [h for _, h in trees.call_matches((p,), (), text)]
    assert hits("f(a.b(1), a.b( 1 ))") == ["f(a.b(1), a.b( 1 ))"] and hits("f(a, b)") == []
    with pytest.raises(ValueError):
        trees.pattern("a + b")


def test_deep_and_broken_texts_end():
    assert list(trees.Source("f(" * 5000 + ")" * 5000).calls())
    assert list(trees.Source("f(" * 5000).calls()) == []
    assert list(trees.Source("(((]]]\"'`/*").calls()) == []
    assert list(trees.Source("").calls()) == []


@pytest.mark.parametrize(
    ("rule", "text", "hits"),
    [
        (BARE, "try:\n    f()\nexcept:\n    pass\n", [(3, "except:")]),
        (BARE, "try:\n  f()\nexcept ValueError: pass\nexcept  :  # all\n  pass\nfinally: pass", [(4, "except  :")]),
        (BARE, 's = """\nexcept:\n"""\n# except:\n', []),
        (BARE, "def g():\n\ttry: f()\n\texcept: pass\n", [(3, "except:")]),
        (MUTABLE, "def f(a: dict[str, int], b=[]): pass", [(1, "def f(a: dict[str, int], b=[])")]),
        (MUTABLE, "class C:\n    @d\n    async def f(self, b={}):\n        pass", [(3, "async def f(self, b={})")]),
        (MUTABLE, "def f(a, b=[1]): pass\ndef g(b=[]): pass\ndef h(a, b, c=[]): pass\ndef i(a, *b, c=[]): pass\ndef j(a=1, b=[]): pass", []),
        (MUTABLE, "x = 'def f(a, b=[]): pass'", []),
        (MUTABLE, "é = 1; \ndef f(a,  # x )\n      b=[],\n      ):\n    return b", [(2, "def f(a,  # x )\n      b=[],\n      )")]),
    ],
)
def test_python(rule, text, hits):
    assert found(rule, text) == hits


def test_texts_that_do_not_parse_have_a_row(spark):
    files = spark.createDataFrame([("a.py", "def f(:\n"), ("b.py", "x = 1"), ("c.py", None), ("d.py", "\n\nprint 'two'"), ("e.py", "a\x00b"), ("f.scala", "def f(:")], "path string, text string")
    rows = [(r.file, r.rule, r.line) for r in patterns.pattern_findings(files, names=(BARE, MUTABLE)).orderBy("file").collect()]
    assert rows == [("a.py", "unparsed-python", 1), ("d.py", "unparsed-python", 3), ("e.py", "unparsed-python", 1)]


def test_paths_of_templates(spark):
    text = "coll.find(f)\nAwait.result(f, d)"
    files = spark.createDataFrame([(p, text) for p in ("src/main/BookingRepo.scala", "src/repo/X.scala", "src/X.scala", "src/test/ARepo.scala", "app/Main.scala", "src/repo/x.ts")], "path string, text string")
    rows = sorted((r.file, r.rule, r.line) for r in patterns.pattern_findings(files).collect())
    assert rows == [("src/X.scala", AWAIT, 2), ("src/main/BookingRepo.scala", MONGO, 1), ("src/main/BookingRepo.scala", AWAIT, 2), ("src/repo/X.scala", MONGO, 1), ("src/repo/X.scala", AWAIT, 2)]
