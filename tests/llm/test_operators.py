"""Every operator against a brute-force version, on tables with nulls, empty and long texts, ties, repeats and odd columns."""

import collections
import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest

from bugloom.llm import gam_quality, gbt_quality, html_template, icws, line_spread, packing, phrase_automata, qgram_decon, suffix_dedup, textstats, warc_revisit
from bugloom.llm.queries import ORACLE_SQL, QUERIES

from .conftest import DOCS

WORD = "[^\x20\x09-\x0d]+"


def prose(rng, n, end="."):
    return " ".join("".join(rng.choice(["the", "an", "re", "in", "er", "ou", "ß", "é"]) for _ in range(rng.randint(1, 4))) for _ in range(n)) + end


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = [prose(rng, 150) for _ in range(12)]
    passage = prose(rng, 60)
    texts = [*base, base[0], base[0], None, "", " \t\n", "one", "a b   c", base[1] + "\n" + passage, passage + " " + base[2], prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40)]
    texts += ["be " * 400, "=" * 900, prose(rng, 30) * 6, prose(rng, 6000), base[3].replace("the", "THE", 2), "#!$% " * 30, "x\n" * 30, "ΑΣ ΟΔΟΣ'S <|endoftext|> don't 123"]
    near = base[4].split()
    for k in range(5):
        w = list(near)
        for i in rng.sample(range(len(w)), 3):
            w[i] = f"new{k}{i}"
        texts.append(" ".join(w))
    texts += [base[5] + "\nAll rights reserved.  "] + [prose(rng, 30) + "\n All rights reserved.\n" + prose(rng, 10) for _ in range(12)]
    out = [(i, t, "en", f"src{i % 13}", len(t or "")) for i, t in enumerate(texts)]
    return out + [out[3], (None, base[6], None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


CLASHES = ("rid", "kh", "sh", "start", "n", "kept", "gone", "lines", "d", "key", "th", "bands", "class_id", "score", "host", "path")


@pytest.fixture(scope="module")
def sf(docs, spark, store):
    wide = docs
    for c in CLASHES:
        wide = wide.selectExpr("*", f"'clash' AS {c}")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(3, 0, 0), (None, 1, 0), (4, None, None), (10**6, 1, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(0, "an item that is nowhere in the documents at all, surely"), (1, None), (None, "x"), (2, "tiny")], "item_id long, text string").selectExpr("*", "'c' AS doc_id")
    pages = spark.createDataFrame([(1, "http://a.example/x#t", "<p>One</p>"), (2, None, None), (3, "HTTPS://www.A.example:443/x/?utm_a=1", ""), (3, "https://a.example/x", "<p>again"), (None, "x", "<b")], "page_id long, url string, html string").selectExpr("*", "'c' AS text")
    vectors = spark.createDataFrame([(i, [float(i % 7), 0.5, -1.0]) for i in range(0, 400, 20)] + [(7, None), (None, [1.0, 1.0, 1.0])], "vec_id long, embedding array<float>").selectExpr("*", "'c' AS row")
    return store(documents=wide, labels=labels, benchmark=bench, pages=pages, embeddings=vectors)


@pytest.fixture(scope="module")
def empty(docs, spark, store, sf):
    read = lambda t: spark.read.parquet(f"{sf}/{t}.parquet").limit(0)
    return store(documents=docs.limit(0), labels=read("labels"), benchmark=read("benchmark"), pages=read("pages"), embeddings=read("embeddings"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def by_id(rows):
    """Documents with rows that repeat taken once, nulls as empty; a null doc_id is the least."""
    return sorted({(-(1 << 63) if r[0] is None else r[0], r[1] or "") for r in rows})


def test_op4(spark, sf, rows):
    n, texts = 200, [(r[1] or "").encode() for r in rows]
    count = collections.Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    want = collections.Counter()
    for r, t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - n + 1):
            if count[t[i : i + n]] > 1:
                gone[i : i + n] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        want[r[0], len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    got = collections.Counter(map(tuple, suffix_dedup.op4_suffix_dedup(spark, sf).collect()))
    assert got == want


def test_op4_hot_cores_and_cut_blocks(spark, docs, monkeypatch):
    from bugloom.llm import spans

    wanted = {tuple(r) for r in _ranges(docs, suffix_dedup)}
    assert wanted == {tuple(r) for r in _ranges(docs, suffix_dedup, hot=1)}
    assert wanted == {tuple(r) for r in _ranges(docs, suffix_dedup, shard=3)} == {tuple(r) for r in _ranges(docs, suffix_dedup, hot=1, shard=2)}
    monkeypatch.setattr(spans, "BLOCK", 1 << 11)
    assert wanted == {tuple(r) for r in _ranges(docs, suffix_dedup)}


def _ranges(docs, module, **named):
    """Single repeated window starts."""
    found = module.repeated_ranges(module.keyed(docs), **named)
    return {(r.rid, i) for r in found.collect() for i in range(r.begin, r.stop)}


def test_suffix_family_levels():
    rng, family, seen, flagged = random.Random(1), suffix_dedup.SuffixFamily(), {}, set()
    words = [bytes([rng.randrange(3) for _ in range(4)]) for _ in range(200)]
    for i in range(0, 200, 10):
        w = np.array(words[i : i + 10], "S4")
        flagged |= set(family.add(np.frombuffer(b"".join(words[i : i + 10]), "S4"), np.arange(i, i + 10)).tolist())
        assert len(w) == 10
    for i, w in enumerate(words):
        seen.setdefault(w, []).append(i)
    # the first holder and every later one; holders in between were flagged when they came
    assert flagged == {i for v in seen.values() if len(v) > 1 for i in v}
    assert len(family.levels) <= 6


def test_op7(spark, sf, rows):
    n, seen, want = 20, set(), {}
    for i, t in by_id(rows):
        w = re.findall(WORD, t)
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            g = tuple(w[k : k + n])
            if g in seen:
                gone[k : k + n] = [True] * n
            seen.add(g)
        want[i, t] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, y in zip(w, gone, strict=True) if not y).encode()).hexdigest())
    got = collections.Counter(map(tuple, phrase_automata.op7_phrase_automata(spark, sf).collect()))
    want = collections.Counter((r[0], *want[-(1 << 63) if r[0] is None else r[0], r[1] or ""]) for r in rows)
    assert got == want


def test_op7_hot_cores(docs):
    assert _ranges(docs, phrase_automata) == _ranges(docs, phrase_automata, hot=1) == _ranges(docs, phrase_automata, shard=3) == _ranges(docs, phrase_automata, hot=1, shard=2)


def test_op4_and_op7_rows_come_from_the_method(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "repeated_windows", lambda texts, counts, *_: np.zeros(int(counts.sum()), bool))
    monkeypatch.setattr(phrase_automata, "automaton", lambda phrases: type("None_", (), {"iter": staticmethod(lambda words: [])}))
    assert not _ranges(docs, suffix_dedup) and not _ranges(docs, phrase_automata)


def test_common_prefixes():
    rng = random.Random(2)
    w = sorted(bytes(rng.choice(b"ab") for _ in range(9)) for _ in range(60))
    want = [next((i for i in range(9) if a[i] != b[i]), 9) for a, b in zip(w, w[1:], strict=False)]
    assert suffix_dedup.common_prefixes(np.array(w, "S9")).tolist() == want


def test_op1(spark, sf, rows):
    got = collections.Counter((r.doc_id, *(r[k] for k in textstats.BASE), r.base_failed) for r in gbt_quality.op1_quality_rules(spark, sf).collect())
    want = collections.Counter()
    for r in rows:
        t = r[1] or ""
        w, lines = re.findall(WORD, t), [x for x in t.split("\n") if re.search(WORD, x)]
        c, hit = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7)), [False] * len(w)
        for i in range(len(w) - 7):
            if c[tuple(w[i : i + 8])] > 1:
                hit[i : i + 8] = [True] * 8
        want[r[0], len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), sum(hit), len(w) < 20 or 100 * sum(hit) > 30 * len(w)] += 1
    assert got == want


def test_trees_are_monotone_and_learn():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(textstats.FEATURES)))
    y = (x[:, 2] + 0.3 * np.sin(9 * x[:, 0]) + rng.normal(0, 0.1, 3000) < 0.5).astype(float)
    model = gbt_quality.grow(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.85
    step = np.repeat(x[:200, None], 20, axis=1)
    step[:, :, 2] = np.linspace(0, 1, 20)
    p = model.score(step.reshape(-1, x.shape[1])).reshape(200, 20)
    assert (np.diff(p, axis=1) <= 1e-12).all()


def test_one_label_or_none():
    x = np.zeros((5, len(textstats.FEATURES)))
    assert gbt_quality.grow(x, np.ones(5)).score(x).min() > 0.9
    assert gam_quality.learn(x[:0], np.zeros(0)).score(x).tolist() == [0.5] * 5


def test_additive_model_finds_pairs():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(textstats.FEATURES)))
    y = ((x[:, 3] > 0.5) ^ (x[:, 7] > 0.5)).astype(float)
    model = gam_quality.learn(x, y)
    assert model.pairs[0][:2] == (7, 3)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def test_op6_held_out(spark, sf, rows):
    got = gam_quality.op6_quality_classifier(spark, sf).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_op6_accuracy_on_driver_data(spark):
    sf = "/root/testdata/sf0.01"
    got = gam_quality.op6_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.9


def test_op3_round_trip(spark, sf, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    want = collections.Counter()
    for r in rows:
        ids = np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        want[r[0], len(ids)] += len(ids)
    got, sequences = collections.Counter(), collections.defaultdict(list)
    for r in packing.op3_vector_packing(spark, sf).collect():
        got[r.doc_id, r.doc_tokens] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        texts = [np.array([*t.encode(x[1] or "", add_special_tokens=False).ids, 1], "<u4") for x in rows if x[0] == r.doc_id]
        assert r.ids_crc32 in {zlib.crc32(x[r.start : r.start + r.length].tobytes()) for x in texts}
    assert got == want
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048 and len(s) <= packing.LIMITS[1]


def test_dot_product_pack_keeps_limits():
    rng = np.random.default_rng(2)
    demand = np.stack([n := rng.integers(1, 101, 500), np.ones(500, int), n // 2], axis=1)
    bins = packing.dot_product_pack(demand, (100, 4, 50))
    assert sorted(i for b in bins for i in b) == list(range(500))
    assert all((demand[b].sum(0) <= (100, 4, 50)).all() for b in bins)
    with pytest.raises(ValueError):
        packing.dot_product_pack(demand, (100, 4, 45))


def test_op3_loss_limits_bind(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng, t = random.Random(3), Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    rows = [(k, prose(rng, rng.randrange(0, 60)), rng.choice([None, 0, 5, 30, 10_000])) for k in range(150)] + [(None, None, None), (7, "", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, answer int").coalesce(1)
    limits, hit = (64, 4, 24), collections.Counter()
    lengths = {r[0]: (len(t.encode(r[1] or "", add_special_tokens=False).ids) + 1, r[2]) for r in rows[:150]}
    taken, sequences = collections.Counter(), collections.defaultdict(list)
    for r in packing.packed(docs, limits=limits, loss="answer").collect():
        taken[r.doc_id] += r.length
        sequences[r.sequence_id].append(r)
    assert all(taken[k] == n for k, (n, _) in lengths.items() if k != 7)
    for s in sequences.values():
        loss = 0
        for r in s:
            n, answer = lengths.get(r.doc_id, (1, None))
            loss += r.length - 1 if answer is None else max(0, r.start + r.length - max(r.start, n - min(answer, n)))
        size = sum(r.length for r in s)
        assert size <= 64 and len(s) <= 4
        if 7 not in {r.doc_id for r in s}:
            assert loss <= 24
            hit.update({"tokens": size >= 62, "segments": len(s) == 4, "loss": loss == 24})
    assert min(hit.values()) > 0


def shingle_counts(t):
    w = re.findall("[a-z0-9\x80-\U0010ffff]+", (t or "").lower())
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def linked(ids, alike):
    """The least id of the component of each."""
    root = {i: i for i in ids}
    for i in ids:
        for j in ids:
            if i < j and root[i] != root[j] and alike(i, j):
                a, b = sorted((root[i], root[j]))
                root = {k: a if v == b else v for k, v in root.items()}
    return root


def weighted_classes(texts, counted):
    """Brute force: classes by weighted Jaccard similarity, where the texts of the ids `counted` give document frequencies."""
    counts = {i: shingle_counts(t) for i, t in texts.items()}
    df = collections.Counter(x for i in counted for x in counts[i])
    idf = {x: np.log((1 + len(counted)) / (1 + max(1, df[x]))) + 1 for c in counts.values() for x in c}
    weights = {i: {x: (1 + np.log(n)) * idf[x] for x, n in c.items()} for i, c in counts.items()}
    sums = {i: sum(w.values()) for i, w in weights.items()}

    def alike(i, j):
        if min(sums[i], sums[j]) < 0.8 * max(sums[i], sums[j]) or not sums[i]:
            return False
        shared = sum(min(w, weights[j].get(x, 0)) for x, w in weights[i].items())
        return shared >= 0.8 * (sums[i] + sums[j] - shared) - 1e-6

    return linked(sorted(texts), alike)


def test_op10(spark, sf, rows):
    got = {(r.doc_id, r.class_id) for r in icws.op10_near_duplicates(spark, sf).collect()}
    chosen = {r.doc_id for r in icws.representatives(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    assert got == {*weighted_classes(texts, chosen).items(), (None, None)}
    assert len(chosen) < len({t for t in texts.values() if shingle_counts(t)})


def test_op10_on_driver_data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    chosen = {r.doc_id for r in icws.representatives(docs).collect()}
    got = {r.doc_id: r.class_id for r in icws.near_classes(docs).collect()}
    assert got == weighted_classes(texts, chosen) and len(set(got.values())) < len(got)
    idf = icws.weighing(docs)
    h, _, _ = icws.shingles(docs.select("text").toArrow()["text"].combine_chunks())
    assert (icws.rarity(h, idf) < 1).mean() > 0.01


def test_op10_large_groups_in_blocks(spark, monkeypatch):
    rng = random.Random(9)
    base = prose(rng, 120).split()
    texts = []
    for k in range(60):
        w = list(base)
        w[rng.randrange(len(w))] = f"w{k}"
        texts.append((k, " ".join(w)))
    monkeypatch.setattr(icws, "GROUP", 16)
    got = icws.near_classes(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0} and len(got) == 60


def test_partners_miss_no_similar_text():
    rng = np.random.default_rng(5)
    sets = [np.sort(rng.choice(40, rng.integers(1, 30), replace=False)) for _ in range(120)]
    sets += [np.delete(x, rng.integers(0, len(x))) if len(x) > 1 else x for x in sets for _ in range(2)]
    bounds = np.concatenate([[0], np.cumsum(list(map(len, sets)))])
    every = np.concatenate(sets).astype(np.uint64)
    for w in (np.ones(len(every), np.float32), rng.random(40).astype(np.float32)[every.astype(int)] + np.float32(0.01)):
        texts = icws.Texts(every, w, bounds)
        members = np.arange(0, len(sets), 2)
        partners, alive = icws.Partners(texts, members), rng.random(len(members)) < 0.8
        for k in range(len(members)):
            want = set(texts.similar(members[k], members[alive & (members != members[k])]).tolist())
            assert set(members[partners.of(k, alive)].tolist()) == want
        assert sorted(x for c in icws.grown(texts, members) for x in c) == members.tolist()


def test_samples_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 62, 600).astype(np.uint64)
    w = rng.random((2, 600)).astype(np.float32) + np.float32(0.1)
    hits = []
    for k in range(40):
        s = icws.samples(np.concatenate([h + np.uint64(k), h + np.uint64(k)]), w.ravel(), np.array([0, 600, 1200]))
        hits += (s[0] == s[1]).tolist()
    assert abs(np.mean(hits) - np.minimum(*w).sum() / np.maximum(*w).sum()) < 0.04


def test_op8_against_edit_distance(spark, docs, store):
    rng = random.Random(4)
    items = [prose(rng, 30, "") for _ in range(6)] + [prose(rng, 150, "")]
    texts, want = [], set()
    for k in range(60):
        item = k % len(items)
        v = list(items[item][: 240 if item == 6 else None].lower())
        edits = rng.randrange(0, int(0.06 * len(v)) + 1)
        for _ in range(edits):
            p = rng.randrange(len(v))
            v[p : p + rng.randrange(2)] = rng.choice(["", "q", "zz"[:1]])
        texts.append((k, prose(rng, rng.randrange(0, 50)) + "  " + "".join(v) + "\n" + prose(rng, rng.randrange(0, 50))))
        want.add((k, item))
    texts += [(100 + k, prose(rng, 300)) for k in range(20)] + [(200, None), (None, items[0]), (201, "")]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in qgram_decon.contaminations(d, b).collect()}
    assert got == want | {(None, 0)}
    left = {r.doc_id for r in qgram_decon.decontaminated(d, b).collect()}
    assert left == {*range(100, 120), 200, 201}


def fewest_edits(p, x):
    """Edits between p and the part of x that is most like it."""
    row = [0] * (len(x) + 1)
    for i, c in enumerate(p):
        new = [i + 1]
        for j, d in enumerate(x):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("at_hand", [1 << 21, 50])
def test_op8_whole_answer_against_edit_distance(spark, monkeypatch, at_hand):
    monkeypatch.setattr(qgram_decon, "AT_HAND", at_hand)
    rng = random.Random(14)
    word = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(30)) for _ in range(n))
    items = [word(6) for _ in range(5)] + [word(3)[:13], word(6)]
    items.append(items[0][:20] + items[1][20:])  # shares q-grams with others
    texts = []
    for k in range(40):
        v = list(items[k % len(items)])
        for _ in range(rng.randrange(0, 5)):  # up to and beyond the budget
            v[rng.randrange(len(v))] = rng.choice("xyz")
        texts.append(word(rng.randrange(0, 6)) + " " + "".join(v) + " " + word(rng.randrange(0, 6)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'c' AS item_id", "'c' AS passage")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").selectExpr("*", "'c' AS doc_id")
    budget = lambda p: min(int(qgram_decon.EDIT_RATE * len(p)), len(p) // qgram_decon.Q - 1)
    want = {(i, j, e) for i, t in enumerate(texts) for j, p in enumerate(items) if (e := fewest_edits(p.lower(), " ".join(t.lower().split()))) <= budget(p)}
    got = qgram_decon.contaminations(docs, bench).collect()
    assert {(r.doc_id, r.item_id, r.edits) for r in got} == want and len(want) > 12
    for r in got:
        assert fewest_edits(items[r.item_id], " ".join(texts[r.doc_id][r.begin : r.stop].lower().split())) <= r.edits


def test_aligned_is_edit_distance():
    rng = random.Random(6)
    for _ in range(40):
        p = [rng.randrange(4) for _ in range(12)]
        x = [rng.randrange(4) for _ in range(rng.randrange(0, 25))]
        cost = [[0] * (len(x) + 1)] + [[i + 1] + [0] * len(x) for i in range(12)]
        for i in range(12):
            for j in range(len(x)):
                cost[i + 1][j + 1] = min(cost[i][j] + (p[i] != x[j]), cost[i][j + 1] + 1, cost[i + 1][j] + 1)
        got = qgram_decon.aligned(np.array(x, np.uint32), np.array(p, np.uint32), -40, 80)
        assert got[0] == min(cost[12])


def without_boilerplate(rows):
    """Brute force: for each row its lines, how many go and what is left."""
    bare = lambda x: x.strip(" \t\r\v\f")
    split = [(r, (r[1] or "").split("\n") if r[1] is not None else []) for r in rows]

    def spread(lines_of):
        sites = collections.defaultdict(set)
        for r, lines in lines_of:
            for x in lines:
                if bare(x) and r[3] is not None:
                    sites[bare(x)].add(r[3])
        return {x for x, s in sites.items() if len(s) >= line_spread.MIN_SITES}

    found = spread(split)
    gone = spread([(r, [x for x in lines if bare(x) in found]) for r, lines in split if 2 * sum(len(x) for x in lines if bare(x) in found) <= sum(map(len, lines))])
    for r, lines in split:
        yield r, lines, [x for x in lines if bare(x) not in gone]


def test_op9(spark, sf, rows):
    want = collections.Counter()
    for r, lines, kept in without_boilerplate(rows):
        want[r[0], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    assert collections.Counter(map(tuple, line_spread.op9_line_spread(spark, sf).collect())) == want
    assert sum(k[2] for k in want) >= 12
    kept = line_spread.without_boilerplate(spark.read.parquet(f"{sf}/documents.parquet"))
    assert kept.columns == spark.read.parquet(f"{sf}/documents.parquet").columns and kept.filter("d <> 'clash' OR kept <> 'clash'").count() == 0


def test_op9_short_pages_lose_boilerplate_and_copies_stay(spark):
    rng = random.Random(8)
    article = [prose(rng, 20) for _ in range(5)]
    rows = [(k, prose(rng, 60) + "\nCookies, please.\nAll rights reserved", "en", f"s{k}", 0) for k in range(12)]
    rows += [(100 + k, "Cookies, please.\nmine\nAll rights reserved", "en", f"s{k}", 0) for k in range(3)]
    rows += [(200 + k, "\n".join([*article[: k % 5], prose(rng, 20), *article[k % 5 :]]), "en", f"s{k}", 0) for k in range(30)] + [(300, "Cookies, please.", "en", "s1", 0)]
    got = {r.doc_id: r.text for r in line_spread.without_boilerplate(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {r[0]: "\n".join(kept) for r, _, kept in without_boilerplate(rows)}
    assert all(got[100 + k] == "mine" for k in range(3)) and got[300] == "" and all(len(got[200 + k].split("\n")) == 6 for k in range(30))


PAGE = '<!DOCTYPE html><html><head><title>T {k}</title><script>var a="</p>";</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="side-ad x">Buy</div><article><h1>Head {k}</h1><p>Fish &amp; chips\n {k}<br>next<p><b>bold</b> end</p><form>mail</form><div class="comments"><p>nice</p></div></article><footer>&copy; us</footer></body></html>'


def test_op5_articles(spark):
    pages = [(k, "http://h.example/" + str(k), PAGE.replace("{k}", str(k))) for k in range(5)] + [(9, None, None), (10, "http://h.example/1", ""), (10, "http://h.example/1", "")]
    got = collections.Counter(map(tuple, html_template.extracted(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()))
    want = collections.Counter((k, u, t := f"Head {k}\nFish & chips {k}\nnext\nbold end" if k < 9 else "", len(t)) for k, u, _ in pages)
    assert got == want


def test_op5_hidden_parts():
    page = html_template.Page('<article><div class="overflow-hidden">a</div><p hidden>b</p><p aria-hidden="true">c</p><p aria-hidden="false">d</p></article>')
    assert html_template.main_text(page, html_template.Template()) == "a\nd"


def test_op5_without_article_keeps_what_varies(spark):
    page = "<html><body><div id=top>Site name</div><div class=links><a href=1>one {k}</a> <a href=2>two</a></div><div class=b><p>Story {k} is long</p><p>and {k}</p></div><div>Contact us</div></body></html>"
    pages = [(k, "http://h.example/" + str(k), page.replace("{k}", str(k))) for k in range(6)]
    got = {r.page_id: r.text for r in html_template.extracted(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Story {k} is long\nand {k}" for k in range(6)}


def test_op5_on_driver_data(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in html_template.op5_html_template(spark, sf).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1|br)>", inner))
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_op2_edges(spark):
    h = lambda **x: {k.replace("_", "-"): v for k, v in x.items()}
    rows = [
        (1, "http://a.b/x", 10, "response", 200, h(etag='"1"', date="10", content_type="t", content_length="9"), "d1"), (2, "https://www.A.b:443/x/#f", 10, "revisit", 304, h(etag='"1"'), None),
        (3, "http://a.b/x?utm_source=q", 20, "revisit", 304, h(etag='W/"1"', date="20", content_length="0", set_cookie="c"), None), (4, "a.b/x", 15, "response", 404, h(etag='"1"'), "d4"),
        (5, "a.b/x", 30, "response", 200, h(last_modified="m", date="30"), "d5"), (6, "a.b/x", 30, "response", 200, h(last_modified="n", date="30"), "d6"), (7, "a.b/x", 31, "revisit", 304, h(last_modified="n"), None),
        (8, "a.b/x", 32, "revisit", 304, h(last_modified="m", etag='"1"'), None), (9, "a.b/x", 33, "revisit", 304, None, None), (10, None, 5, "revisit", 304, None, None), (11, "a.b/x", None, "revisit", 304, None, None), (12, "a.b/X?b=2&a=1", 50, "revisit", 304, None, None),
    ]
    df = spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, status int, headers map<string,string>, digest string").selectExpr("*", "'c' AS stretch", "'c' AS found")
    for stretches in (1, 3, 1024):
        got = {r.record_id: r for r in warc_revisit.resolved(df, stretches).collect()}
        assert {k: (r.outcome, r.response_id) for k, r in got.items()} == {2: ("no_response", None), 3: ("resolved", 1), 7: ("resolved", 6), 8: ("validator_mismatch", 6), 9: ("no_validator", 6), 10: ("no_response", None), 11: ("no_response", None), 12: ("no_response", None)}
        assert got[3].headers == h(etag='W/"1"', date="20", content_type="t", content_length="9") and got[3].digest == "d1" and got[7].headers == h(last_modified="n", date="30")
        assert got[12].url_key == "a.b/X?a=1&b=2"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    import duckdb

    sf, c = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = c.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, sf).select(*want.columns)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want.fetchall(), key=key)


@pytest.mark.parametrize("bound", ["GROUP", "GROUP_SHINGLES"])
def test_op10_large_groups_of_several_classes(spark, monkeypatch, bound):
    rng = random.Random(11)
    texts, base = [], prose(rng, 200).split()
    # a chain: each base is near the next by steps, with copies around each; steps of 7 words keep 0.8, of 60 don't
    for c in range(4):
        base = base[60 * (c > 0) :] + prose(rng, 60 * (c > 0) + 1).split() if c else base
        for k in range(25):
            w = list(base)
            w[rng.randrange(len(w))] = f"x{c}y{k}"
            texts.append((len(texts), " ".join(w)))
    monkeypatch.setattr(icws, bound, 16 if bound == "GROUP" else 3000)
    monkeypatch.setattr(icws, "PIVOTS", 3)
    monkeypatch.setattr(icws, "ROWS", 1)  # so that unlike texts chain one large group
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    root = weighted_classes(dict(texts), {r.doc_id for r in icws.representatives(docs).collect()})
    got = {r.doc_id: r.class_id for r in icws.near_classes(docs).collect()}
    assert got == root and len(set(root.values())) > 1


def test_op10_weighs_by_merged_groups(spark):
    rng = random.Random(12)
    word = lambda n: [f"{rng.choice('bcdfg')}{rng.randrange(10**6)}" for _ in range(n)]
    base, passage, texts = word(100), word(100), []
    texts.append(base)
    for _ in range(35):  # a third of the rows: near the first only, at 0.81
        w = list(base)
        for i in rng.sample(range(5, 95, 6), 2):
            w[i] = word(1)[0]
        texts.append(w)
    texts += [passage + word(110) for _ in range(25)] + [word(80) for _ in range(40)]
    texts += [passage + word(8) for _ in range(3)]  # alike by the passage alone: 0.86 without idf, less with it
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    chosen = {r.doc_id for r in icws.representatives(docs).collect()}
    assert chosen & set(range(36)) == {0}  # so the group doesn't hide its own likeness
    want = weighted_classes({i: " ".join(t) for i, t in enumerate(texts)}, chosen)
    plain = weighted_classes({i: " ".join(t) for i, t in enumerate(texts)}, set())
    assert want != plain and list(want.values()).count(0) == 36
    assert {r.doc_id: r.class_id for r in icws.near_classes(docs).collect()} == want


def test_op10_heavier_edited_copies_keep_weights(spark):
    rng = random.Random(14)
    word = lambda n: [f"{rng.choice('bcdfg')}{rng.randrange(10**6)}" for _ in range(n)]
    base, texts = word(120), []
    for edits in (0, 2, *[7] * 60):  # 0.84, and 0.6 or less to the first: no links, but copies
        w = list(base)
        for i in rng.sample(range(10, 110, 10), edits):
            w[i] = word(1)[0]
        texts.append(w)
    texts += [word(90) for _ in range(40)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in icws.near_classes(docs).collect()}
    assert got == weighted_classes({i: " ".join(t) for i, t in enumerate(texts)}, set())
    assert got[1] == 0 and len({got[i] for i in range(2, 62)}) > 30


def texts_of(spark, sources):
    pages = [(k, f"http://h.example/{k}", x) for k, x in enumerate(sources)]
    return {r.page_id: r.text for r in html_template.extracted(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}


def test_op5_constant_parts_of_articles(spark):
    page = "<main><h1>Head {k}</h1><div class=x1>Read this in our app</div><p>Story {k}</p></main>"
    assert texts_of(spark, [page.replace("{k}", str(k)) for k in range(5)]) == {k: f"Head {k}\nStory {k}" for k in range(5)}
    copies = texts_of(spark, [page.replace("{k}", "")] * 4)
    assert set(copies.values()) == {"Head\nRead this in our app\nStory"}


def test_op5_rare_layouts_keep_their_text(spark):
    a = "<body>Skip to content<div class=a><p>Story {k}</p></div></body>"
    b = '<body>Skip to content<div class="b w-1/2"><p>Tale {k}</p></div></body>'
    got = texts_of(spark, [(a if k < 6 else b).replace("{k}", str(k)) for k in range(10)])
    assert got == {k: f"Story {k}" if k < 6 else f"Tale {k}" for k in range(10)}


def test_op5_words_need_a_host(spark):
    article = '<div class="post has-banner widget"><article id="search-engines-history"><h2 id="related-work">Work {k}</h2><section id="share">Prices {k}</section><div class=comments>nice {k}</div>{notice}</article></div>'
    got = texts_of(spark, [article.replace("{notice}", "<div class=notice>Note {k}</div>" * (k == 1)).replace("{k}", str(k)) for k in range(4)])
    assert got == {k: f"Work {k}\nPrices {k}" + f"\nNote {k}" * (k == 1) for k in range(4)}


def test_op5_classes_decide(spark, monkeypatch):
    a = "<body><div class=top>Daily</div><div class=a><h1>Head {k}</h1><p>Story {k}</p><p>of layout A</p></div><div class=end>Imprint</div></body>"
    b = "<body><div class=top>Daily</div><section class=w><b>Sport</b><p>Tale {k}</p>{items}</section><div class=end>Imprint</div></body>"
    item = "<div class=it><p>said {k}.{j}</p><div class=r>Reply</div></div>"
    pages = [a.replace("{k}", str(k)) for k in range(6)]
    pages += [b.replace("{items}", "".join(item.replace("{j}", str(j)) for j in range(k % 3 + 1))).replace("{k}", str(k)) for k in range(6, 12)]
    want = {k: f"Head {k}\nStory {k}" for k in range(6)} | {k: "\n".join([f"Tale {k}", *(f"said {k}.{j}" for j in range(k % 3 + 1))]) for k in range(6, 12)}
    got = texts_of(spark, pages)
    assert got == want
    monkeypatch.setattr(html_template, "MIN_PAGES", 100)  # no classes
    assert texts_of(spark, pages)[7].split("\n")[:2] == ["Daily", "Sport"]


def test_op5_classes_out_of_order_or_crossing_are_none():
    page = lambda x: html_template.Page(x)
    h = html_template.Hashes()
    toks = lambda *x: [h[t] if isinstance(t, str) else html_template._hash(*t) for t in x]
    x, y, ax, by = toks(" div.x", " div.y", (" div.x", "A"), (" div.y", "B"))
    right, wrong = "<div class=x>A</div><div class=y>B</div><p>t", "<div class=y>B</div><div class=x>A</div><p>t"
    t = html_template.Template(9, [(5, [x, ax, y, by])])
    assert html_template.main_text(page(right), t) == "t" and html_template.main_text(page(wrong), t) == "B\nA\nt"
    again = html_template.main_text(page(right.replace("<p>t", "") + right), t)
    assert again == "t"
    # the second class crosses the first: it holds a token on either side of one of the first's
    u, cu = toks(" div.u", (" div.u", "C"))
    crossing = html_template.Template(9, [(5, [x, ax, y, by]), (4, [u, cu])])
    source = "<div class=x>A</div><div class=u>C</div><div class=y>B</div><p>t"
    assert html_template.main_text(page(source), crossing) == "t"
    assert not html_template._nest([1, 4], [2, 6]) and html_template._nest([1, 4], [2, 3]) and html_template._nest([1, 4], [5, 6])
    crossed = html_template.Template(9, [(5, [x, ax, u, cu]), (4, [y, by])])
    two = "<div class=x>A</div><div class=y>B</div><div class=u>C</div><p>t"
    assert html_template.main_text(page(two), crossed) == "t"
    late = html_template.Template(9, [(5, [x, ax, u]), (4, [y, by, cu])])
    assert html_template.main_text(page(two), late) == "B\nC\nt"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ('<article><p>First.</p><svg class="i"/><p>Second.</p></article>', "First.\nSecond."),
        ('<article><p>a <svg viewBox="0 0 1 1"><title>icon</title><path d="M0/1"/></svg> b</p><svg/></article>', "a b"),
        ("<article><p>Let <math><mi>x</mi><mo>=</mo><msup><mi>y</mi><mn>2</mn></msup></math> hold.</p></article>", "Let x=y2 hold."),
        ("<article><p>Let <math><semantics><mi>x</mi><annotation>\\x</annotation></semantics></math> hold, <math/> too.</p></article>", "Let x hold, too."),
        ("<article><main/><p>open</p></article>", "open"),
        ("<article><p>one<script>x</script> two<!-- c --> three</p></article>", "one two three"),
        ("<header><h1>Site</h1></header><article><header><h1>Title</h1><p>by me</p></header><p>Body</p></article>", "Title\nBody"),
        ("<article><nav><h2>Menu</h2></nav><header><nav><h3>On this page</h3></nav></header><p>Body</p></article>", "Body"),
        ("<article><p>main and <main-menu>x</main-menu></p><script src='/a/'/>var p;</script><p>z</p></article>", "main and\nx\nz"),
    ],
)
def test_op5_parts_of_blocks(source, text):
    assert html_template.main_text(html_template.Page(source), html_template.Template()) == text


def test_labelled_sample_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(1, f"text {i % 50}") for i in range(500)] + [(2, "b"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 1)], "doc_id long, quality int")
    x, y = textstats.labelled_sample(docs, labels, 10)
    assert x.shape[0] == 3 and sorted(y) == [0, 1, 1]


def test_op5_heads_inside_articles_stay(spark):
    page = '<article><h1 class="post-header">Title {k}</h1><div class="share-price">The price rose {k}.</div><p>Body {k}</p></article>'
    assert texts_of(spark, [page.replace("{k}", str(k)) for k in range(4)]) == {k: f"Title {k}\nThe price rose {k}.\nBody {k}" for k in range(4)}


def test_op5_by_host_as_by_broadcast(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").selectExpr("*", "'c' AS host", "'c' AS total", "'c' AS classes")
    want = sorted(map(tuple, html_template.extracted(pages).collect()))
    monkeypatch.setattr(html_template, "SHIPPED", 0)
    assert sorted(map(tuple, html_template.extracted(pages).collect())) == want
