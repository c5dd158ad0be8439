"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

1. Document frequencies.  Copies must not lower the weights of what they share, so one text of each group of copies counts:
   groups are found by steps 3 to 5 from plain minima of hashes, with every shingle weighing the same and by COPY in place
   of SIMILAR, as copies edited too much to be links are copies still.  Counts go into a sketch of fixed size.
2. A shingle's weight is (1 + ln tf) * idf with idf = ln((1 + n) / (1 + df)) + 1, as a share of the greatest idf; HASHES
   consistent weighted samples of a text's shingles form BANDS band keys.
3. Texts alike word for word collapse to one; texts that share a band key are candidates, and candidate groups are the
   components that these links form.
4. Within each candidate group classes grow from member to member by exact weighted Jaccard similarity, so every link
   between two different texts of a group counts, whichever of them came first.  A group is compared in one task.
5. Groups beyond GROUP texts or GROUP_SHINGLES shingles are dealt out in blocks, each with the same PIVOTS texts of the
   group, so that what one class holds in many blocks comes together.  Then the texts outside the group's largest class
   meet the group's other blocks: a group that is one class of copies is shipped once, and no link between two classes is
   lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, byte_symbols, dropped, in_runs, mapped, mix, parts, prefix_sums, range_hash, stored, table, text_buffers
from .graph import components

SHINGLE = 5
SIMILAR = 0.8
#: Least plain similarity of texts that document frequencies count as one, if the shorter has SIMILAR of the longer's shingles.
#: A text and its copy with a tenth of its words replaced have 0.42; two texts that share a passage of a third of each have 0.2.
COPY = 0.35
ROWS, BANDS = 4, 16
#: At similarity 0.8 a pair meets in no band twice in 10,000 times: (1 - 0.8 ** ROWS) ** BANDS = 0.0002; at 0.3 it meets
#: in one 12 times in 100, so unlike texts seldom chain candidate groups together.
HASHES = ROWS * BANDS
#: Bands of plain minima, ROWS each, by which the texts that count are found: at similarity 0.8 a pair meets in none 2 times in
#: 1,000, at COPY 83 times in 100; a group whose df matters has so many pairs that links connect it all the same.
PLAIN_BANDS = 12
#: The sketch of document frequencies: DEPTH rows of WIDTH counters, whatever the corpus.  A counter also holds the other
#: shingles that fall on it, m on average; df is what is above m if that is beyond NOISE standard deviations of m, else 1.
DEPTH, WIDTH, SLICE, NOISE = 3, 1 << 17, 1 << 12, 2.5
#: Most texts, and most shingles, of a candidate group that one task compares.
GROUP = 4_000
GROUP_SHINGLES = 1 << 21
PIVOTS = 48
TASK_SHINGLES = 1 << 15

_SOLID = np.zeros(256, bool)
_SOLID[128:] = True
_SOLID[[*range(48, 58), *range(97, 123)]] = True


def shingles(arr: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the word shingles, where each text's begin, hash of each text's word sequence, 0 if it has no word).

    Words are runs of letters, digits and bytes beyond ASCII, in lower case.  A text with fewer words has one shingle.
    """
    data, offs = text_buffers(pc.utf8_lower(pc.fill_null(arr.cast(pa.large_string()), "")))
    n = len(offs) - 1
    if not len(data):
        return np.zeros(0, U64), np.zeros(n + 1, np.int64), np.zeros(n, U64)
    solid = _SOLID[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    begin = np.flatnonzero(solid & (edge[:-1] | np.concatenate([[True], ~solid[:-1]])))
    end = np.flatnonzero(solid & (edge[1:] | np.concatenate([~solid[1:], [True]]))) + 1
    bounds = np.searchsorted(begin, offs)
    symbols = np.empty(len(begin), U64)
    for a in range(0, len(begin), 1 << 17):
        b, e = begin[a : a + (1 << 17)], end[a : a + (1 << 17)]
        symbols[a : a + len(b)] = range_hash(prefix_sums(byte_symbols(data[b[0] : e[-1]])), b - b[0], e - b[0])
    sums = prefix_sums(symbols)
    count = np.diff(bounds)
    whole = np.where(count > 0, range_hash(sums, bounds[:-1], bounds[1:]) | U64(1), U64(0))
    have = np.where(count == 0, 0, np.maximum(count - size + 1, 1))
    start = np.repeat(bounds[:-1], have) + in_runs(have)
    return range_hash(sums, start, start + np.repeat(np.minimum(count, size), have)), np.concatenate([[0], np.cumsum(have)]), whole


def counted(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different shingles of each text in order, how often, bounds)."""
    if not len(hashes):
        return hashes, np.zeros(0, np.int64), bounds
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    first = np.flatnonzero(new)
    return h[first], np.diff(np.append(first, len(h))), np.searchsorted(t[first], np.arange(len(bounds)))


def _blocks(arr: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Parts of a column of about half a MB each."""
    _, offs = text_buffers(arr)
    i = 0
    while i < len(arr):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + (1 << 19), "right")) - 1)
        yield i, arr.slice(i, j - i)
        i = j


def _places(h: np.ndarray) -> tuple[np.ndarray, ...]:
    return tuple(((h >> U64(20 * d)) & U64(WIDTH - 1)).astype(np.int64) + d * WIDTH for d in range(DEPTH))


def plain_bands(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of PLAIN_BANDS keys for each text that has shingles."""
    full = np.flatnonzero(np.diff(bounds))
    keys = np.zeros((len(full), PLAIN_BANDS), U64)
    for k in range(PLAIN_BANDS * ROWS if len(full) else 0):
        least = np.minimum.reduceat((h ^ _SEEDS[k]) * U64(0xD6E8FEB86659FD93), bounds[full])
        keys[:, k // ROWS] = mix(keys[:, k // ROWS] + least + U64(k))
    return keys


def representatives(docs: DataFrame) -> DataFrame:
    """doc_id, th of the texts that document frequencies count, stored; docs: doc_id, text."""
    signed = stored(signatures(docs, None), "op10-plain")
    texts = stored(_texts(signed), "op10-plain-texts")
    dropped(signed)
    named = _named(docs, texts, None)
    one = stored(texts.join(named, "th").filter("doc_id = class_id").select("doc_id", "th"), "op10-chosen")
    dropped(texts, named)
    return one


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """The sketch of document frequencies, DEPTH * WIDTH counters, and the number of documents with a word.

    docs: th, text.  Rows whose text isn't that of th don't count, and rows alike count once: rows may share a doc_id.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, seen = np.zeros(DEPTH * WIDTH, np.int64), 0, set()
        for batch in batches:
            for i, part in _blocks(batch.column(1)):
                h, b, th = shingles(part)
                h, _, b = counted(h, b)
                keep = th.view(np.int64) == batch.column(0).to_numpy()[i : i + len(part)]
                for k in np.flatnonzero(keep).tolist():
                    keep[k] = th[k] not in seen
                    seen.add(th[k])
                n += int((keep & (np.diff(b) > 0)).sum())
                for at in _places(h[np.repeat(keep, np.diff(b))]):
                    total += np.bincount(at, minlength=len(total))
        if n:
            slices = [x.astype(np.int64).tobytes() for x in np.split(total, len(total) // SLICE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(slices)), pa.int32()), pa.array([np.int64(n).tobytes(), *slices], pa.binary())], ["k", "c"])

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in rows:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.frombuffer(c, np.int64)
                sums[k] = sums[k] + x if k in sums else x
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["k", "c"])

    partial = mapped(docs.select("th", "text"), count, "k int, c binary")
    found = {r.k: np.frombuffer(bytes(r.c), np.int64) for r in mapped(partial.repartition("k"), add, "k int, c binary").collect()}
    if not found:
        return np.zeros(DEPTH * WIDTH), 0
    return np.concatenate([found[k] for k in range(DEPTH * WIDTH // SLICE)]), int(found[-1][0])


def idf_table(sketch: np.ndarray, n: int) -> np.ndarray:
    """ln((1 + n) / (1 + df)) + 1 by place in the sketch, as a share of that of a shingle of one document."""
    c = sketch.reshape(DEPTH, WIDTH).astype(float)
    mean = np.median(c, axis=1, keepdims=True)
    spread = np.sqrt(mean)
    df = np.where(c - mean > NOISE * spread, c - mean + 0.85 * spread, 1)  # the least of three counters is 0.85 under the mean
    most = math.log((1 + n) / 2) + 1
    return np.clip((np.log((1 + n) / (1 + np.clip(df, 1, max(n, 1)))) + 1) / most, 0, 1).astype(np.float32).ravel()


def rarity(h: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """A shingle is as rare as the smallest of its counters says."""
    return np.maximum.reduce([idf[at] for at in _places(h)])


def weights(h: np.ndarray, tf: np.ndarray, idf: np.ndarray | None) -> np.ndarray:
    """All alike without a table."""
    return np.ones(len(h), np.float32) if idf is None else ((1 + np.log(tf)) * rarity(h, idf)).astype(np.float32)


def _gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2 and scale 1 at the middles of n equal steps."""
    p, lo, hi = (np.arange(n) + 0.5) / n, np.zeros(n), np.full(n, 60.0)
    for _ in range(60):
        x = (lo + hi) / 2
        below = 1 - (1 + x) * np.exp(-x) < p
        lo, hi = np.where(below, x, lo), np.where(below, hi, x)
    return x


_STEPS = 1 << 12
_GAMMA = _gamma_quantiles(_STEPS).astype(np.float32)
_LOG_GAMMA = np.log(_GAMMA)
_LOG_STEP = np.append(np.diff(_LOG_GAMMA), np.float32(0))
_SEEDS = mix(np.arange(1, HASHES + 1, dtype=U64) * U64(0x2545F4914F6CDD1D))


def samples(h: np.ndarray, w: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of HASHES samples for each text that has shingles.

    For each hash a shingle has r and c, gamma distributed, and b, uniform, by its own bits; with t = floor(ln w / r + b)
    the sample is the (shingle, t) with the least ln c - r (t - b + 1).
    """
    full = np.flatnonzero(np.diff(bounds))
    out = np.empty((len(full), HASHES), U64)
    i = 0
    while i < len(full):
        j = max(i + 1, int(np.searchsorted(bounds[full], bounds[full[i]] + TASK_SHINGLES, "right")) - 1)
        a, e = bounds[full[i]], bounds[full[j - 1] + 1]
        x, lw, starts = h[a:e], np.log(w[a:e]), bounds[full[i:j]] - a
        plain = not lw.any()
        for k in range(HASHES):
            z = (x ^ _SEEDS[k]) * U64(0xD6E8FEB86659FD93)
            z ^= z >> U64(32)
            z *= U64(0xD6E8FEB86659FD93)
            at = (z >> U64(52)).astype(np.int32)
            r = _GAMMA[at]
            b = ((z >> U64(28)) & U64(0xFFFFFF)).astype(np.float32) * np.float32(2**-24)
            at = ((z >> U64(16)) & U64(_STEPS - 1)).astype(np.int32)
            lc = _LOG_GAMMA[at] + _LOG_STEP[at] * ((z & U64(0xFFFF)).astype(np.float32) * np.float32(2**-16))
            if plain:
                la, ids = lc - r * (1 - b), z
            else:
                t = np.floor(lw / r + b)
                la, ids = lc - r * (t - b + 1), z + t.astype(np.int64).view(U64) * U64(0x9E3779B97F4A7C15)
            key = (np.maximum(la + np.float32(128), 0).view(np.uint32).astype(U64) << U64(32)) | (ids & U64(0xFFFFFFFF))
            out[i:j, k] = np.minimum.reduceat(key, starts)
        i = j
    return out


def weighted_bands(h: np.ndarray, w: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of BANDS keys for each text that has shingles."""
    s = samples(h, w, bounds)
    keys = np.zeros((len(s), BANDS), U64)
    for k in range(ROWS * BANDS):
        keys[:, k // ROWS] = mix(keys[:, k // ROWS] + s[:, k] + U64(k))
    return keys


def row_id() -> Column:
    """Alike for rows alike in doc_id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("rid")


def signatures(docs: DataFrame, idf: np.ndarray | None) -> DataFrame:
    """doc_id, rid, th (0: no word), n (different shingles), bands: plain ones without a table."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, part in _blocks(batch.column(1)):
                h, b, th = shingles(part)
                h, tf, b = counted(h, b)
                keys = plain_bands(h, b) if idf is None else weighted_bands(h, weights(h, tf, idf), b)
                n = np.where(np.diff(b) > 0, keys.shape[1], 0)
                bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(keys.ravel().view(np.int64)))
                ids = [batch.column(k).slice(i, len(part)) for k in (0, 2)]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(th.view(np.int64)), pa.array(np.diff(b)), bands], ["doc_id", "rid", "th", "n", "bands"])

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_id()), of, "doc_id long, rid long, th long, n long, bands array<long>")


def _texts(signed: DataFrame) -> DataFrame:
    """th, doc_id (the least), n, bands of each different text with a word."""
    return signed.filter("th <> 0 AND doc_id IS NOT NULL").groupBy("th").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bands").alias("bands"))


class Texts:
    """Weighted shingle sets laid end to end; least: the similarity that links two of them."""

    def __init__(self, h: np.ndarray, w: np.ndarray, bounds: np.ndarray, least: float = SIMILAR) -> None:
        self.h, self.w, self.bounds, self.least = h, w.astype(np.float64), bounds, least
        self.text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.sums = np.bincount(self.text, self.w, len(bounds) - 1)

    def similar(self, one: int, others: np.ndarray) -> np.ndarray:
        """Which of the texts others have a weighted Jaccard similarity to one of least or more, and weigh as much by SIMILAR."""
        a, e = self.bounds[one], self.bounds[one + 1]
        s = self.sums
        others = others[(np.minimum(s[others], s[one]) >= SIMILAR * np.maximum(s[others], s[one]) - 1e-9)]
        if not len(others):
            return others
        n = np.diff(self.bounds)[others]
        at = np.repeat(self.bounds[others], n) + in_runs(n)
        h, w = self.h[at], self.w[at]
        place = np.minimum(np.searchsorted(self.h[a:e], h), e - a - 1)
        both = np.where(self.h[a:e][place] == h, np.minimum(w, self.w[a:e][place]), 0)
        shared = np.bincount(np.repeat(np.arange(len(others)), n), both, len(others))
        return others[shared >= self.least * (s[others] + s[one] - shared) - 1e-9]


class Partners:
    """Finds the texts of a group that are similar to one of them.

    Each text's shingles in order of how many of the group's texts hold them, the rarest first: two similar texts share one
    of those that make up the first 1 - least of either's weight, so only texts that do are compared.  Where to walk through
    those takes more than to compare all that are left, all are.
    """

    def __init__(self, texts: Texts, members: np.ndarray) -> None:
        self.texts, self.members = texts, members
        self.size = n = np.diff(texts.bounds)[members]
        at = np.repeat(texts.bounds[members], n) + in_runs(n)
        who = np.repeat(np.arange(len(members)), n)
        _, ids, many = np.unique(texts.h[at], return_inverse=True, return_counts=True)
        order = np.lexsort((ids, many[ids], who))
        ids, weight = ids[order], texts.w[at][order]
        first = np.concatenate([[0], np.cumsum(n)])
        before = np.concatenate([[0], np.cumsum(weight)])
        keep = before[:-1] - before[first[:-1]][who] <= (1 - texts.least) * texts.sums[members][who] + 1e-6
        self.ids, self.bounds = ids[keep], np.concatenate([[0], np.cumsum(np.bincount(who, keep, len(members)))]).astype(np.int64)
        order = np.argsort(self.ids, kind="stable")
        self.holders = who[keep][order]
        self.first = np.searchsorted(self.ids[order], np.arange(len(many) + 1))

    def of(self, one: int, alive: np.ndarray) -> np.ndarray:
        """Places in members of the alive ones that are similar to the one at a place."""
        ids = self.ids[self.bounds[one] : self.bounds[one + 1]]
        n = self.first[ids + 1] - self.first[ids]
        met = alive.copy()
        if n.sum() < self.size[alive].sum():
            met[:] = False
            met[self.holders[np.repeat(self.first[ids], n) + in_runs(n)]] = True
            met &= alive
        met[one] = False
        some = np.flatnonzero(met)
        return some[np.isin(self.members[some], self.texts.similar(self.members[one], self.members[some]))]


def grown(texts: Texts, members: np.ndarray) -> list[list[int]]:
    """The classes that similarity connects: every text is compared with those not yet reached, until none are left."""
    partners, alive, out = Partners(texts, members), np.ones(len(members), bool), []
    for k in range(len(members)):
        if not alive[k]:
            continue
        alive[k] = False
        front, found = [k], [k]
        while front and alive.any():
            near = partners.of(front.pop(), alive)
            alive[near] = False
            front += near.tolist()
            found += near.tolist()
        out.append(members[found].tolist())
    return out


def weighing(docs: DataFrame) -> np.ndarray:
    """The table of idf for docs."""
    one = representatives(docs)
    idf = idf_table(*frequencies(_with_text(docs, one)))
    dropped(one)
    return idf


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, rid and th of every row; th, class_id and root of every text), stored; root tells classes apart."""
    idf = weighing(docs)
    signed = stored(signatures(docs, idf), "op10-signed")
    texts = stored(_texts(signed), "op10-texts")
    named = _named(docs, texts, idf)
    dropped(texts)
    return signed, named


def _with_text(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.hint("merge"), "doc_id")


def _named(docs: DataFrame, texts: DataFrame, idf: np.ndarray | None) -> DataFrame:
    """th, class_id and root (a text of the class) of every text, stored.  texts: th, doc_id, n, bands."""
    keyed = texts.select("th", F.explode("bands").alias("band"))
    buckets = keyed.groupBy("band").agg(F.min("th").alias("a"), F.max("th").alias("z")).filter("a < z").select("band", "a")
    candidates = components(keyed.join(buckets, "band").filter("th <> a").select("a", F.col("th").alias("b")).distinct(), "op10-candidates")
    members = stored(candidates.join(texts.select(F.col("th").alias("v"), "doc_id", "n"), "v"), "op10-members")
    # apart, so that a large group's rows can be split
    sizes = stored(members.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / GROUP), F.ceil(F.sum("n") / GROUP_SHINGLES)).cast("int").alias("cut")), "op10-sizes")
    placed = members.join(sizes, "root").select("doc_id", F.col("v").alias("th"), "n", "root", "cut", F.pmod(F.xxhash64("v"), "cut").cast("int").alias("block"))
    wanted = stored(placed, "op10-wanted")
    task = F.xxhash64("root", "block").alias("task")
    own = wanted.select("doc_id", "th", "n", task, (F.col("cut") > 1).alias("part"), F.lit(0).alias("side"))
    large = wanted.filter("cut > 1")
    if some := bool(large.limit(1).count()):
        first = F.row_number().over(Window.partitionBy("root", "slice").orderBy(F.xxhash64("th", F.lit(1))))
        # a group's pivots are found among its slices' first ones, so that no task orders a whole group
        few = large.withColumn("slice", F.pmod(F.xxhash64("th", F.lit(2)), F.lit(1024))).withColumn("k", first).filter(F.col("k") <= PIVOTS).withColumn("slice", F.lit(0)).withColumn("k", first).filter(F.col("k") <= PIVOTS)
        pivots = few.select("doc_id", "th", "n", "root", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)).alias("block"))
        own = own.unionByName(pivots.select("doc_id", "th", "n", task, F.lit(True).alias("part"), F.lit(0).alias("side")))
    links = stored(_linked(docs, own, idf), "op10-links")
    dropped(candidates, members, sizes)
    roots = links.filter("NOT part").select(F.col("a").alias("th"), "class_id", F.col("b").alias("root"))
    if some:
        near = links.filter("part").select("a", "b")
        rest = stored(_across(large, components(near, "op10-large")), "op10-across")
        near = stored(near.unionByName(_linked(docs, rest, idf).select("a", "b")), "op10-all-links")
        dropped(rest)
        found = components(near, "op10-classes").withColumnRenamed("v", "th")
        least = found.join(texts.select("th", "doc_id"), "th").groupBy("root").agg(F.min("doc_id").alias("class_id"))
        roots = roots.unionByName(found.join(least, "root").select("th", "class_id", "root"))
    lone = texts.join(roots.select("th"), "th", "left_anti").select("th", F.col("doc_id").alias("class_id"), F.col("th").alias("root"))
    named = stored(roots.unionByName(lone), "op10-named")
    dropped(links, wanted)
    return named


def _linked(docs: DataFrame, wanted: DataFrame, idf: np.ndarray | None) -> DataFrame:
    """a, b, class_id, part: every text (a) of a class of two or more with the class's least text (b) and least doc_id.

    wanted: doc_id, th, n, task, side, part (whether the task holds a part of a group only, so that its classes may grow).
    side 0: all of a task's texts are compared; else those of side 1 with all, and links only count between sides.
    """

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts that are as they were wanted: rows may share a doc_id."""
        for batch in batches:
            keep = []
            for i, part in _blocks(batch.column(0)):
                keep.append(shingles(part)[2].view(np.int64) == batch.column(1).to_numpy()[i : i + len(part)])
            if keep:
                yield pa.RecordBatch.from_arrays(list(batch.columns), batch.schema.names).filter(pa.array(np.concatenate(keep))).select(["task", "th", "side", "doc_id", "part", "text"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, found = ([], [], [], [], []), []
        for batch in batches:
            for i, part in _blocks(batch.column(5)):
                h, b, _ = shingles(part)
                h, tf, b = counted(h, b)
                found.append((h, weights(h, tf, idf), np.diff(b)))
                for k in range(5):
                    columns[k].append(batch.column(k).to_numpy(zero_copy_only=False)[i : i + len(part)])
        if not found:
            return
        task, th, side, doc, is_part = map(np.concatenate, columns)
        h, w, n = (np.concatenate(x) for x in zip(*found, strict=True))
        texts = Texts(h, w, np.concatenate([[0], np.cumsum(n)]), COPY if idf is None else SIMILAR)
        order = np.lexsort((-side, th, task))
        order = order[np.append(True, (th[order][1:] != th[order][:-1]) | (task[order][1:] != task[order][:-1]))]
        edges = np.flatnonzero(np.append(True, task[order][1:] != task[order][:-1]))
        rows: list[tuple[int, int, int]] = []  # text, least text, least doc_id
        for g in np.split(order, edges[1:]):
            if side[g].any():
                partners, everyone = Partners(texts, g), np.ones(len(g), bool)
                rows += [(x, g[k], -1) for k in np.flatnonzero(side[g] == 1).tolist() for x in g[partners.of(k, everyone)].tolist()]
            else:
                for members in grown(texts, g):
                    if len(members) > 1:
                        least = members[int(np.argmin(th[members]))]
                        rows += [(x, least, int(doc[members].min())) for x in members]
        if rows:
            a, b, c = np.array(rows, np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(th[a]), pa.array(th[b]), pa.array(c), pa.array(is_part[a])], ["a", "b", "class_id", "part"])

    rows, size = wanted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    tasks = max(parts(docs.sparkSession), math.ceil(rows / GROUP), math.ceil(size / GROUP_SHINGLES))
    at_hand = _with_text(docs, wanted).select("text", "th", "task", "side", "doc_id", "part")
    return mapped(mapped(at_hand, fetch, "task long, th long, side int, doc_id long, part boolean, text string").repartition(tasks, "task"), link, "a long, b long, class_id long, part boolean")


def _across(large: DataFrame, roots: DataFrame) -> DataFrame:
    """Tasks in which the texts outside each large group's largest class meet all of its blocks.

    large: doc_id, th, n, root, cut, block; roots: v and root of the classes so far.  A text outside goes, on side 1, to a task
    for each block; every text of a block goes to a task for each portion of GROUP / 2 texts outside.
    """
    c = large.join(roots.select(F.col("v").alias("th"), F.col("root").alias("class")), "th", "left").withColumn("class", F.coalesce("class", "th"))
    c = stored(c, "op10-large")
    top = c.groupBy("root", "class").agg(F.count("*").alias("n")).groupBy("root").agg(F.max_by("class", F.struct("n", "class")).alias("main"))
    outside = c.join(top, "root").filter("class <> main")
    portions = stored(outside.groupBy("root").agg(F.ceil(F.count("*") / (GROUP // 2)).cast("int").alias("portions")), "op10-portions")
    both = c.join(portions, "root").select("doc_id", "th", "n", "root", "block", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("portion"), F.lit(0).alias("side"))
    few = outside.join(portions, "root").select("doc_id", "th", "n", "root", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)).alias("block"), F.pmod(F.xxhash64("th", F.lit(3)), "portions").cast("int").alias("portion"), F.lit(1).alias("side"))
    return both.unionByName(few).select("doc_id", "th", "n", F.xxhash64("root", "block", "portion").alias("task"), "side", F.lit(True).alias("part"))


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id of every row of docs.

    class_id is the least doc_id of the documents that links of weighted Jaccard similarity SIMILAR or more connect.
    Texts without a word (null and empty ones) are alone in their class.  Rows that repeat, also under one doc_id, each get
    their class; of rows of one doc_id with different texts each is classed by its own text.  A row without doc_id takes
    no part: null.  Texts of any length are read whole; further columns are ignored, whatever their names.
    """
    signed, named = classes(docs)
    return signed.select("doc_id", "th").join(named, "th", "left").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"))


def without_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that are left when one row of each class stays: that of the least doc_id.

    Of rows alike in doc_id and text one stays, the least by its other columns; of one doc_id's different texts each is
    judged by its own.  Texts without a word stay, once for a doc_id; rows without doc_id all stay.  Columns may have any
    names.
    """
    signed, named = classes(docs)
    rows = signed.filter("doc_id IS NOT NULL").groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.first("th").alias("th"), F.count("*").alias("copies"))
    marked = stored(rows.join(named.select("th", "root"), "th", "left").select("rid", "doc_id", "root", "copies"), "op10-marked")
    stay = marked.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "rid")).alias("one")).select("one.rid")
    out = stored(marked.filter("root IS NOT NULL").join(stay.hint("merge"), "rid", "left_anti").select("rid"), "op10-out")
    many = stored(marked.filter("copies > 1").join(out.hint("merge"), "rid", "left_anti").select("rid"), "op10-many")
    dropped(signed, named, marked)
    keyed = docs.select(F.struct(*docs.columns).alias("d"), row_id())
    left = keyed.join(out.unionByName(many).hint("merge"), "rid", "left_anti").select("d.*")
    if many.limit(1).count():
        least = F.min_by("d", F.to_json(F.struct(*(F.col("d")[c] for c in docs.columns if c != "text"))))
        left = left.unionByName(keyed.join(many.hint("merge"), "rid", "left_semi").groupBy("rid").agg(least.alias("d")).select("d.*"))
    return left


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document with its class; see near_classes() for nulls, empty tables and rows that repeat."""
    return near_classes(table(spark, "documents", sf_dir))
