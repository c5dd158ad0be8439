"""Content-sampled spans: the candidates of exact repeats of a given length.

Every window of `length` symbols owns the smallest hash among its sub-windows of `core` symbols; which one that is depends
on the window's content alone.  Consecutive windows with the same owner form a run; a run, with all symbols its windows
cover, is a span.  Equal windows have equal cores, so a window repeats only if its run's core hash occurs twice.  One
short row for each run (about one for (length - core) / 2 symbols) is all that is shuffled to find the repeats; runs of one
text that are alike, as where it repeats a word over and over, share a row.

pieces() then fetches the symbols of every span whose core recurs and deals them out in shards, in which all spans that
may hold equal windows meet.  Hashes only choose who meets; what is equal is told there, by bytes or words:

* The spans of a core go to one shard.  A core with more than `shard` of them gets several: one span of each kind (alike
  in their hashes) goes to all of these, the others to one each.
* Where a core has more than `hot` kinds, a shard is for one kind, and of each kind one span's windows are also dealt out
  one by one, by content.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, byte_symbols, dropped, in_runs, mapped, mix, parts, prefix_sums, range_hash, stored, text_buffers, word_symbols, words

#: Symbols handled at once; owners carry their place in as many low bits.
BLOCK = 1 << 19
#: at: the first start in the text times 2 ** 20, plus the number of windows; more: further starts, null if there are none.
SPAN_SCHEMA = "kh long, sh long, rid long, doc_id long, at long, more array<long>"
_N = 20


def runs_of(symbols: np.ndarray, bounds: np.ndarray, length: int, core: int) -> tuple[np.ndarray, ...]:
    """(core hash, span hash, text, start in the text, windows) of every run of texts laid end to end."""
    found: list[tuple[np.ndarray, ...]] = []
    texts, pieces, i = [], [], 0

    def flush() -> None:
        if pieces:
            found.append(_runs(symbols, np.array(texts), np.array(pieces), bounds, length, core))
            texts.clear(), pieces.clear()

    size = 0
    for i in np.flatnonzero(np.diff(bounds) >= length):
        b, e = int(bounds[i]), int(bounds[i + 1])
        while True:  # a text beyond a block is cut where windows begin, and overlaps by a window
            stop = min(e, b + BLOCK - length)
            if size and size + stop - b > BLOCK - length:
                flush()
                size = 0
            texts.append(i), pieces.append((b, stop))
            size += stop - b
            if stop == e:
                break
            b = stop - length + 1
    flush()
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (*(np.zeros(0, U64),) * 2, *(np.zeros(0, np.int64),) * 3)


def _runs(symbols: np.ndarray, texts: np.ndarray, pieces: np.ndarray, bounds: np.ndarray, length: int, core: int) -> tuple[np.ndarray, ...]:
    sizes = pieces[:, 1] - pieces[:, 0]
    at = np.concatenate([[0], np.cumsum(sizes)])
    here = np.concatenate([symbols[b:e] for b, e in pieces]) if len(pieces) > 1 else symbols[pieces[0, 0] : pieces[0, 1]]
    n, w = len(here), length - core + 1
    sums = prefix_sums(here)
    hashes = range_hash(sums, np.arange(n - core + 1), np.arange(core, n + 1))
    place = np.arange(len(hashes), dtype=U64)
    low = U64(BLOCK - 1)
    keys = (hashes & ~low) | place
    m, have = keys, 1
    while have * 2 <= w:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    if have < w:
        m = np.minimum(m[: len(m) - (w - have)], m[w - have :])
    ok = np.ones(len(m), bool)  # windows that cross texts are none
    for stop in at[1:-1]:
        ok[max(0, stop - length + 1) : stop] = False
    starts = np.flatnonzero(ok)
    owner = (m[starts] & low).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    s, a = starts[first], owner[first]
    whole = mix(range_hash(sums, s, s + count + length - 1) + (a - s).astype(U64))
    piece = np.searchsorted(at, s, "right") - 1
    text = texts[piece]
    return hashes[a], whole, text, s - at[piece] + pieces[piece, 0] - bounds[text], count


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and rid, which tells apart rows that share a doc_id; rows alike in both are one document's copies."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("rid", F.xxhash64("doc_id", "text"))


def spans(docs: DataFrame, length: int, core: int, unit: str) -> DataFrame:
    """Runs of every text as SPAN_SCHEMA; unit: bytes or words.  docs: of keyed(); a null doc_id counts as the least."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            parts = []
            for i, j in _blocks(offs):  # symbols take eight times the text's room
                some, edges = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                if unit == "bytes":
                    symbols = byte_symbols(some)
                else:
                    begin, end, edges = words(some, edges)
                    symbols = word_symbols(some, begin, end)
                k, w, t, s, n = runs_of(symbols, edges, length, core)
                parts.append((k, w, t + i, s, n))
            if parts:
                kh, sh, text, start, n = (np.concatenate(x) for x in zip(*parts, strict=True))
                ids = [pc.fill_null(batch.column(c).cast(pa.int64()), -(1 << 63)).to_numpy(zero_copy_only=False)[text] for c in (2, 0)]
                order = np.lexsort((start, sh, kh, text))
                kh, sh, text, n = kh[order], sh[order], text[order], n[order]
                new = np.ones(len(order), bool)
                new[1:] = (kh[1:] != kh[:-1]) | (sh[1:] != sh[:-1]) | (text[1:] != text[:-1])
                first = np.flatnonzero(new)
                at = (start[order][first] << _N) + n[first]
                many = np.diff(np.append(first, len(order)))
                edges = pa.array(np.concatenate([[0], np.cumsum(many - 1)]).astype(np.int32), mask=np.append(many == 1, False))
                more = pa.ListArray.from_arrays(edges, pa.array(start[order][~new]))
                yield pa.RecordBatch.from_arrays([*(pa.array(x[first]) for x in (kh.view(np.int64), sh.view(np.int64), *(i[order] for i in ids))), pa.array(at), more], ["kh", "sh", "rid", "doc_id", "at", "more"])

    return mapped(docs.select("doc_id", "text", "rid"), of, SPAN_SCHEMA)


def _blocks(offs: np.ndarray) -> list[tuple[int, int]]:
    out, i = [], 0
    while i < len(offs) - 1:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + BLOCK, "right")) - 1)
        out.append((i, j))
        i = j
    return out


def shared_only(all_spans: DataFrame) -> DataFrame:
    """The spans whose core occurs twice or more, stored.  Counts combine before the shuffle."""
    # stored, so that the join's other side can be split where a core is hot
    cores = stored(all_spans.groupBy("kh").agg(F.sum(F.when(F.col("more").isNull(), 1).otherwise(F.size("more") + 1)).alias("c")).filter("c > 1").select("kh"), "cores")
    shared = stored(all_spans.join(cores, "kh"), "shared")
    dropped(cores)
    return shared


#: starts: where in the document the piece begins; times: how many rows alike in doc_id and text hold it.
PIECES = "shard long, rid long, doc_id long, times int, starts array<long>, n int, piece binary"


def _routes(shared: DataFrame, hot: int, shard: int) -> tuple[DataFrame, int]:
    """(rid, to, n, deal, starts: a row for each span of shared and shard that it goes to; the number of spans).

    deal: whether the span's windows are also dealt out one by one: it is the first of its kind and its core is hot.
    """
    order = [c for c in ("doc_id", "rid") if c in shared.columns]
    kinds = stored(shared.groupBy("kh", "sh").agg(F.count("*").alias("rows"), F.min(F.struct(*order)).alias("one")), "kinds")
    cores = stored(kinds.groupBy("kh").agg((F.count("*") > hot).alias("hot"), F.sum("rows").alias("all")), "kinds-of-cores")
    size = cores.agg(F.sum("all")).first()[0] or 0
    rows = F.when(F.col("hot"), F.col("rows")).otherwise(F.col("all"))
    base = F.when(F.col("hot"), F.xxhash64("kh", "sh")).otherwise(F.col("kh"))
    routes = stored(kinds.join(cores, "kh").select("kh", "sh", "one", "hot", base.alias("base"), F.ceil(rows / shard).cast("int").alias("shards")), "routes")
    dropped(kinds, cores)
    out = shared.join(routes.hint("merge"), ["kh", "sh"]).withColumn("rep", F.struct(*order) == F.col("one"))
    own = F.array(F.pmod(F.xxhash64("rid", "sh"), "shards").cast("int"))
    out = out.withColumn("salt", F.explode(F.when(F.col("rep"), F.sequence(F.lit(0), F.col("shards") - 1)).otherwise(own)))
    deal = F.col("rep") & F.col("hot") & (F.col("salt") == 0)
    first, n = F.shiftright("at", _N), F.col("at").bitwiseAND((1 << _N) - 1).cast("int")
    starts = F.when(F.col("more").isNull(), F.array(first)).otherwise(F.concat(F.array(first), "more"))
    out = out.select("rid", F.xxhash64("base", "salt").alias("to"), n.alias("n"), deal.alias("deal"), starts.alias("starts"))
    out._scratch = routes._scratch
    return out, size


def pieces(docs: DataFrame, shared: DataFrame, length: int, unit: str, hot: int, shard: int) -> DataFrame:
    """PIECES of the spans in shared, dealt out by shard; docs: of keyed().  shared is deleted; dropped() takes what this stores."""
    routes, size = _routes(shared, hot, shard)
    lists = stored(routes.groupBy("rid").agg(F.collect_list(F.struct("to", "n", "deal", "starts")).alias("places")), "places")
    dropped(routes, shared)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            for i, j in _blocks(offs):
                here, edges = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                lists_ = batch.column(2).slice(i, j - i)
                flat, bounds = lists_.flatten(), lists_.offsets.to_numpy() - lists_.offsets[0].as_py()
                to, n, deal = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("to", "n", "deal"))
                starts, first = flat.field("starts").values.to_numpy(), flat.field("starts").offsets.to_numpy()
                row = np.repeat(np.arange(j - i), np.diff(bounds))
                if unit == "bytes":
                    begin, end, at = np.arange(len(here)), np.arange(1, len(here) + 1), edges
                else:
                    begin, end, at = words(here, edges)
                # a place that came more than once is of rows that repeat
                order = np.lexsort((n, starts[first[:-1]], to, row))
                key = [x[order] for x in (row, to, starts[first[:-1]], n)]
                new = np.append(True, np.logical_or.reduce([x[1:] != x[:-1] for x in key]))[: len(order)]
                head = np.flatnonzero(new)
                keep, times = order[head], np.diff(np.append(head, len(order)))
                ids = [batch.column(c).slice(i, j - i) for c in (0, 3)]
                for a in range(0, len(keep), 5_000):
                    some = keep[a : a + 5_000]
                    yield from _cut(here, begin, end, at, row[some], to[some], n[some], times[a : a + 5_000], starts, first[some], first[some + 1], length, ids)
                dealt = np.flatnonzero(deal[keep])
                for a in range(0, len(dealt), 100):
                    some, m = keep[dealt[a : a + 100]], times[dealt[a : a + 100]]
                    many = n[some]
                    which = np.repeat(np.arange(len(some)), many)
                    lists__ = [starts[x:y] for x, y in zip(first[some], first[some + 1], strict=True)]
                    moved = [lists__[w] + o for w, o in zip(which.tolist(), in_runs(many).tolist(), strict=True)]
                    ends = np.cumsum([0, *map(len, moved)])
                    yield from _cut(here, begin, end, at, row[some][which], None, np.ones(len(which), np.int32), m[which], np.concatenate(moved), ends[:-1], ends[1:], length, ids)

    at_hand = docs.select("rid", "text", "doc_id").join(lists.hint("merge"), "rid").select("rid", "text", "places", "doc_id")
    # stored, so that the texts' shuffle is gone before that of the pieces begins
    at_shards = stored(mapped(at_hand, cut, PIECES), "pieces")
    dropped(lists)
    out = at_shards.repartition(max(parts(docs.sparkSession), math.ceil(size / shard)), "shard")
    out._scratch = at_shards._scratch
    return out


def _cut(data, begin, end, at, row, to, n, times, starts, lo, hi, length, ids) -> Iterator[pa.RecordBatch]:
    """PIECES of places: a row, n windows from each of starts[lo:hi]; to: their shards, or none if their content tells."""
    if not len(row):
        return
    one = at[row] + starts[lo]
    b, e = begin[one], end[one + n + length - 2]
    size = e - b
    raw = data[np.repeat(b, size) + in_runs(size)]
    offsets = np.concatenate([[0], np.cumsum(size)])
    if to is None:
        to = np.array([_digest(raw[x:y].tobytes()) for x, y in zip(offsets[:-1], offsets[1:], strict=True)], np.int64)
    several = np.flatnonzero(hi - lo > 1)
    pieces_ = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])
    counts = hi - lo
    every = starts[np.repeat(lo, counts) + in_runs(counts)]
    for k in several.tolist():  # the hashes say that the others are alike: their symbols tell
        if any(_symbols(data, begin, end, at[row[k]] + s, n[k] + length - 1) != _symbols(data, begin, end, one[k], n[k] + length - 1) for s in starts[lo[k] + 1 : hi[k]].tolist()):
            raise ValueError("two spans of one text share both hashes but not their symbols")
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(every))
    take = pa.array(row)
    columns = [pa.array(to), ids[0].take(take), ids[1].take(take), pa.array(times.astype(np.int32)), lists, pa.array(n.astype(np.int32)), pieces_]
    yield pa.RecordBatch.from_arrays(columns, ["shard", "rid", "doc_id", "times", "starts", "n", "piece"])


def _symbols(data: np.ndarray, begin: np.ndarray, end: np.ndarray, a: int, size: int) -> list[bytes]:
    return data[begin[a] : end[a + size - 1]].tobytes().split() if end[a] - begin[a] > 1 or size > 1 else [data[a : a + 1].tobytes()]


def _digest(window: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b" ".join(window.split()), digest_size=8).digest(), "big", signed=True)


class Shard:
    """The pieces of a task: each different one once, and the rows that hold it.

    by_shard: pieces of different shards differ, whatever they hold.  A place that came twice counts once.
    """

    def __init__(self, batches: Iterator[pa.RecordBatch], by_shard: bool) -> None:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            self.entry = np.zeros(0, np.int64)
            return
        t = pa.Table.from_batches(rows).combine_chunks()
        shard, rid, count = (t[k].to_numpy() for k in ("shard", "rid", "n"))
        shard = shard if by_shard else np.zeros(len(t), np.int64)
        lists = t["starts"].chunk(0)
        starts, edges = lists.values.to_numpy(), lists.offsets.to_numpy()
        content = t["piece"].chunk(0).dictionary_encode()
        order = np.lexsort((count, starts[edges[:-1]], rid, shard))
        key = [x[order] for x in (shard, rid, starts[edges[:-1]], count)]
        keep = np.sort(order[np.append(True, np.logical_or.reduce([x[1:] != x[:-1] for x in key]))])
        codes = content.indices.to_numpy()[keep]
        order = np.lexsort((codes, shard[keep]))
        a, c = shard[keep][order], codes[order]
        new = np.append(True, (a[1:] != a[:-1]) | (c[1:] != c[:-1]))
        self.entry = np.empty(len(keep), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        some = keep[order[new]]
        self.pieces: list[bytes] = t["piece"].take(pa.array(some)).to_pylist()
        self.shards, self.n = shard[some], count[some].astype(np.int64)
        self.rid, self.doc = rid[keep], t["doc_id"].fill_null(-(1 << 63)).to_numpy()[keep]
        self.times = t["times"].to_numpy()[keep].astype(np.int64)
        self.first, self.how_many = starts[edges[:-1]][keep], np.diff(edges)[keep]
        self.starts = starts[np.repeat(edges[:-1][keep], self.how_many) + in_runs(self.how_many)]

    def ranges(self, row: np.ndarray, start: np.ndarray, bounds: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
        """RANGES for occurrences (row, start) of entries, whose offsets are begin to stop; bounds: where each entry's are."""
        e = self.entry[row]
        many = bounds[e + 1] - bounds[e]
        at = np.repeat(bounds[e], many) + in_runs(many)
        start = np.repeat(start, many)
        return pa.RecordBatch.from_arrays([pa.array(self.rid[np.repeat(row, many)]), pa.array(start + begin[at]), pa.array(start + stop[at])], ["rid", "begin", "stop"])

    def occurrences(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, start, whether it is the row's first) of all."""
        return np.repeat(np.arange(len(self.entry)), self.how_many), self.starts, in_runs(self.how_many) == 0


def runs_in(entry: np.ndarray, offset: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds by entry, begin, stop) of runs of offsets, which are in order of entry and offset, each once."""
    new = np.ones(len(entry), bool)
    new[1:] = (entry[1:] != entry[:-1]) | (offset[1:] != offset[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(entry)) - 1 if len(at) else at
    return np.searchsorted(entry[at], np.arange(entries + 1)), offset[at].astype(np.int64), offset[last].astype(np.int64) + 1
