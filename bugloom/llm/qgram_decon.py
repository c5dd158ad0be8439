"""Benchmark decontamination by the q-gram lemma.

A stretch of text within `budget` edits of a benchmark passage of m characters shares at least m + 1 - q (budget + 1)
q-grams with it, on diagonals (place in the text less place in the passage) at most `budget` apart.  Shared q-grams are
counted in bands of diagonals that overlap by half, so that one band holds all diagonals of a match; bands that reach the
bound are verified by an alignment confined to their diagonals.

The benchmark is the stated query set: it is taken in blocks of BLOCK characters, each shipped to the tasks, and every
document is scanned against each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, in_runs, mapped, mix, prefix_sums, range_hash, table
from .textstats import blocks

Q = 12
EDIT_RATE = 0.06
#: Longer benchmark texts count by passages of this many characters, each half-way over the one before.
PASSAGE = 240
BLOCK = 4_000_000
SIEVE = 1 << 22

SCHEMA = "doc_id long, item_id long, passage int, begin long, stop long, edits int"


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with white space runs as one space, and the place of each in the text.

    Characters whose lower case is several characters stay as they are, so places remain those of the text.
    """
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    x = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = ((x <= 0x20) & ((x == 0x20) | ((x >= 9) & (x <= 13)) | ((x >= 0x1C) & (x <= 0x1F)))) | (x == 0x85) | (x == 0xA0) | ((x >= 0x2000) & (x <= 0x200A)) | (x == 0x2028) | (x == 0x2029) | (x == 0x202F) | (x == 0x3000)
    keep = ~space
    keep[1:] |= ~space[:-1]
    at = np.flatnonzero(keep)
    x = np.where(space, np.uint32(0x20), x)[at]
    lead, tail = (1 if len(x) and x[0] == 0x20 else 0), (1 if len(x) > 1 and x[-1] == 0x20 else 0)
    return x[lead : len(x) - tail], at[lead : len(at) - tail]


class Passages:
    """The q-grams of a block of benchmark passages."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.item, self.number, self.text = [], [], []
        for item, text in items:
            x = normalised(text or "")[0]
            begins = [0] if len(x) <= PASSAGE else [*range(0, len(x) - PASSAGE, PASSAGE // 2), len(x) - PASSAGE]
            for k, b in enumerate(begins):
                if len(x) >= Q:  # shorter ones hold no q-gram and match nothing
                    self.item.append(item), self.number.append(k), self.text.append(x[b : b + PASSAGE])
        self.size = np.array([len(x) for x in self.text], np.int64)
        self.budget = np.minimum((EDIT_RATE * self.size).astype(np.int64), self.size // Q - 1)
        self.least = self.size + 1 - Q * (self.budget + 1)
        n = self.size - Q + 1
        grams = np.concatenate([grams_of(x) for x in self.text]) if self.text else np.zeros(0, U64)
        order = np.argsort(grams, kind="stable")
        self.owner, self.place = np.repeat(np.arange(len(n)), n)[order], in_runs(n)[order]
        self.grams, self.first = np.unique(grams[order], return_index=True)
        self.first = np.append(self.first, len(grams))
        self.sieve = np.zeros(SIEVE, bool)
        self.sieve[(self.grams & U64(SIEVE - 1)).astype(np.int64)] = True


def grams_of(x: np.ndarray) -> np.ndarray:
    sums = prefix_sums(mix(x.astype(U64) + U64(1)))
    return range_hash(sums, np.arange(len(x) - Q + 1), np.arange(Q, len(x) + 1)) if len(x) >= Q else np.zeros(0, U64)


#: Shared q-grams, once for each passage that holds one, that are at hand at a time.
AT_HAND = 1 << 21


def bands(x: np.ndarray, bounds: np.ndarray, p: Passages) -> np.ndarray:
    """Rows (text, passage, first diagonal) of the bands that share enough q-grams; x: texts end to end.

    A q-gram that many passages hold is worked through in parts, whose counts by band are added up.
    """
    grams = grams_of(x)
    maybe = np.flatnonzero(p.sieve[(grams & U64(SIEVE - 1)).astype(np.int64)])
    k = np.searchsorted(p.grams, grams[maybe])
    hit = k < len(p.grams)
    hit[hit] = p.grams[k[hit]] == grams[maybe[hit]]
    at, k = maybe[hit], k[hit]
    most = len(x) + 2 * PASSAGE + 8  # bands of a text are fewer
    keys, count, a = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    total = np.concatenate([[0], np.cumsum(p.first[k + 1] - p.first[k])])
    while a < len(k):
        b = max(a + 1, int(np.searchsorted(total, total[a] + AT_HAND, "right")) - 1)
        row, band = _hits(at[a:b], k[a:b], bounds, p)
        every, which = np.unique(np.concatenate([keys, row * most + band, row * most + band - 1]), return_inverse=True)
        count = np.bincount(which, np.concatenate([count, np.ones(2 * len(row))]), len(every)).astype(np.int64)
        keys, a = every, b
    row, band = keys // most, keys % most
    text, owner = row // max(len(p.size), 1), row % max(len(p.size), 1)
    enough = count >= p.least[owner]
    text, owner, band = text[enough], owner[enough], band[enough]
    wide = p.budget[owner] + 1
    return np.stack([text, owner, (band - PASSAGE // wide - 2) * wide], axis=1)


def _hits(at: np.ndarray, k: np.ndarray, bounds: np.ndarray, p: Passages) -> tuple[np.ndarray, np.ndarray]:
    """(text and passage in one number, band) of each shared q-gram, for each passage that holds it."""
    n = p.first[k + 1] - p.first[k]
    e, at = np.repeat(p.first[k], n) + in_runs(n), np.repeat(at, n)
    text = np.searchsorted(bounds, at, "right") - 1
    inside = at + Q <= bounds[text + 1]
    at, e, text = at[inside], e[inside], text[inside]
    owner = p.owner[e]
    wide = p.budget[owner] + 1
    base = PASSAGE // wide + 2  # keeps bands positive
    return text * len(p.size) + owner, (at - bounds[text] - p.place[e]) // wide + base


def aligned(x: np.ndarray, passage: np.ndarray, first: int, width: int) -> tuple[int, int, int]:
    """(edits, begin, stop) of the best alignment of the whole passage with part of x on diagonals first .. first + width - 1."""
    inf = np.int32(1 << 20)
    d = np.arange(width)
    pos = first + d  # place in x before the next character, at row 0
    cost = np.where((pos >= 0) & (pos <= len(x)), 0, inf).astype(np.int32)
    begin = pos.copy()
    for c in passage:
        inside = (pos >= 0) & (pos < len(x))
        match = np.zeros(width, bool)
        match[inside] = x[pos[inside]] == c
        over = cost + np.where(inside, np.where(match, 0, 1), inf)  # same diagonal: match or substitution
        gone = np.append(cost[1:] + 1, inf)  # character of the passage missing in x: one diagonal down
        src = np.where(over <= gone, begin, np.append(begin[1:], 0))
        new = np.minimum(over, gone)
        run = np.minimum.accumulate(new - d)  # characters of x that the passage lacks: diagonals up
        from_ = np.maximum.accumulate(np.where(new - d == run, d, 0))
        cost, begin = np.minimum(run + d, inf).astype(np.int32), src[from_]
        pos = pos + 1
        cost[(pos < 0) | (pos > len(x))] = inf
    k = int(np.argmin(cost))
    return int(cost[k]), int(begin[k]), int(pos[k])


def matches(data: np.ndarray, offs: np.ndarray, p: Passages) -> list[tuple[int, int, int, int, int, int]]:
    """(text, item, passage, begin, stop, edits): for each text and passage the alignment with the fewest edits, the leftmost of those."""
    texts = [normalised(data[a:b].tobytes().decode("utf-8", "replace")) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
    if not texts or not len(p.size):
        return []
    bounds = np.cumsum([0, *(len(t[0]) for t in texts)])
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for text, owner, first in bands(np.concatenate([t[0] for t in texts]), bounds, p).tolist():
        x, at = texts[text]
        budget = int(p.budget[owner])
        lo = max(0, first - budget)
        hi = min(len(x), first + 3 * (budget + 1) + len(p.text[owner]) + budget)
        edits, b, e = aligned(x[lo:hi], p.text[owner], first - lo, 2 * (budget + 1))
        if edits <= budget:
            found = (edits, int(at[lo + b]), int(at[lo + e - 1]) + 1)
            best[text, owner] = min(found, best.get((text, owner), found))
    return [(t, p.item[o], p.number[o], b, e, k) for (t, o), (k, b, e) in sorted(best.items())]


def query_blocks(benchmark: DataFrame) -> Iterator[Passages]:
    """The benchmark in blocks of at most BLOCK characters and an item; a null item_id or text counts for nothing."""
    some, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL").distinct().orderBy("item_id", "text").toLocalIterator():
        some.append((r.item_id, r.text))
        size += len(r.text)
        if size >= BLOCK:
            yield Passages(some)
            some, size = [], 0
    if some:
        yield Passages(some)


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """SCHEMA: for each document and benchmark passage found in it, where (characters of the text) and with how many edits.

    Null and empty texts and items match nothing, nor do empty tables; each of several like rows is reported, equal items
    count once; a null doc_id stays null.  Texts of any length are read whole; further columns are ignored, whatever their
    names.
    """

    def scan(p: Passages):
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, data, offs in blocks(batch.column(1)):
                    if found := matches(data, offs, p):
                        text, *rest = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text, pa.int64()) if not i else pc.add(pa.array(text, pa.int64()), i)), *(pa.array(c, k) for c, k in zip(rest, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()), strict=True))], ["doc_id", "item_id", "passage", "begin", "stop", "edits"])

        return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), of, SCHEMA)

    out = None
    for p in query_blocks(benchmark):
        out = scan(p) if out is None else out.unionByName(scan(p))
    return docs.sparkSession.createDataFrame([], SCHEMA) if out is None else out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that hold no benchmark passage; null and empty texts and rows that repeat stay."""
    at = docs.columns.index("text")

    def without(p: Passages):
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for i, data, offs in blocks(batch.column(at)):
                    keep[[i + m[0] for m in matches(data, offs, p)]] = False
                yield batch.filter(pa.array(keep))

        return of

    schema = docs.schema
    for p in query_blocks(benchmark):
        docs = mapped(docs, without(p), schema)
    return docs


def op8_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage found in documents; see contaminations() for nulls, empty tables and rows that repeat."""
    return contaminations(table(spark, "documents", sf_dir), table(spark, "benchmark", sf_dir))
