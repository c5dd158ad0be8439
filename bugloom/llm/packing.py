"""Packing of tokenised examples into sequences under simultaneous limits.

An example takes tokens, one segment and its loss-bearing tokens from a sequence's room: all but its first token, or, for
instruction data, the response at its end, whose length a column names.  The dot-product heuristic fills one sequence
after another, each time with the example that fits and has the largest inner product of its demand and the room left,
both as shares of the limits.  Where all of an example but one token bears loss, as in documents, the limits are collinear
and the heuristic packs by length.  Each task packs what it reads, so nothing is shuffled and a task holds at most
FLUSH tokens.  A sequence that no example fits any more and that is less than FULL full is cut at powers of two.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_runs, mapped, table, word_symbols, words
from .textstats import blocks

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
TOKENS = 2048
#: Limits of a sequence: tokens, segments, tokens that bear loss (all but the first of a segment).
LIMITS = (TOKENS, 256, TOKENS)
FLUSH = 1 << 22
FULL = 0.97
#: Different words whose ids a task keeps at once.
CACHE = 1 << 21

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def dot_product_pack(demand: np.ndarray, limits: tuple[int, ...] = LIMITS) -> list[list[int]]:
    """Sequences as lists of example numbers; demand: a row for each example, none above the limits.

    Examples alike in demand are alike to the heuristic, so it looks at the different rows only; ties go to the larger
    demand, then to the example that came first.
    """
    if (demand > np.array(limits)).any():
        raise ValueError("an example is above the limits")
    kinds, which = np.unique(demand, axis=0, return_inverse=True)
    which = which.ravel()
    waiting = [[] for _ in kinds]
    for i in range(len(demand) - 1, -1, -1):
        waiting[which[i]].append(i)
    left = np.array([len(w) for w in waiting])
    shares, total, out = kinds / np.array(limits), int(left.sum()), []
    while total:
        room, one = np.array(limits), []
        alive = np.flatnonzero(left)
        while True:
            alive = alive[(left[alive] > 0) & (kinds[alive] <= room).all(1)]
            if not len(alive):
                break
            gain = shares[alive] @ (room / np.array(limits))
            k = alive[len(gain) - 1 - int(np.argmax(gain[::-1]))]
            one.append(waiting[k].pop())
            left[k] -= 1
            total -= 1
            room = room - kinds[k]
        out.append(one)
    return out


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[range(65, 91)] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"]] = True  # without ' and <, which begin contractions and special tokens
_NEXT = np.zeros(256, bool)  # after C3: Latin letters with accents
_NEXT[[x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7)]] = True


def pieces(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begin, end, bounds, plain): parts of words that the vocabulary's splitting keeps apart.

    Words of Latin letters and ASCII marks are put in lower case and cut between letters and marks, as the vocabulary does:
    their parts are plain, one unit each.  All other words stay whole and as they are.
    """
    begin, end, bounds = words(data, offs)
    pair = np.zeros(len(data), bool)
    if len(data):
        pair[:-1] = (data[:-1] == 0xC3) & _NEXT[data[1:]]
    after = np.append(False, pair[:-1])
    letter = _LETTER[data] | pair | after
    odd = np.concatenate([[0], np.cumsum(~(letter | _MARK[data]))])
    plain = odd[end] == odd[begin]
    step = np.zeros(len(data) + 1, np.int8)
    step[begin[plain]] += 1
    step[end[plain]] -= 1
    inside = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
    upper = inside & (_UPPER[data] | (after & (data <= 0x9E)))
    data = data + np.where(upper, np.uint8(0x20), np.uint8(0))
    cut = np.flatnonzero(inside[1:] & inside[:-1] & (letter[1:] != letter[:-1])) + 1
    begin, end = np.sort(np.concatenate([begin, cut])), np.sort(np.concatenate([end, cut]))
    return data, begin, end, np.searchsorted(begin, offs), inside[begin] if len(begin) else np.zeros(0, bool)


class Ids:
    """Token ids of words, found once for each different part of a word; a text's ids are those of its parts."""

    def __init__(self, vocabulary: str, end: int) -> None:
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.end = end
        self.last = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.clear()

    def units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, how many for each text) of plain parts: a unit's last id, and no other, ends a word."""
        flat = np.array([t for x in self.tokenizer.encode_batch_fast([" ".join(texts[i : i + 2000]) for i in range(0, len(texts), 2000)], add_special_tokens=False) for t in x.ids], np.uint32)
        ends = np.flatnonzero(self.last[flat])
        if len(ends) != len(texts):  # not such a vocabulary
            return self.each(texts)
        return flat, np.diff(ends, prepend=-1)

    def each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([t for x in found for t in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def clear(self) -> None:
        """Entry 0 is the id that ends a text."""
        self.hashes, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.first = np.array([self.end], np.uint32), np.array([0, 1])

    def __call__(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, each with the end id; bounds)."""
        data, begin, end, bounds, plain = pieces(data, offs)
        new, one, back = np.unique(word_symbols(data, begin, end), return_index=True, return_inverse=True)
        if len(self.hashes) + len(new) > CACHE:
            self.clear()
        at = np.minimum(np.searchsorted(self.hashes, new), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == new if len(self.hashes) else np.zeros(len(new), bool)
        if not known.all():
            fresh = one[~known]
            kind = plain[fresh]
            raw = data.tobytes()
            for which, ids_of in ((kind, self.units), (~kind, self.each)):
                mine = fresh[which]
                flat, n = ids_of([raw[b:e].decode() for b, e in zip(begin[mine].tolist(), end[mine].tolist(), strict=True)])
                entries = np.arange(len(mine)) + len(self.first) - 1
                self.flat = np.concatenate([self.flat, flat])
                self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(n)])
                every, e = np.concatenate([self.hashes, new[~known][which]]), np.concatenate([self.entry, entries])
                order = np.argsort(every)
                self.hashes, self.entry = every[order], e[order]
        entry = self.entry[np.searchsorted(self.hashes, new)][back.ravel()] if len(new) else np.zeros(0, np.int64)
        entry = np.insert(entry, bounds[1:], 0)
        n = self.first[entry + 1] - self.first[entry]
        flat = self.flat[np.repeat(self.first[entry], n) + in_runs(n)]
        sums = np.concatenate([[0], np.cumsum(n)])
        return flat, sums[bounds + np.arange(len(bounds))]


def powers_of_two(n: int) -> list[int]:
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


class Packer:
    """Takes documents' ids, gives rows of SCHEMA."""

    def __init__(self, first_sequence: int, limits: tuple[int, ...] = LIMITS) -> None:
        self.limits, self.next = limits, first_sequence
        self.held: list[tuple[int | None, int, int, np.ndarray, int]] = []  # doc_id, start, doc_tokens, ids, tokens that bear loss
        self.size, self.rows = 0, []

    def row(self, doc: int | None, start: int, total: int, ids: np.ndarray, offset: int) -> None:
        self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next, offset))

    def add(self, doc: int | None, ids: np.ndarray, loss: int | None = None) -> None:
        """Whole sequences leave at once, other parts wait.  loss: how many tokens at the end bear it; null: all but the first of a part."""
        n, a = len(ids), 0
        quiet = None if loss is None else n - min(max(loss, 0), n)  # the first place that bears loss
        while a < n:
            most = self.limits[0] if quiet is not None else min(self.limits[0], self.limits[2])
            stop = min(n, a + most) if quiet is None else min(n, a + most, max(a, quiet) + self.limits[2])
            if stop - a == self.limits[0]:
                self.row(doc, a, n, ids[a:stop], 0)
                self.next += 1
            else:
                self.held.append((doc, a, n, ids[a:stop].copy(), stop - a - 1 if quiet is None else max(0, stop - max(a, quiet))))
                self.size += stop - a
            a = stop
        if self.size >= FLUSH:
            self.flush()

    def flush(self) -> None:
        n = np.array([len(x[3]) for x in self.held], np.int64)
        loss = np.array([x[4] for x in self.held], np.int64)
        for members in dot_product_pack(np.stack([n, np.ones_like(n), loss], axis=1), self.limits) if len(n) else []:
            size = int(n[members].sum())
            ends = np.cumsum([size] if size >= FULL * self.limits[0] else powers_of_two(size)).tolist()
            at, begun = 0, 0  # ids so far, and where the sequence began
            for doc, start, total, ids, _ in (self.held[i] for i in members):
                a = 0
                while a < len(ids):
                    step = min(len(ids) - a, ends[0] - at)
                    self.row(doc, start + a, total, ids[a : a + step], at - begun)
                    a, at = a + step, at + step
                    if at == ends[0]:
                        begun = ends.pop(0)
                        self.next += 1
        self.held, self.size = [], 0

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * 7
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def packed(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END_ID, limits: tuple[int, ...] = LIMITS, loss: str | None = None) -> DataFrame:
    """SCHEMA for docs (doc_id, text).  loss: the column with the number of tokens at an example's end that bear loss (null: all but the first)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer = Ids(vocabulary, end), Packer(TaskContext.get().partitionId() << 33, limits)
        for batch in batches:
            for i, data, offs in blocks(batch.column(1)):
                flat, bounds = tokens(data, offs)
                some = batch.column(2).slice(i, len(offs) - 1).to_pylist()
                for k, doc in enumerate(batch.column(0).slice(i, len(offs) - 1).to_pylist()):
                    packer.add(doc, flat[bounds[k] : bounds[k + 1]], some[k])
                if packer.rows:
                    yield packer.batch()
        packer.flush()
        if packer.rows:
            yield packer.batch()

    bearing = F.lit(None).cast("int") if loss is None else F.col(loss).cast("int")
    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", bearing.alias("loss")), of, SCHEMA)


def op3_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each piece of each document.

    Null and empty texts are the end id alone; each of several like rows is packed; a null doc_id stays null; further
    columns are ignored.
    """
    return packed(table(spark, "documents", sf_dir))
