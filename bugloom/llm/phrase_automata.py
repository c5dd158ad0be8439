"""Removal of repeated passages, located by sharded Aho-Corasick automata.

1. Content-sampled spans (spans.py) of the word sequence of every text; only spans whose core recurs go on.
2. Their words go to shards, in which all spans that may hold equal windows meet.  A shard picks the word windows that seem
   to recur, by their hashes, compiles one automaton of these phrases over word numbers, and streams all of its spans
   through it, which locates every occurrence by its words.
3. Of the occurrences of a phrase all but the earliest are repeats.

Every part of a document that can hold a repeat is streamed, to the shard of its core, so automata and streams grow in
proportion to the corpus rather than every document meeting every automaton.  Spans of equal words are streamed once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, dropped, in_runs, mapped, mix, prefix_sums, range_hash, stored, table, text_buffers
from .spans import Shard, keyed, pieces, runs_in, shared_only, spans
from .suffix_dedup import RANGES, covered

LENGTH = 20
CORE = 6
#: Kinds of spans of one core beyond which its windows are dealt out one by one, and spans in a shard.
HOT_CORE = 5_000
SHARD = 5_000


def automaton(phrases: list[tuple[int, ...]]) -> ahocorasick.Automaton:
    """Finds each phrase, by its number, in a sequence of word numbers."""
    a = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for i, phrase in enumerate(phrases):
        a.add_word(phrase, i)
    a.make_automaton()
    return a


def located(texts: list[bytes], counts: np.ndarray, often: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, offset, phrase) of every window of `length` words that recurs, in order of text and offset; alike windows have one phrase.

    counts: the windows of each text; often: texts that stand in many places, so all their windows recur.  A passage of
    such a text is one phrase of the automaton from end to end, if none of its windows seems to stand in another text.
    """
    numbers: dict[bytes, int] = {}
    words = [[numbers.setdefault(w, len(numbers)) for w in t.split()] for t in texts]
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter((w for t in words for w in t), np.int64, int(size.sum()))
    sums = prefix_sums(mix(flat.astype(U64) + U64(1)))
    first = np.concatenate([[0], np.cumsum(counts)])
    text, offset = np.repeat(np.arange(len(texts)), counts), in_runs(counts)
    begin = np.concatenate([[0], np.cumsum(size)])[text] + offset
    _, one, which, n = np.unique(range_hash(sums, begin, begin + length), return_index=True, return_inverse=True, return_counts=True)
    alone = np.bincount(text, n[which] > 1, len(texts)) == 0
    passages = np.flatnonzero(often & alone)
    seen = n.copy()
    seen[which[often[text]]] += 1
    windows = one[(seen > 1) & ~(often & alone)[text[one]]]
    phrases = [tuple(words[text[i]][offset[i] : offset[i] + length]) for i in windows.tolist()] + [tuple(words[i]) for i in passages.tolist()]
    if not phrases:
        return (np.zeros(0, np.int64),) * 3
    find = automaton(phrases)
    hits = np.array([(i, end, p) for i, t in enumerate(words) for end, p in find.iter(tuple(t))], np.int64).reshape(-1, 3)
    whole = hits[:, 2] >= len(windows)
    i, end, p = hits[~whole].T
    where, until, passage = hits[whole].T
    # a passage's windows: numbered after the windows that are phrases of their own
    passage = passages[passage - len(windows)]
    many = counts[passage]
    begin = until - size[passage] + 1
    runs = in_runs(many)
    found = [np.concatenate(x) for x in ((i, np.repeat(where, many)), (end - length + 1, np.repeat(begin, many) + runs), (p, len(windows) + first[np.repeat(passage, many)] + runs))]
    # a passage may repeat a window within itself, and be told by several phrases
    order = np.lexsort((found[2], found[1], found[0]))
    i, o, p = (x[order] for x in found)
    new = np.append(True, (i[1:] != i[:-1]) | (o[1:] != o[:-1]))[: len(order)]
    return i[new], o[new], p[new]


def repeated_ranges(docs: DataFrame, length: int = LENGTH, core: int = CORE, hot: int = HOT_CORE, shard: int = SHARD) -> DataFrame:
    """RANGES of the word windows (starts begin to stop - 1) that also stand earlier, stored; docs of keyed()."""
    sampled = stored(spans(docs, length, core, "words"), "op7-spans")
    shared = shared_only(sampled)
    dropped(sampled)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Shard(batches, by_shard=False)
        if not len(s.entry):
            return
        often = np.bincount(s.entry, s.how_many, len(s.pieces)) > 1
        text, offset, phrase = located(s.pieces, s.n, often, length)
        # the earliest row of each piece, and of these the earliest occurrence of each phrase
        order = np.lexsort((s.first, s.rid, s.doc, s.entry))
        lead = order[np.append(True, s.entry[order][1:] != s.entry[order][:-1])]
        doc, rid, at = s.doc[lead][text], s.rid[lead][text], s.first[lead][text] + offset
        order = np.lexsort((at, rid, doc, phrase))
        new = np.append(True, phrase[order][1:] != phrase[order][:-1])[: len(order)]
        group, head = np.cumsum(new) - 1, order[new]
        earliest = np.empty(len(order), bool)
        # a span may have come by several shards: the same place is as early
        earliest[order] = (doc[order] == doc[head][group]) & (rid[order] == rid[head][group]) & (at[order] == at[head][group])
        row, start, is_first = s.occurrences()
        leads = np.zeros(len(s.entry), bool)
        leads[lead] = True
        first = leads[row] & is_first
        yield s.ranges(row[~first], start[~first], *runs_in(text, offset, len(s.n)))
        yield s.ranges(row[first], start[first], *runs_in(text[~earliest], offset[~earliest], len(s.n)))

    dealt = pieces(docs, shared, length, "words", hot, shard)
    found = stored(mapped(dealt, search, RANGES), "op7-ranges")
    dropped(dealt)
    return found


def cleaned(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, text, begins and stops of the word windows to remove (null: none)."""
    docs = keyed(docs)
    lists = repeated_ranges(docs, length).groupBy("rid").agg(F.collect_list("begin").alias("begins"), F.collect_list("stop").alias("stops"))
    return docs.join(lists.hint("merge"), "rid", "left").select("doc_id", "text", "begins", "stops")


def op7_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents without each word that a 20-word window covers which also starts earlier.

    Null, empty and short texts: nothing removed.  Earlier: at a smaller doc_id (null is the least), or in the same
    document further left; rows alike in doc_id and text are one document; further columns are ignored.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            begins, stops = (x.values.to_numpy(zero_copy_only=False) for x in (batch.column(2), batch.column(3)))
            edges, valid = batch.column(2).offsets.to_numpy(), batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            total, removed, sha = [], [], []
            for i in range(batch.num_rows):
                text = data[offs[i] : offs[i + 1]].tobytes().split()
                kept = text
                if valid[i]:
                    kept, last = [], 0
                    for b, e in covered(begins[edges[i] : edges[i + 1]], stops[edges[i] : edges[i + 1]], LENGTH).tolist():
                        kept += text[last:b]
                        last = e
                    kept += text[last:]
                total.append(len(text)), removed.append(len(text) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return mapped(cleaned(table(spark, "documents", sf_dir)), digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")
