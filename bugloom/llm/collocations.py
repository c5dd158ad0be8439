"""Phrase collocation mining: frequent words as ids, id n-grams as fixed-width keys, range partitions, radix sort, run lengths.

Texts are cut into words once, in Arrow buffers, and kept as segments: a dictionary of distinct words and a code for each
word.  Words that occur `least` times in their language get ids; all others break a piece, since no frequent phrase holds
one.  At each place the next five ids make one key, zero after the piece's end.  Keys are counted within a segment, dealt
to ranges, radix-sorted and counted by run length for two to five ids at once.  A run at the border of a range is summed
with its other parts, so neither a frequent word nor a frequent pair meets in one task: only equal keys do, and each
segment sends a key once.

Ties, nulls and odd tables: a null text is empty, a null lang is `und` (as is a lang of that name); repeated rows count
as often as they stand there; texts of any length are cut into segments between texts, never within one; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import dropped, mapped, parts, stored, table, text_buffers

#: Words of the longest phrase, least occurrences, rows of each language.
LONGEST, LEAST, TOP = 5, 100, 2000
#: Bytes of text in a segment, keys in a range, sampled keys for each border of ranges.
SEGMENT, RANGE, SAMPLES = 1 << 23, 1 << 20, 16
#: Beyond so many words the dictionary is joined by a shuffle.
BROADCAST_WORDS = 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BLANK[[0x20, 0x09]] = True


def word_codes(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(codes, words, counts): for each word 1 + its place in words, 0 wherever a piece ends."""
    data, offs = text_buffers(texts)
    data = _LOWER[data]
    solid = ~(_BREAK | _BLANK)[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    begin = np.flatnonzero(solid & (~np.append(False, solid[:-1])[: len(data)] | edge[:-1]))
    end = np.flatnonzero(solid & (~np.append(solid[1:], False)[: len(data)] | edge[1:])) + 1
    ends = np.zeros(len(data) + 1, np.int32 if len(data) < 1 << 31 else np.int64)
    np.cumsum(_BREAK[data] | edge[:-1], out=ends[1:])  # breaks and beginnings of texts before a byte
    new = np.append(True, ends[begin[1:] + 1] != ends[end[:-1]])[: len(begin)]
    starts = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(starts), pa.py_buffer(data[solid])]).dictionary_encode()
    at = np.asarray(words.indices).astype(np.int32)
    codes = np.zeros(len(at) + int(new.sum()), np.int32)
    codes[np.arange(len(at)) + np.cumsum(new)] = at + 1
    return codes, words.dictionary.cast(pa.large_string()), np.bincount(at, minlength=len(words.dictionary))


def _list(values: pa.Array, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind))


def segments(docs: DataFrame) -> DataFrame:
    """A row for each segment and language: seg, lang, n_words, codes, words, counts."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal n
            rows = pa.Table.from_batches(held).combine_chunks()
            langs = pc.fill_null(rows["lang"], "und").combine_chunks()
            for lang in pc.unique(langs).to_pylist():
                codes, words, counts = word_codes(rows["text"].filter(pc.equal(langs, lang)).combine_chunks())
                columns = [pa.array([(task << 32) + n]), pa.array([lang]), pa.array([int(counts.sum())]), pa.array([codes.tobytes()]), _list(words, pa.string()), _list(pa.array(counts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["seg", "lang", "n_words", "codes", "words", "counts"])
                n += 1

        for batch in batches:
            ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0)))
            i = 0
            while i < batch.num_rows:
                before = ends[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(ends, before + SEGMENT, "right")))
                held.append(batch.slice(i, j - i))
                size += int(ends[j - 1] - before)
                i = j
                if size >= SEGMENT:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    return mapped(docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")), of, "seg long, lang string, n_words long, codes binary, words array<string>, counts array<long>")


def dictionary(segs: DataFrame, least: int) -> DataFrame:
    """lang, word, f, id of the words that occur `least` times in their language, stored; ids from 1, none left out."""
    counted = segs.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
    named = stored(counted.filter(F.col("f") >= least).withColumn("at", F.monotonically_increasing_id()), "op11-words", light=True)
    part = F.shiftright("at", 33)
    sizes = named.groupBy(part.alias("part")).count()  # a row for each task of the count, no more
    first = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    ids = named.withColumn("part", part).join(F.broadcast(first), "part").select("lang", "word", "f", (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1).alias("id"))
    out = stored(ids, "op11-dictionary", light=True)
    dropped(named)
    return out


def with_ids(segs: DataFrame, words: DataFrame, n_words: int) -> DataFrame:
    """ids (little-endian 32-bit, 0 for a break) and n_keys of each segment that has frequent words."""
    at = segs.select("seg", "lang", F.posexplode("words").alias("at", "word"))
    known = words.select("lang", "word", "id")
    found = at.join(F.broadcast(known) if n_words <= BROADCAST_WORDS else known, ["lang", "word"], "left")  # others: no id, not listed
    lists = found.groupBy("seg").agg(F.collect_list(F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("id"))).alias("found"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, pairs in zip(batch.column("codes"), batch.column("found"), strict=True):
                local, pair = np.frombuffer(codes.as_buffer(), np.int32), np.asarray(pairs.values)
                ids = np.zeros(int(local.max()) + 1, np.uint32)
                ids[(pair >> 32) + 1] = pair & 0xFFFFFFFF
                ids = np.append(ids[local], np.uint32(0))
                yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()]), pa.array([int(np.count_nonzero(ids[:-1].astype(bool) & ids[1:].astype(bool)))])], ["ids", "n_keys"])

    return mapped(segs.select("seg", "codes").join(lists, "seg").select("codes", "found"), of, "ids binary, n_keys long").filter("n_keys > 0")


def keys_at(ids: np.ndarray, at: np.ndarray, longest: int) -> np.ndarray:
    """The ids from each place to the end of its piece, at most `longest`, then zeros."""
    padded = np.append(ids, np.zeros(longest, ids.dtype))
    out = np.empty((len(at), longest), np.uint32)
    for k in range(longest):
        out[:, k] = padded[at + k]
        if k:
            out[out[:, k - 1] == 0, k] = 0
    return out


def packed_keys(keys: np.ndarray, width: int) -> np.ndarray:
    """Rows of bytes that sort as the ids do: width bytes an id, the highest first."""
    return np.ascontiguousarray(keys.astype(">u4").view(np.uint8).reshape(*keys.shape, 4)[:, :, 4 - width :]).reshape(len(keys), keys.shape[1] * width)


def radix_sorted(rows: np.ndarray) -> np.ndarray:
    """The order that sorts rows of bytes, by digits of 16 bits from the last to the first."""
    if rows.shape[1] % 2:
        rows = np.concatenate([np.zeros((len(rows), 1), np.uint8), rows], axis=1)
    digits = rows.view(">u2")
    order = np.arange(len(rows))
    for k in range(digits.shape[1] - 1, -1, -1):
        digit = digits[:, k].astype(np.uint16)
        if len(digit) and digit.min() != digit.max():
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def runs(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order and the sums of their counts."""
    order = radix_sorted(rows)
    rows, counts = rows[order], counts[order]
    first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1))[: len(rows)])
    return rows[first], np.add.reduceat(counts, first) if len(first) else counts


def _text(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()  # compares as bytes do: all rows are of one width


def squeezed(rows: np.ndarray) -> bytes:
    """Rows of bytes, column by column and compressed: the columns of sorted keys are alike in long runs."""
    return pa.compress(np.ascontiguousarray(rows.T), codec="zstd", asbytes=True)


def spread(cell: pa.BinaryScalar, n: int, width: int) -> np.ndarray:
    """What squeezed() has packed."""
    return np.ascontiguousarray(np.frombuffer(pa.decompress(cell.as_buffer(), n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n).T)


def borders(coded: DataFrame, n_keys: int, ranges: int, width: int, longest: int) -> np.ndarray:
    """Keys between ranges of about one size, from evenly spaced samples; they decide who sorts what, not what is counted."""
    step = max(1, n_keys // (SAMPLES * ranges))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over = 0
        for batch in batches:
            for x in batch.column("ids"):
                ids = np.frombuffer(x.as_buffer(), np.uint32)
                at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
                picked = at[(step - 1 - over) % step :: step]
                over = (over + len(at)) % step
                rows = packed_keys(keys_at(ids, picked, longest), width)
                yield pa.RecordBatch.from_arrays([pa.array(_text(rows).tolist(), pa.binary())], ["key"])

    got = mapped(coded.select("ids"), of, "key binary").toArrow()["key"].to_pylist()
    found = np.sort(np.array([k.ljust(width * longest, b"\0") for k in got], f"S{width * longest}"))
    return np.unique(found[[len(found) * k // ranges for k in range(1, ranges)]]) if len(found) else found


def dealt(coded: DataFrame, edges: np.ndarray, width: int, longest: int) -> DataFrame:
    """range, n, keys, counts: each segment's distinct keys in order, cut at the borders."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column("ids"):
                ids = np.frombuffer(x.as_buffer(), np.uint32)
                at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
                rows = packed_keys(keys_at(ids, at, longest), width)
                rows, counts = runs(rows, np.ones(len(rows), np.int64))
                cuts = np.concatenate([[0], np.searchsorted(_text(rows), edges), [len(rows)]])
                full = np.flatnonzero(np.diff(cuts))
                parts_of = [(rows[cuts[r] : cuts[r + 1]], counts[cuts[r] : cuts[r + 1]].astype("<u4")) for r in full]
                yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int64)), pa.array([len(r) for r, _ in parts_of]), pa.array([squeezed(r) for r, _ in parts_of], pa.binary()), pa.array([squeezed(c.view(np.uint8).reshape(-1, 4)) for _, c in parts_of], pa.binary())], ["range", "n", "keys", "counts"])

    return mapped(coded.select("ids"), of, "range long, n long, keys binary, counts binary")


def counted(dealt_keys: DataFrame, width: int, longest: int, least: int) -> DataFrame:
    """key (two to `longest` ids), a: the phrases that occur `least` times."""

    def of(group: pa.Table) -> pa.Table:
        sizes = group["n"].to_pylist()
        rows = np.concatenate([spread(x, n, width * longest) for x, n in zip(group["keys"], sizes, strict=True)])
        rows, counts = runs(rows, np.concatenate([spread(x, n, 4) for x, n in zip(group["counts"], sizes, strict=True)]).view("<u4").ravel().astype(np.int64))
        keys, sums = [], []
        differs = rows[1:] != rows[:-1]
        for k in range(2, longest + 1):
            first = np.flatnonzero(np.append(True, differs[:, : k * width].any(axis=1)))
            n = np.add.reduceat(counts, first)
            border = np.zeros(len(first), bool)
            border[[0, -1]] = True  # its neighbours may hold more of these
            keep = (border | (n >= least)) & rows[first, (k - 1) * width : k * width].any(axis=1)
            keys += [r.tobytes() for r in rows[first[keep], : k * width]]
            sums.append(n[keep])
        return pa.table({"key": pa.array(keys, pa.binary()), "a": pa.array(np.concatenate(sums))})

    found = dealt_keys.groupBy("range").applyInArrow(of, "key binary, a long")
    return found.groupBy("key").agg(F.sum("a").alias("a")).filter(F.col("a") >= least)


def scored(phrases: DataFrame, singles: DataFrame, totals: DataFrame, width: int) -> DataFrame:
    """Phrases with l, r, n, score and lang of their lowest cut; a tie goes to the smaller first part.  Decimals hold 38 digits."""
    size = (F.length("key") / width).cast("int")
    cuts = phrases.select("key", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("key", "a", "k", F.expr(f"substring(key, 1, k * {width})").alias("left"), F.expr(f"substring(key, k * {width} + 1)").alias("right"))
    known = phrases.select("key", F.col("a").alias("f"), F.lit(None).cast("string").alias("lang")).unionByName(singles.select("key", "f", "lang"))
    cuts = cuts.join(known.select(F.col("key").alias("left"), F.col("f").alias("l"), "lang"), "left").join(known.select(F.col("key").alias("right"), F.col("f").alias("r")), "right")
    langs = cuts.filter("k = 1").select("key", "lang")
    cuts = cuts.drop("lang").join(langs, "key").join(totals, "lang")
    score = F.expr("CAST(1000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(38,0)) * CAST(n AS DECIMAL(38,0)) div (CAST(l AS DECIMAL(38,0)) * CAST(r AS DECIMAL(38,0)))")
    best = cuts.withColumn("score", score).groupBy("key").agg(F.first("a").alias("a"), F.first("lang").alias("lang"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("key", "lang", "a", "n", "cut.l", "cut.r", "cut.score")


def maximal(phrases: DataFrame, width: int) -> DataFrame:
    """Phrases that no longer one explains: a phrase goes if one that holds it occurs as often (100 of 100).

    Counts only fall as phrases grow, so a longer one that explains it does so by way of one that is longer by a word.
    """
    longer = phrases.filter(F.length("key") > 2 * width).select(F.explode(F.array(F.expr(f"substring(key, 1, length(key) - {width})"), F.expr(f"substring(key, {width} + 1)"))).alias("key"), F.col("a").alias("of"))
    return phrases.join(longer.groupBy("key").agg(F.max("of").alias("of")), "key", "left").filter("of IS NULL OR 100 * of < 100 * a").drop("of")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases."""
    segs = stored(segments(docs), "op11-segments", light=True)
    totals = stored(segs.groupBy("lang").agg(F.sum("n_words").alias("n")), "op11-totals", light=True)
    words = dictionary(segs, least)
    n_words = words.count()
    if n_words >= 1 << 32:
        raise ValueError("over 2^32 frequent words: raise `least`")
    width = max(1, (n_words.bit_length() + 7) // 8)
    coded = stored(with_ids(segs, words, n_words), "op11-ids")
    dropped(segs)
    n_keys = coded.agg(F.sum("n_keys")).first()[0] or 0
    ranges = max(1, n_keys // RANGE, min(parts(docs.sparkSession), n_keys // 10_000))
    edges = borders(coded, n_keys, ranges, width, longest)
    phrases = stored(counted(dealt(coded, edges, width, longest), width, longest, least), "op11-phrases")
    dropped(coded)
    key = F.expr(f"unhex(lpad(hex(id), {2 * width}, '0'))")
    keyed = words.withColumn("key", key)
    chosen = maximal(scored(phrases, keyed, totals, width), width)
    order = [F.desc("score"), F.desc("a")]
    near = chosen.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("place") <= top)
    near = near.withColumn("at", F.explode(F.sequence(F.lit(0), (F.length("key") / width).cast("int") - 1))).withColumn("one", F.expr(f"substring(key, at * {width} + 1, {width})"))
    spelt = near.join(keyed.select(F.col("key").alias("one"), "word"), "one").groupBy("key", "lang", "a", "l", "r", "n", "score").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    spelt = spelt.withColumn("phrase", F.concat_ws(" ", "words.word"))
    ranked = spelt.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long")).filter(F.col("rank") <= top)
    out = stored(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")), "op11-out")
    dropped(totals, words, phrases)
    return out


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language of `documents`."""
    return collocations(table(spark, "documents", sf_dir))


def _grams() -> str:
    return " UNION ALL ".join(f"SELECT lang, array_to_string(w[i : i + {k - 1}], ' ') AS p, {k} AS k FROM spot WHERE i + {k - 1} <= len(w)" for k in range(1, LONGEST + 1))


def _cuts() -> str:
    return reduce(lambda x, k: f"{x} UNION ALL SELECT lang, p, a, {k} AS k, array_to_string(string_split(p, ' ')[1 : {k}], ' ') AS left_part, array_to_string(string_split(p, ' ')[{k + 1} : ], ' ') AS right_part FROM c WHERE k > {k}", range(2, LONGEST), "SELECT lang, p, a, 1 AS k, string_split(p, ' ')[1] AS left_part, array_to_string(string_split(p, ' ')[2 : ], ' ') AS right_part FROM c")


OP11_SQL = f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM documents),
  spot AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces), n AS (SELECT lang, count(*) AS n FROM spot GROUP BY lang),
  f AS (SELECT lang, p, k, count(*) AS a FROM ({_grams()}) GROUP BY ALL HAVING count(*) >= {LEAST}), c AS (SELECT * FROM f WHERE k >= 2), cut AS ({_cuts()}),
  s AS (SELECT lang, cut.p, cut.a, cut.k, x.a AS l, y.a AS r, n, CAST(1000 AS HUGEINT) * cut.a * n // (CAST(x.a AS HUGEINT) * y.a) AS score FROM cut JOIN f AS x USING (lang) JOIN f AS y USING (lang) JOIN n USING (lang) WHERE x.p = left_part AND y.p = right_part),
  best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS m FROM s) WHERE m = 1),
  longer AS (SELECT DISTINCT c.lang, c.p FROM c JOIN c AS x ON x.lang = c.lang AND x.k > c.k AND x.a >= c.a AND contains(' ' || x.p || ' ', ' ' || c.p || ' '))
  SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(p)) AS rank, p AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM best ANTI JOIN longer USING (lang, p)) WHERE rank <= {TOP}"""
