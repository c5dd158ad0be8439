"""Statistics of whole texts, counted over Arrow buffers without a loop over texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, byte_symbols, in_runs, mapped, mix, prefix_sums, range_hash, text_buffers, word_symbols, words

WINDOW = 8
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Inputs of the quality models, all free of the text's length but for the first.
FEATURES = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "punct_share", "bang_share", "distinct_share", "run_share", "short_share", "long_share", "line_words", "stop_share", "other_share", "top_share", "cap_word_share")


def _flags(chars: str) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[[ord(c) for c in chars]] = 1
    return out


_SYMBOL = _flags("#*$%&|<>")
_UPPER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _flags("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _flags("0123456789")
_BANG = _flags("!?")
_STOP = _flags(".,;:")
_PUNCT = _flags("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_HEAD = (np.arange(256) & 0xC0 != 0x80).astype(np.int64)  # first byte of a character
_SPACE = _flags(" \t\n\v\f\r")
_WIDE = (np.arange(256) >= 0x80).astype(np.int64) * _HEAD


def _per(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of values over offs[i]:offs[i + 1]."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[offs[1:]] - sums[offs[:-1]]


def _firsts(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash how many like it its text has, and whether it is the first such one."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    key = mix(hashes ^ mix(text.astype(U64) + U64(1)))
    order = np.argsort(key, kind="stable")
    k = key[order]
    new = np.append(True, k[1:] != k[:-1])
    group = np.cumsum(new) - 1
    size = np.bincount(group)
    count, first = np.empty(len(k), np.int64), np.empty(len(k), bool)
    count[order], first[order] = size[group], new
    return count, first


def stats(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """BASE and FEATURES of each text, as arrays."""
    n = len(offs) - 1
    begin, end, bounds = words(data, offs)
    n_words = np.diff(bounds)
    of_word = np.repeat(np.arange(n), n_words)
    symbols = word_symbols(data, begin, end)
    head = _HEAD[data]
    chars = _per(head * (1 - _SPACE[data]), offs)

    feeds = np.flatnonzero(data == 10)
    line_begin = np.sort(np.concatenate([offs[:-1], feeds + 1]))  # a feed that ends a text starts an empty line of it
    line_text = np.repeat(np.arange(n), 1 + _per((data == 10).astype(np.int64), offs))
    line_end = np.append(line_begin[1:] - 1, offs[-1]) if len(line_begin) else line_begin
    last = np.append(line_text[1:] != line_text[:-1], True) if n else np.zeros(0, bool)
    line_end = np.where(last, offs[line_text + 1], line_end)
    sums = prefix_sums(byte_symbols(data))
    in_line = np.searchsorted(begin, line_end) - np.searchsorted(begin, line_begin)
    solid = in_line > 0
    lines = _per(solid.astype(np.int64), np.searchsorted(line_text, np.arange(n + 1)))
    _, first = _firsts(range_hash(sums, line_begin[solid], line_end[solid]), line_text[solid])
    dup_lines = np.bincount(line_text[solid][~first], minlength=n)

    have = np.maximum(n_words - WINDOW + 1, 0)
    start = np.repeat(bounds[:-1], have) + in_runs(have)
    wsums = prefix_sums(symbols)
    count, _ = _firsts(range_hash(wsums, start, start + WINDOW), np.repeat(np.arange(n), have))
    step = np.zeros(len(begin) + 1, np.int64)
    np.add.at(step, start[count > 1], 1)
    np.add.at(step, start[count > 1] + WINDOW, -1)
    repeat = _per((np.cumsum(step[:-1]) > 0).astype(np.int64), bounds)

    count, first = _firsts(symbols, of_word)
    distinct = np.bincount(of_word[first], minlength=n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, of_word, count)
    same = np.zeros(len(symbols), np.int64)
    same[1:] = (symbols[1:] == symbols[:-1]) & (of_word[1:] == of_word[:-1])
    heads = np.concatenate([[0], np.cumsum(head)])
    length = heads[end] - heads[begin]
    cap = _UPPER[data[begin]] if len(begin) else np.zeros(0, np.int64)
    w, c, letters = np.maximum(n_words, 1), np.maximum(chars, 1), _per(_UPPER[data] + _LOWER[data], offs)
    out = {"n_words": n_words, "word_chars": chars, "n_symbols": _per(_SYMBOL[data], offs), "n_dup_lines": dup_lines, "n_repeat_words": repeat}
    out |= {
        "log_words": np.log1p(n_words), "word_length": chars / w, "symbol_share": out["n_symbols"] / c, "dup_line_share": dup_lines / np.maximum(lines, 1), "repeat_share": repeat / w,
        "upper_share": _per(_UPPER[data], offs) / np.maximum(letters, 1), "digit_share": _per(_DIGIT[data], offs) / c, "punct_share": _per(_PUNCT[data], offs) / c, "bang_share": _per(_BANG[data], offs) / c,
        "distinct_share": distinct / w, "run_share": _per(same, bounds) / w, "short_share": _per((length <= 3).astype(np.int64), bounds) / w, "long_share": _per((length >= 12).astype(np.int64), bounds) / w,
        "line_words": n_words / np.maximum(lines, 1), "stop_share": _per(_STOP[data], offs) / w, "other_share": _per(_WIDE[data], offs) / c, "top_share": top / w, "cap_word_share": _per(cap, bounds) / w,
    }
    return out


def blocks(arr: pa.Array, size: int = 1 << 19) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, offsets) of parts of a string column of about size bytes each."""
    data, offs = text_buffers(arr)
    i = 0
    while i < len(offs) - 1:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, "right")) - 1)
        yield i, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def matrix(found: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([found[k] for k in FEATURES], axis=1).astype(np.float64)


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """FEATURES and quality of at most `most` labelled documents, the first by a hash of doc_id.

    A document with several labels counts with the least; labels without doc_id or quality, and those of no document, count for nothing.
    Of rows of one doc_id that of the least hash of text counts, so that the sample is bounded by rows too.
    """
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    chosen = chosen.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")  # at most `most` rows of two numbers
    rows = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"), F.first("quality").alias("quality")).select("doc_id", "t.text", "quality")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data, offs in blocks(batch.column(1)):
                m = matrix(stats(data, offs)).astype(np.float32)
                k = len(offs) - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, k), batch.column(2).slice(i, k), pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), m.shape[1]).cast(pa.list_(pa.float32()))], ["doc_id", "quality", "x"])

    got = mapped(rows.select("doc_id", "text", "quality"), of, "doc_id long, quality int, x array<float>").toPandas().sort_values("doc_id", kind="stable")
    if not len(got):
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    return np.stack(got.x.to_numpy()).astype(np.float64), (got.quality.to_numpy() > 0).astype(np.float64)


def cuts_of(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Inner edges of at most `bins` bins of each column, at quantiles."""
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin k holds values over k edges."""
    return np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
