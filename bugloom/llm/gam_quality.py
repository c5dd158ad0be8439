"""Quality classifier: an additive model of lookup tables, boosted in turns over features, then over pairs of features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mapped, table
from .textstats import FEATURES, binned, blocks, cuts_of, labelled_sample, matrix, stats

#: Most labelled documents that the tables are learnt on.
SAMPLE = 20_000
BINS, PAIR_BINS, ROUNDS, PAIR_ROUNDS, PAIRS, RATE, L2 = 48, 12, 120, 40, 10, 0.2, 2.0
LEAST_LEAF = 15
THRESHOLD = 0.7


class Additive:
    """An intercept, a table for each feature's bins and one for each chosen pair's."""

    def __init__(self, cuts: list[np.ndarray], coarse: list[np.ndarray], base: float) -> None:
        self.cuts, self.coarse, self.base = cuts, coarse, base
        self.tables = [np.zeros(len(c) + 1) for c in cuts]
        self.pairs: list[tuple[int, int, np.ndarray]] = []

    def score(self, x: np.ndarray) -> np.ndarray:
        b, total = binned(x, self.cuts), np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            total += t[b[:, f]]
        if self.pairs:
            c = binned(x, self.coarse)
            for f, g, t in self.pairs:
                total += t[c[:, f], c[:, g]]
        return 1 / (1 + np.exp(-total))


def _cut(n: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best split of bins in order; place -1: none."""
    cn, cg, ch = np.cumsum(n)[:-1], np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = cg**2 / (ch + L2) + (g.sum() - cg) ** 2 / (h.sum() - ch + L2) - g.sum() ** 2 / (h.sum() + L2)
    ok = (cn >= LEAST_LEAF) & (n.sum() - cn >= LEAST_LEAF)
    if not ok.any():
        return 0.0, -1
    i = int(np.argmax(np.where(ok, gain, -1)))
    return float(gain[i]), i


def _shallow(n: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of up to four leaves over a feature's bins, as a table."""
    out = np.zeros(len(n))
    leaves = [(0, len(n))]
    for _ in range(2):
        new = []
        for a, e in leaves:
            gain, i = _cut(n[a:e], g[a:e], h[a:e])
            new += [(a, a + i + 1), (a + i + 1, e)] if i >= 0 and gain > 1e-6 else [(a, e)]
        leaves = new
    for a, e in leaves:
        out[a:e] = g[a:e].sum() / (h[a:e].sum() + L2)
    return out


def _cross(n: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and table of the best pair of crossing cuts over a pair's bins."""
    corner = [np.pad(np.cumsum(np.cumsum(v, 0), 1), ((1, 0), (1, 0))) for v in (n, g, h)]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(1, n.shape[0]), np.arange(1, n.shape[1]), indexing="ij"))
    if not len(i):
        return 0.0, np.zeros(n.shape)
    quads = []
    for c in corner:
        a, left, top, every = c[i, j], c[-1, j], c[i, -1], c[-1, -1]
        quads.append(np.stack([a, top - a, left - a, every - top - left + a]))
    qn, qg, qh = quads
    gain = np.where(qn.min(0) >= LEAST_LEAF, (qg**2 / (qh + L2)).sum(0), -1) - corner[1][-1, -1] ** 2 / (corner[2][-1, -1] + L2)
    k = int(np.argmax(gain))
    w = (qg[:, k] / (qh[:, k] + L2)).reshape(2, 2)
    return float(gain[k]), w[np.ix_((np.arange(n.shape[0]) >= i[k]).astype(int), (np.arange(n.shape[1]) >= j[k]).astype(int))] if gain[k] > 0 else np.zeros(n.shape)


def learn(x: np.ndarray, y: np.ndarray) -> Additive:
    """Without rows, or with one label only, every score is the share of label 1 (0.5 without rows)."""
    share = float(y.mean()) if len(y) else 0.5
    base = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
    if not len(y) or share in (0.0, 1.0):
        return Additive([np.zeros(0)] * len(FEATURES), [np.zeros(0)] * len(FEATURES), base)
    model = Additive(cuts_of(x, BINS), cuts_of(x, PAIR_BINS), base)
    b, c = binned(x, model.cuts), binned(x, model.coarse)
    total = np.full(len(y), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    size = [np.bincount(b[:, f], minlength=len(t)) for f, t in enumerate(model.tables)]
    for _ in range(ROUNDS):
        for f, t in enumerate(model.tables):
            g, h = slopes()
            step = RATE * _shallow(size[f], np.bincount(b[:, f], g, len(t)), np.bincount(b[:, f], h, len(t)))
            t += step
            total += step[b[:, f]]
    shapes = [len(k) + 1 for k in model.coarse]

    def over(f: int, k: int, v: np.ndarray | None) -> np.ndarray:
        return np.bincount(c[:, f] * shapes[k] + c[:, k], v, shapes[f] * shapes[k]).reshape(shapes[f], shapes[k])

    g, h = slopes()
    ranked = sorted(((_cross(over(f, k, None), over(f, k, g), over(f, k, h))[0], f, k) for f in range(len(shapes)) for k in range(f)), reverse=True)
    model.pairs = [(f, k, np.zeros((shapes[f], shapes[k]))) for gain, f, k in ranked[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for f, k, t in model.pairs:
            g, h = slopes()
            step = RATE * _cross(over(f, k, None), over(f, k, g), over(f, k, h))[1]
            t += step
            total += step[c[:, f], c[:, k]]
    return model


def fitted(docs: DataFrame, labels: DataFrame) -> Additive:
    """The model of the labelled documents outside the held-out fold."""
    return learn(*labelled_sample(docs, labels.filter(F.crc32(F.col("doc_id").cast("long").cast("string")) % 4 != 2), SAMPLE))


def scored(docs: DataFrame, model: Additive) -> DataFrame:
    """doc_id and score."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data, offs in blocks(batch.column(1)):
                score = model.score(matrix(stats(data, offs)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(score)), pa.array(score)], ["doc_id", "score"])

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), of, "doc_id long, score double")


def accepted(docs: DataFrame, model: Additive) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores THRESHOLD or more."""
    schema = docs.schema
    at = docs.columns.index("text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [model.score(matrix(stats(data, offs))) for _, data, offs in blocks(batch.column(at))]
            if score:
                yield batch.filter(pa.array(np.concatenate(score) >= THRESHOLD))

    return mapped(docs, of, schema)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for each document.

    Null and empty texts are scored by their statistics, all 0; rows alike get one score; a null doc_id stays null and
    isn't held out; further columns are ignored.  Without labels to learn every score is 0.5.
    """
    docs = table(spark, "documents", sf_dir)
    rows = scored(docs, fitted(docs, table(spark, "labels", sf_dir)))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
