"""Quality rules: boosted trees over document statistics with monotonic constraints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import mapped, table
from .textstats import BASE, FEATURES, binned, blocks, cuts_of, labelled_sample, matrix, stats

#: Most labelled documents that the trees are grown on.
SAMPLE = 20_000
TREES, DEPTH, RATE, BINS, LEAST_LEAF, L2 = 80, 4, 0.15, 64, 20, 1.0
#: A score can't rise with these shares; with the share of different words it can't fall.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "run_share": -1, "bang_share": -1, "distinct_share": 1}
KEEP = 0.5


class Trees:
    """Trees as flat node arrays: feature (-1: leaf), threshold (left: up to it), left, right and value."""

    def __init__(self, base: float) -> None:
        self.base, self.roots = base, []
        self.feature, self.threshold, self.left, self.right, self.value = [], [], [], [], []

    def node(self, value: float) -> int:
        self.feature.append(-1), self.threshold.append(0.0), self.left.append(-1), self.right.append(-1), self.value.append(value)
        return len(self.feature) - 1

    def packed(self) -> Trees:
        for k, kind in (("feature", np.int32), ("threshold", np.float64), ("left", np.int32), ("right", np.int32), ("value", np.float64)):
            setattr(self, k, np.array(getattr(self, k), kind))
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities; all rows step down a level of a tree at once."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for root, deep in self.roots:
            at = np.full(len(x), root, np.int32)
            for _ in range(deep):
                f = self.feature[at]
                down = np.where(x[rows, np.maximum(f, 0)] <= self.threshold[at], self.left[at], self.right[at])
                at = np.where(f < 0, at, down)
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, monotone: dict[str, int] = MONOTONE) -> Trees:
    """Boosted trees of log loss.  A constrained split must order its sides, and each side stays within their middle.

    Without rows, or with one label only, every score is the share of label 1 (0.5 without rows).
    """
    share = float(y.mean()) if len(y) else 0.5
    model = Trees(float(np.log(max(share, 1e-3) / max(1 - share, 1e-3))))
    if not len(y) or share in (0.0, 1.0):
        return model.packed()
    signs = [monotone.get(f, 0) for f in FEATURES]
    cuts = cuts_of(x, BINS)
    b = binned(x, cuts)
    total = np.full(len(y), model.base)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        root = model.node(0.0)
        todo = [(root, np.arange(len(y)), 0, -np.inf, np.inf)]
        while todo:
            node, rows, deep, lo, hi = todo.pop()
            sg, sh = g[rows].sum(), h[rows].sum()
            model.value[node] = RATE * float(np.clip(sg / (sh + L2), lo, hi))
            best = (1e-6, None)
            if deep < DEPTH and len(rows) >= 2 * LEAST_LEAF:
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    k = b[rows, f]
                    n, a, e = (np.cumsum(np.bincount(k, v, len(c) + 1))[:-1] for v in (None, g[rows], h[rows]))
                    left, right = np.clip(a / (e + L2), lo, hi), np.clip((sg - a) / (sh - e + L2), lo, hi)
                    gain = a * left - (e + L2) * left**2 / 2 + (sg - a) * right - (sh - e + L2) * right**2 / 2
                    ok = (n >= LEAST_LEAF) & (len(rows) - n >= LEAST_LEAF) & (signs[f] * (right - left) >= 0)
                    if ok.any():
                        i = int(np.argmax(np.where(ok, gain, -np.inf)))
                        gain_here = gain[i] - sg**2 / (sh + L2) / 2
                        if gain_here > best[0]:
                            best = (gain_here, (f, i, left[i], right[i]))
            if best[1] is None:
                total[rows] += model.value[node]
                continue
            f, i, wl, wr = best[1]
            mid = (wl + wr) / 2
            left_bounds, right_bounds = ((lo, mid), (mid, hi)) if signs[f] > 0 else ((mid, hi), (lo, mid)) if signs[f] < 0 else ((lo, hi), (lo, hi))
            side = b[rows, f] <= i
            model.feature[node], model.threshold[node] = f, float(cuts[f][i])
            model.left[node], model.right[node] = model.node(0.0), model.node(0.0)
            todo += [(model.left[node], rows[side], deep + 1, *left_bounds), (model.right[node], rows[~side], deep + 1, *right_bounds)]
        model.roots.append((root, DEPTH))
    return model.packed()


def judged(docs: DataFrame, model: Trees) -> DataFrame:
    """doc_id, BASE, score, base_failed and kept."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data, offs in blocks(batch.column(1)):
                s = stats(data, offs)
                score = model.score(matrix(s))
                failed = (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(score)), *(pa.array(s[k].astype(np.int64)) for k in BASE), pa.array(failed), pa.array(~failed & (score >= KEEP)), pa.array(score)], ["doc_id", *BASE, "base_failed", "kept", "score"])

    return mapped(docs.select(docs.doc_id.cast("long").alias("doc_id"), "text"), of, "doc_id long, " + "".join(f"{k} long, " for k in BASE) + "base_failed boolean, kept boolean, score double")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict for each document.

    Null and empty texts have no words and fail the base rule; a row that repeats another is judged like it; a null
    doc_id stays null; further columns are ignored.  Without labels nothing but the base rule rejects.
    """
    docs = table(spark, "documents", sf_dir)
    return judged(docs, grow(*labelled_sample(docs, table(spark, "labels", sf_dir), SAMPLE)))
