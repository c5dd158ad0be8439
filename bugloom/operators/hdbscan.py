"""Density clustering of each group's vectors (Campello et al. 2013), with excess-of-mass or leaf selection.

A core distance is that to the min_samples-th point counting the point itself.  The root is never a cluster, so a group
without a split is noise throughout.

Vectors of a group are dealt to blocks, and a task holds two blocks: it finds the nearest vectors of each, by products in
single precision that leave few pairs whose distance is worked out.  Of the edges to these neighbours a forest is left;
`joined` takes those that no edge which isn't listed can be less than, as each is the least that leaves some part.  Of the
parts that remain, all but the largest then look for their least edge among all vectors, until one is left.  Only the tree of
a group, three numbers for each vector, meets in one task, which cuts it into clusters; MAX_GROUP bounds that, and a
larger group is an error, not a sample.  Edges are in a total order (distance to ten places, then ids), so that the tree
and the labels don't depend on blocks.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import doubles
from ..session import shared_folder

MAX_GROUP = 5_000_000
#: Vectors of a block at most, forests that are merged in a task.
BLOCK, FAN = 32_768, 8
#: Blocks that a group has if it is large enough to be worth them, neighbours listed beyond min_samples, edges of a task.
SPREAD, MORE, EDGES = 8, 7, 500_000
#: Rows and columns of products that are worked out at once.
ROWS, COLUMNS = 1024, 4096


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """To ten places; 0 where two vectors differ by rounding only."""
    sx, sy = (x * x).sum(1)[:, None], (y * y).sum(1)
    d = sx + sy - 2 * x @ y.T
    d[d < 1e-12 * (sx + sy)] = 0
    return np.round(np.sqrt(d), 10)


def nearest_distances(x: np.ndarray, y: np.ndarray, k: int, own: bool) -> np.ndarray:
    """The k least distances of each row of x to rows of y, infinite beyond their number; own: y is x."""
    out = np.full((len(x), k), np.inf)
    for i in range(0, len(x), 1024):
        d = _distances(x[i : i + 1024], y)
        if own:
            d[np.arange(len(d)), i + np.arange(len(d))] = 0
        out[i : i + 1024, : len(y)] = np.sort(np.partition(d, k - 1, axis=1)[:, :k] if k < len(y) else d, axis=1)[:, :k]
    return out


class _Products:
    """x against y in single precision: what may be as near as a distance is told by a product, then worked out."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        self.x, self.y, self.sx, self.sy = x, y, (x * x).sum(1), (y * y).sum(1)
        self.scale = float(max(self.sx.max(initial=0), self.sy.max(initial=0))) or 1.0
        self.margin = (x.shape[1] + 8) * 2.0**-22
        self.q = np.column_stack([x / self.scale**0.5, np.ones(len(x))]).astype(np.float32)
        self.v = np.column_stack([y / self.scale**0.5, -self.sy / self.scale / 2]).astype(np.float32)

    def of(self, rows: slice, columns: slice) -> np.ndarray:
        """Greater is nearer: half the square of the row's length, less half that of the distance, by scale."""
        return self.q[rows] @ self.v[columns].T

    def least(self, rows: np.ndarray | slice, d: np.ndarray) -> np.ndarray:
        """The product that a vector at distance d of each row has at least."""
        return ((self.sx[rows] - (d + 1e-9) ** 2) / (2 * self.scale) - self.margin).astype(np.float32)

    def distances(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """To ten places; 0 where two vectors differ by rounding only."""
        out = np.empty(len(i))
        for n in range(0, len(i), 65_536):
            a, b = i[n : n + 65_536], j[n : n + 65_536]
            d = ((self.x[a] - self.y[b]) ** 2).sum(1)
            d[d < 1e-12 * (self.sx[a] + self.sy[b])] = 0
            out[n : n + 65_536] = np.round(np.sqrt(d), 10)
        return out


def _hits(s: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.divmod(np.flatnonzero(s >= least[:, None]), s.shape[1])


def nearest_of(x: np.ndarray, y: np.ndarray, k: int, own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Distances and places of the k nearest rows of y for each row of x, infinite and -1 beyond their number; own: y is x, but not itself."""
    p = _Products(x, y)
    ends = [0]
    while ends[-1] < len(y):
        ends.append(min(len(y), ends[-1] + min(COLUMNS, max(ROWS, ends[-1]))))
    dist, at = np.full((len(x), k), np.inf), np.full((len(x), k), -1)
    for r in range(0, len(x), ROWS):
        rows = slice(r, min(r + ROWS, len(x)))
        here = np.arange(rows.start, rows.stop)
        for lo, hi in zip(ends, ends[1:], strict=False):
            s = p.of(rows, slice(lo, hi))
            if own:
                self_at = here[(here >= lo) & (here < hi)]
                s[self_at - r, self_at - lo] = -np.inf
            last = dist[rows, k - 1]
            least = np.where(last == 0, np.inf, np.where(np.isinf(last), np.finfo(np.float32).min, p.least(rows, np.where(np.isinf(last), 0, last)))).astype(np.float32)
            if lo == 0 and hi > k:
                least = np.maximum(np.partition(s, hi - k, axis=1)[:, hi - k] - np.float32(2 * p.margin), np.finfo(np.float32).min)
            i, j = _hits(s, least)
            if not len(i):
                continue
            d = p.distances(i + r, j + lo)
            some = np.unique(i)
            i, j, d = np.concatenate([i, np.repeat(some, k)]), np.concatenate([j + lo, at[some + r].ravel()]), np.concatenate([d, dist[some + r].ravel()])
            order = np.lexsort((d, i))
            i, j, d = i[order], j[order], d[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            kept = place < k
            dist[i[kept] + r, place[kept]], at[i[kept] + r, place[kept]] = d[kept], j[kept]
    return dist, at


def least_leaving(asked: dict[str, np.ndarray], all_: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """(part, w, a, b): the least edge of each part that leaves it from one of its asked vectors, or that known before if it is less.

    asked: x, id, core, _part, and w, a, b of the edge known for the part, w infinite if there is none; all_: x, id, core, _part.
    """
    p = _Products(asked["x"], all_["x"])
    parts, first, part = np.unique(asked["_part"], return_index=True, return_inverse=True)
    w, a, b = (asked[c][first].copy() for c in ("w", "a", "b"))
    for r in range(0, len(part), ROWS):
        rows = slice(r, min(r + ROWS, len(part)))
        for c in range(0, len(all_["id"]), COLUMNS):
            columns = slice(c, min(c + COLUMNS, len(all_["id"])))
            s = p.of(rows, columns)
            s[asked["_part"][rows, None] == all_["_part"][None, columns]] = -np.inf

            def take(i: np.ndarray, j: np.ndarray, r: int = r, c: int = c) -> None:
                reach = np.maximum(p.distances(i + r, j + c), np.maximum(asked["core"][i + r], all_["core"][j + c]))
                ids = asked["id"][i + r], all_["id"][j + c]
                of, lo, hi = part[i + r], np.minimum(*ids), np.maximum(*ids)
                of, reach, lo, hi = (np.concatenate(z) for z in ((of, np.arange(len(parts))), (reach, w), (lo, a), (hi, b)))
                order = np.lexsort((hi, lo, reach, of))
                order = order[np.r_[True, of[order][1:] != of[order][:-1]]]
                w[:], a[:], b[:] = reach[order], lo[order], hi[order]

            near = s.argmax(1)
            i = np.flatnonzero(s[np.arange(len(s)), near] > -np.inf)
            take(i, near[i])  # so that few are left to look at
            bound = w[part[rows]]
            least = np.where(np.isinf(bound), np.finfo(np.float32).min, p.least(rows, np.where(np.isinf(bound), 0, bound))).astype(np.float32)
            least[asked["core"][rows] > bound] = np.inf
            i, j = _hits(s, least)
            fits = all_["core"][j + c] <= bound[i]
            take(i[fits], j[fits])
    known = np.isfinite(w)
    return parts[known], w[known], a[known], b[known]


def tree_of(x: np.ndarray, core: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """(a, b, distance) of the spanning tree of mutual reachability that is least by distance, then a, then b, with a < b."""
    n = len(x)
    best, left = np.full(n, np.inf), np.ones(n, bool)
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).max)
    at, edges = 0, []
    for _ in range(n - 1):
        left[at] = False
        reach = np.maximum(np.maximum(_distances(x[at : at + 1], x)[0], core), core[at])
        lo, hi = np.minimum(ids, ids[at]), np.maximum(ids, ids[at])
        nearer = left & ((reach < best) | ((reach == best) & ((lo < low) | ((lo == low) & (hi < high)))))
        best[nearer], low[nearer], high[nearer] = reach[nearer], lo[nearer], hi[nearer]
        some = np.flatnonzero(left & (best == best[left].min()))
        at = int(some[np.lexsort((high[some], low[some]))[0]])
        edges.append((low[at], high[at], best[at]))
    return np.array(edges, dtype=[("a", np.int64), ("b", np.int64), ("w", np.float64)])


def _pairs(ends: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """The rows with their places, a few at a time as Python objects."""
    for n in range(0, len(ends), 65_536):
        yield from enumerate(ends[n : n + 65_536].tolist(), n)


def joined(ids: np.ndarray, floor: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray, sure: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the edges that are in the least tree for sure, in order; the part of each id that they make; the least other edge of its part, or -1.

    ids: in order; floor: no edge of an id that isn't among a, b is less.  Edges come in order: one that isn't sure yet is the
    least to leave a part if no floor of the part is as low, since lesser ones that left it were taken before.
    """
    order = np.lexsort((~sure, b, a, w))
    ends = np.searchsorted(ids, np.stack([a[order], b[order]], axis=1))
    top, low, kept, taken = list(range(len(ids))), floor.tolist(), [], sure[order]
    weight = w[order]
    for k, (i, j) in _pairs(ends):
        while top[i] != i:
            top[i] = i = top[top[i]]
        while top[j] != j:
            top[j] = j = top[top[j]]
        if i != j and (taken[k] or max(low[i], low[j]) > weight[k]):
            top[i] = j
            low[j] = min(low[i], low[j])
            kept.append(k)
    part = np.array(top)
    while (part != part[part]).any():
        part = part[part]
    rest = np.setdiff1d(np.arange(len(order)), kept)
    here, there = part[ends[rest, 0]], part[ends[rest, 1]]
    rest, here, there = (z[here != there] for z in (rest, here, there))
    least = np.full(len(ids), len(order))
    np.minimum.at(least, here, rest)
    np.minimum.at(least, there, rest)
    return order[kept], part, np.append(order, -1)[least[part]]


def least_forest(a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Places of the edges of the least spanning forest, in order."""
    order = np.lexsort((b, a, w))
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    ends = ends.reshape(2, -1).T[order]
    top, kept = list(range(len(names))), []
    for k, (i, j) in _pairs(ends):
        while top[i] != i:
            top[i] = i = top[top[i]]
        while top[j] != j:
            top[j] = j = top[top[j]]
        if i != j:
            top[i] = j
            kept.append(k)
    return order[kept]


def spanning_tree(x: np.ndarray, min_samples: int) -> np.ndarray:
    """Rows (a, b, distance) of a least spanning tree over mutual reachability, sorted by distance."""
    k = min(min_samples, len(x))
    edges = tree_of(x, nearest_distances(x, x, k, True)[:, k - 1], np.arange(len(x)))
    edges = edges[np.lexsort((edges["b"], edges["a"], edges["w"]))] if len(edges) else edges
    return np.stack([edges["a"], edges["b"], edges["w"]], axis=1).reshape(-1, 3) if len(edges) else np.zeros((0, 3))


class _Cluster:
    def __init__(self, birth: float) -> None:
        self.birth, self.stability, self.children, self.points = birth, 0.0, [], []


def condensed(edges: np.ndarray, n: int, least: int) -> _Cluster:
    """The tree of clusters of at least `least` points; points are those that leave a cluster for noise."""
    left, right, dist, size = array("q", bytes(16 * n)), array("q", bytes(16 * n)), array("d", bytes(16 * n)), array("q", [1]) * (2 * n)
    top = array("q", range(n))

    def find(a: int) -> int:
        while top[a] != a:
            top[a] = top[top[a]]
            a = top[a]
        return a

    for k, (a, b, d) in enumerate(edges):
        i, j, new = find(int(a)), find(int(b)), n + k
        top.append(new)
        top[i] = top[j] = new
        left[new], right[new], dist[new], size[new] = i, j, d, size[i] + size[j]
    root = _Cluster(0.0)
    todo = [(n + len(edges) - 1, root)]

    def leaves(v: int) -> list[int]:
        out, stack = [], [v]
        while stack:
            v = stack.pop()
            if v < n:
                out.append(v)
            else:
                stack += [left[v], right[v]]
        return out

    while todo:
        v, c = todo.pop()
        while True:
            if v < n:
                c.points.append(v)
                break
            lam = 1 / dist[v] if dist[v] > 0 else 1e12
            big = [u for u in (left[v], right[v]) if size[u] >= least]
            if len(big) == 2:
                c.stability += (lam - c.birth) * size[v]
                for u in big:
                    child = _Cluster(lam)
                    c.children.append(child)
                    todo.append((u, child))
                break
            gone = [p for u in (left[v], right[v]) if u not in big for p in leaves(u)]
            c.points += gone
            c.stability += (lam - c.birth) * len(gone)
            if not big:
                break
            v = big[0]
    return root


def selected(root: _Cluster, leaf: bool) -> list[_Cluster]:
    order, stack = [], [root]
    while stack:
        c = stack.pop()
        order.append(c)
        stack += c.children
    if leaf:
        return [c for c in order if not c.children and c is not root]
    best: dict[int, tuple[float, list[_Cluster]]] = {}
    for c in reversed(order):
        below = sum(best[id(k)][0] for k in c.children)
        if c.children and (below > c.stability or c is root):
            best[id(c)] = (below, [x for k in c.children for x in best[id(k)][1]])
        else:
            best[id(c)] = (c.stability, [c] if c is not root else [])
    return best[id(root)][1]


def labels_of(x: np.ndarray, min_cluster_size: int, min_samples: int | None = None, leaf: bool = False) -> np.ndarray:
    """A label for each vector, -1 for noise; clusters are numbered by their first vector."""
    return labels_of_tree(spanning_tree(x, min_samples or min_cluster_size) if len(x) > 1 else np.zeros((0, 3)), len(x), min_cluster_size, leaf)


def labels_of_tree(edges: np.ndarray, n: int, min_cluster_size: int, leaf: bool) -> np.ndarray:
    out = np.full(n, -1)
    if n < min_cluster_size or n < 2:
        return out
    found = []
    for c in selected(condensed(edges, n, min_cluster_size), leaf):
        points, stack = [], [c]
        while stack:
            k = stack.pop()
            points += k.points
            stack += k.children
        found.append(sorted(points))
    for k, points in enumerate(sorted(found)):
        out[points] = k
    return out


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = f"{shared_folder(df.sparkSession)}/hdbscan-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matrix(t: pa.Table) -> np.ndarray:
    return np.asarray(t["x"].combine_chunks().flatten()).astype(np.float64).reshape(len(t), -1)


def _by_pairs(rows: DataFrame, twice: bool) -> DataFrame:
    """rows once for each pair of blocks (i <= j) that theirs is in; twice: also for (i, i) where there are several blocks."""
    other = F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_o")
    out = rows.select("*", other).withColumn("_i", F.least("_b", "_o")).withColumn("_j", F.greatest("_b", "_o"))
    return out if twice else out.filter((F.col("_i") < F.col("_j")) | (F.col("_k") == 1))


def _keys(t: pa.Table, group: list[str], n: int) -> dict[str, pa.Array]:
    return {k: pa.array([t[k][0].as_py()] * n, t.schema.field(k).type) for k in group}


def _same(left: str, right: str, columns: list[str]) -> list:
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in columns]


def neighbours(dealt: DataFrame, group: list[str], min_samples: int) -> DataFrame:
    """group, id, core, floor, near (array of d, id): the nearest others of each; those not listed are at floor or beyond.  dealt: group, id, x, _k, _b."""
    kinds, k = ", ".join(f"`{c}` {dealt.schema[c].dataType.simpleString()}" for c in group), min_samples + MORE

    def near(t: pa.Table) -> pa.Table:
        x, ids, b = _matrix(t), np.asarray(t["id"]), np.asarray(t["_b"])
        d, to = np.full((len(x), k), np.inf), np.full((len(x), k), -1)
        if t["_i"][0] == t["_j"][0]:
            d, to = nearest_of(x, x, k, True)
        else:
            for one in np.unique(b):
                here, there = np.flatnonzero(b == one), np.flatnonzero(b != one)
                if len(there):
                    d[here], at = nearest_of(x[here], x[there], k, False)
                    to[here] = np.where(at < 0, -1, there[at])
        known = to >= 0
        found = pa.StructArray.from_arrays([pa.array(d[known]), pa.array(ids[to[known]])], names=["d", "id"])
        ends = pa.array(np.append(0, np.cumsum(known.sum(1))), pa.int32())
        return pa.table({**{c: t[c] for c in group}, "id": t["id"], "near": pa.ListArray.from_arrays(ends, found)})

    found = _by_pairs(dealt, True).groupBy(*group, "_i", "_j").applyInArrow(near, f"{kinds}, id long, near array<struct<d: double, id: long>>")
    least = found.groupBy(*group, "id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    core = F.coalesce(F.try_element_at("near", F.least(F.size("near"), F.lit(min_samples - 1)))["d"], F.lit(0.0)) if min_samples > 1 else F.lit(0.0)
    core = F.when(F.size("near") > 0, core).otherwise(0.0)
    rows = least.withColumn("core", core)
    floor = F.when(F.size("near") < k, float("inf")).otherwise(F.greatest("core", F.try_element_at("near", F.lit(k))["d"]))
    return rows.select(*group, "id", "core", floor.alias("floor"), "near")


def _forest(edges: DataFrame, group: list[str]) -> DataFrame:
    """The least forest of each group's edges (group, a, b, w), merged a few parts at a time."""
    edges = _stored(edges, "edges")
    schema = ", ".join([*(f"`{c}` {edges.schema[c].dataType.simpleString()}" for c in group), "_slot long, a long, b long, w double"])

    def merged(t: pa.Table) -> pa.Table:
        return t.take(pa.array(least_forest(*(np.asarray(t[k]) for k in ("a", "b", "w")))))

    most = -(-edges.count() // EDGES) or 1
    edges = edges.withColumn("_slot", F.pmod(F.xxhash64("a"), F.lit(most))).select(*group, "_slot", "a", "b", "w")
    while True:
        edges = _stored(edges.groupBy(*group, "_slot").applyInArrow(merged, schema), "merged")
        if most == 1:
            return edges.drop("_slot")
        most = -(-most // FAN)
        edges = edges.withColumn("_slot", F.floor(F.col("_slot") / FAN))


def _alike(rows: DataFrame, group: list[str], min_samples: int) -> DataFrame:
    """group, a, b, w: copies of a vector, if they are min_samples or more, hang on that of the least id at distance 0."""
    first = rows.groupBy(*group, "x").agg(F.min("id").alias("a"), F.count("*").alias("n")).filter(F.col("n") >= max(2, min_samples))
    pairs = rows.alias("r").join(first.alias("f"), _same("r", "f", [*group, "x"])).filter("id <> a")
    return pairs.select(*(f"r.{c}" for c in group), "a", F.col("id").alias("b"), F.lit(0.0).alias("w"))


def spanning_edges(rows: DataFrame, group: list[str], min_samples: int, block: int) -> DataFrame:
    """group, a, b, w: the edges of each group's tree.  rows: group, id, x, all of one length in a group."""
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in group)
    blocks = F.greatest(F.ceil(F.count("*") / block), F.least(F.lit(SPREAD), F.ceil(F.count("*") * SPREAD / block)))
    sizes = rows.groupBy(*group).agg(blocks.cast("int").alias("_k"))
    dealt = rows.alias("r").join(sizes.alias("s"), _same("r", "s", group)).select("r.*", "_k").withColumn("_b", F.pmod(F.xxhash64("id"), F.col("_k")).cast("int"))
    points = _stored(neighbours(dealt, group, min_samples), "near")
    ends = points.select(*group, "id", "core", F.explode("near").alias("to")).alias("r")
    met = ends.join(points.select(*group, F.col("id").alias("other"), F.col("core").alias("far")).alias("o"), [*_same("r", "o", group), F.col("to.id") == F.col("other")])
    listed = met.select(*(f"r.{k}" for k in group), F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), F.greatest("core", "far", "to.d").alias("w"))
    known = _forest(listed, group).withColumn("sure", F.lit(False)).unionByName(_alike(rows, group, min_samples).withColumn("sure", F.lit(True)))
    edges = _stored(known, "known")

    def taken(p: pa.Table, e: pa.Table) -> tuple[np.ndarray, ...]:
        order = np.argsort(np.asarray(p["id"]))
        ids, floor = np.asarray(p["id"])[order], np.asarray(p["floor"])[order]
        return ids, floor, *joined(ids, floor, *(np.asarray(e[c]) for c in ("a", "b", "w", "sure")))

    def parts(p: pa.Table, e: pa.Table) -> pa.Table:
        ids, floor, _, part, least = taken(p, e)
        w, a, b = (np.append(np.asarray(e[c]), none)[least] for c, none in (("w", np.inf), ("a", 0), ("b", 0)))
        asks = (part != np.bincount(part).argmax()) & (floor <= w)
        return pa.table({**_keys(p, group, len(ids)), "id": ids, "_part": ids[part], "asks": asks, "w": w, "a": a, "b": b})

    def tree(p: pa.Table, e: pa.Table) -> pa.Table:
        return e.take(pa.array(taken(p, e)[2])).select([*group, "a", "b", "w"])

    def sought(q: pa.Table, v: pa.Table) -> pa.Table:
        if not (len(q) and len(v)):
            return pa.table({**{c: pa.array([], (q if len(q) else v).schema.field(c).type) for c in group}, "_part": pa.array([], pa.int64()), "w": pa.array([], pa.float64()), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        asked, all_ = ({"x": _matrix(t)} | {c: np.asarray(t[c]) for c in columns} for t, columns in ((q, ("id", "core", "_part", "w", "a", "b")), (v, ("id", "core", "_part"))))
        part, w, a, b = least_leaving(asked, all_)
        return pa.table({**_keys(q, group, len(part)), "_part": part, "w": w, "a": a, "b": b})

    def met_with(f, schema: str) -> DataFrame:
        return points.select(*group, "id", "floor").groupBy(*group).cogroup(edges.groupBy(*group)).applyInArrow(f, f"{kinds}, {schema}")

    while True:
        now = _stored(met_with(parts, "id long, _part long, asks boolean, w double, a long, b long"), "parts")
        if now.filter("asks").isEmpty():
            return met_with(tree, "a long, b long, w double")
        cores = points.select(*group, "id", "core")
        all_ = dealt.alias("r").join(now.alias("n"), _same("r", "n", [*group, "id"])).select("r.*", "_part", "asks", "w", "a", "b")
        all_ = _stored(all_.alias("r").join(cores.alias("c"), _same("r", "c", [*group, "id"])).select("r.*", "core"), "asked")
        many = all_.filter("asks").groupBy(*group).agg(F.ceil(F.count("*") / block).cast("int").alias("_q"))
        with_q = all_.alias("r").join(many.alias("m"), _same("r", "m", group)).select("r.*", "_q")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        q = with_q.filter("asks").withColumn("_i", F.pmod(F.xxhash64("id"), F.col("_q")).cast("int")).withColumn("_j", each("_k"))
        v = with_q.select(*(F.col(c).alias(c) for c in (*group, "id", "x", "core", "_part")), F.col("_b").alias("_j"), F.col("_q").alias("_m")).withColumn("_i", each("_m"))
        keys = [*group, "_i", "_j"]
        found = q.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInArrow(sought, f"{kinds}, _part long, w double, a long, b long")
        found = found.groupBy(*group, "_part").agg(F.min(F.struct("w", "a", "b")).alias("e")).select(*group, "e.a", "e.b", "e.w", F.lit(True).alias("sure"))
        found = _stored(found.distinct(), "found")
        if found.isEmpty():
            raise ValueError("a vector has no finite distance to the others of its group")
        edges = _stored(edges.unionByName(found), "edges")


def clustered(vectors: DataFrame, group: list[str], min_cluster_size: int = 5, min_samples: int | None = 2, leaf: bool = True, block: int = BLOCK) -> DataFrame:
    """group, id, label of every row of vectors (group columns, id, vector).  A cluster's number is within its group.

    An id names one vector of its group, and a group's vectors are of one length; null vectors and those with a null or NaN
    component are noise.
    """
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    by = group or ["_all"]
    rows = vectors.select(*group, "id", doubles(F.col("vector")).alias("x"))
    rows = _stored(rows if group else rows.withColumn("_all", F.lit(0)), "rows")
    known = rows.filter(F.col("x").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v))).withColumn("id", F.col("id").cast("long"))
    edges = spanning_edges(known, by, min_samples or min_cluster_size, block)

    def of(members: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        if len(members) > MAX_GROUP:
            raise ValueError(f"a group has {len(members)} vectors, the most is {MAX_GROUP}: group by more columns")
        members = members.sort_values("id")
        ids = members["id"].to_numpy()
        tree = tree.sort_values(["w", "a", "b"])
        e = np.stack([np.searchsorted(ids, tree["a"]), np.searchsorted(ids, tree["b"]), tree["w"]], axis=1) if len(tree) else np.zeros((0, 3))
        return members.assign(label=labels_of_tree(e, len(ids), min_cluster_size, leaf).astype("int32"))

    schema = ", ".join([*(f"`{k}` {kinds.get(k, 'int')}" for k in [*by, "id"]), "label int"])
    return rows.select(*by, "id").groupBy(*by).cogroup(edges.groupBy(*by)).applyInPandas(of, schema).select(*group, "id", "label")


def numbered(labels: DataFrame, group: list[str], step: int = 1000, least: int = 5) -> DataFrame:
    """Cluster numbers of their own for each group: step times the group's place among those of `least` rows or more."""
    from pyspark.sql import Window

    sizes = labels.groupBy(*group).count().filter(F.col("count") >= least)
    place = sizes.withColumn("_o", F.dense_rank().over(Window.orderBy(*group)) - 1).drop("count")
    return labels.join(place, group, "left").withColumn("cluster_id", F.when(F.col("label") < 0, -1).otherwise(F.col("label") + F.col("_o") * step).cast("int")).drop("_o")
