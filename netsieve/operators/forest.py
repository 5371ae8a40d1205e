"""Decision forest: distributed histograms for the top levels, whole subtrees below.

All trees grow at once.  While a node has more than HANDOFF rows (counted with their bootstrap
weights' rows), its split comes from histograms over BINS quantile bins a feature: tasks send
partial counts by (tree, node, feature, bin, class), which are added before the best split of
each node reaches the driver, one row a node.  A node with fewer rows is handed off: its rows
are sent to one task, which grows the rest of the subtree exactly, on the values themselves, to
any depth.  Bootstrap weights (Poisson) and feature subsets come from hashes of tree, row key
and node, so they are the same on every attempt.  Handing off sends each row once a tree; a
forest whose depth ends before its nodes are that small sends none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..session import checkpoint_root

HANDOFF = 20_000                 # rows of a node up to which one task finishes its subtree
BINS = 64                        # of a feature in the histograms
NODES_A_PASS = 4096              # nodes whose histograms are made in one pass over the rows
_U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = np.asarray(h, np.uint64)
        h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
        return h ^ (h >> _U(31))


def _uniform(*parts) -> np.ndarray:
    """Numbers in (0, 1] from hashes of integers (arrays or scalars)."""
    h = _U(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for p in parts:
            h = _mix(h + np.asarray(p).astype(np.uint64) * _U(0xD1342543DE82EF95) + _U(1))
    return ((h >> _U(11)).astype(np.float64) + 1) / 2**53


_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])


def bootstrap(seed: int, tree: int, keys: np.ndarray) -> np.ndarray:
    """Times each row is drawn for a tree: Poisson with mean 1."""
    return np.searchsorted(_POISSON, _uniform(seed, tree, keys), side="left").astype(np.int64)


def subset(seed: int, tree: int, node: int, d: int, m: int) -> np.ndarray:
    """The features that a node may split on."""
    if m >= d:
        return np.arange(d)
    return np.sort(np.argsort(_uniform(seed, tree, _U(node % 2**64), np.arange(d)), kind="stable")[:m])


def impurity(counts: np.ndarray, kind: str) -> np.ndarray:
    """Weighted impurity (impurity times weight) of class counts along the last axis."""
    n = counts.sum(axis=-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        p = counts / n[..., None]
        if kind == "entropy":
            i = -np.nansum(np.where(p > 0, p * np.log2(p), 0.0), axis=-1)
        else:
            i = 1 - np.nansum(p * p, axis=-1)
    return np.where(n > 0, i * n, 0.0)


def best_split(left: np.ndarray, total: np.ndarray, kind: str, leaf: int):
    """(place, gain) of the best of several cuts, given the class counts left of each, or None; ties
    go to the first."""
    right = total - left
    ok = (left.sum(axis=1) >= leaf) & (right.sum(axis=1) >= leaf)
    if not ok.any():
        return None
    gain = impurity(total, kind) - impurity(left, kind) - impurity(right, kind)
    gain = np.where(ok, gain, -np.inf)
    slack = 1e-9 * max(1.0, total.sum())         # gains that differ by rounding are equal
    at = int(np.flatnonzero(gain >= gain.max() - slack)[0])
    return (at, float(gain[at])) if gain[at] > slack else None


class Grower:
    """Settings of a tree's growth."""

    def __init__(self, classes: int, kind="gini", depth=None, split=2, leaf=1, features=None, seed=42):
        self.classes, self.kind, self.depth = classes, kind, depth
        self.split, self.leaf, self.features, self.seed = split, leaf, features, seed

    def stop(self, counts: np.ndarray, depth: int) -> bool:
        n = counts.sum()
        return (self.depth is not None and depth >= self.depth) or n < max(2, self.split) or n < 2 * self.leaf or counts.max() == n

    def grow(self, x: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, root: int, depth: int) -> list[tuple]:
        """Nodes of a subtree as (node, feature, threshold, counts, gain), feature -1 for a leaf; the children
        of node n are 2n and 2n + 1 (Python integers: depth has no bound)."""
        out, work = [], [(root, depth, np.flatnonzero(w > 0))]
        while work:
            node, depth, rows = work.pop()
            counts = np.bincount(y[rows], weights=w[rows], minlength=self.classes)
            found = None if self.stop(counts, depth) else self.exact(x, y, w, rows, counts, subset(
                self.seed, tree, node, x.shape[1], self.features or x.shape[1]))
            if found is None:
                out.append((node, -1, 0.0, counts.tolist(), 0.0))
                continue
            f, cut, gain = found
            out.append((node, int(f), cut, counts.tolist(), gain))
            goes = x[rows, f] <= cut
            work += [(2 * node, depth + 1, rows[goes]), (2 * node + 1, depth + 1, rows[~goes])]
        return out

    def exact(self, x, y, w, rows, counts, features):
        """(feature, threshold, gain) of the best cut between two values, or None; ties go to the smaller
        feature, then to the smaller threshold."""
        best = None
        one = np.zeros((len(rows), self.classes))
        for f in features:
            v = x[rows, f]
            o = np.argsort(v, kind="stable")
            s = v[o]
            cut = np.flatnonzero(s[1:] > s[:-1])
            if not len(cut):
                continue
            one[:] = 0
            one[np.arange(len(o)), y[rows[o]]] = w[rows[o]]
            found = best_split(np.cumsum(one, axis=0)[cut], counts, self.kind, self.leaf)
            if found and (best is None or found[1] > best[2] + 1e-9 * max(1.0, counts.sum())):
                a, b = s[cut[found[0]]], s[cut[found[0]] + 1]
                middle = a + (b - a) / 2
                best = (int(f), float(a if not a <= middle < b else middle), found[1])
        return best


def route(tree: dict, x: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Node (as object integers) that each row reaches in ``tree``: node -> (feature, threshold)."""
    out = np.empty(len(x), object)
    work = [(1, np.arange(len(x)))]
    while work:
        node, rows = work.pop()
        if not len(rows):
            continue
        f, cut = tree.get(node, (-1, 0.0))
        if f < 0:
            out[rows] = node
            continue
        goes = x[rows, f] <= cut
        work += [(2 * node, rows[goes]), (2 * node + 1, rows[~goes])]
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _bin_edges(rows: DataFrame, d: int) -> list[np.ndarray]:
    """At most BINS - 1 distinct cut values a feature, from a quantile sketch of all rows."""
    share = [i / BINS for i in range(1, BINS)]
    got = rows.agg(*[F.percentile_approx(F.col("x")[i], share, 10_000).alias(f"q{i}") for i in range(d)]).first()
    return [np.unique(np.array(got[f"q{i}"], float)) for i in range(d)]


def fit_forest(df: DataFrame, features: str, label: str, trees: int, g: Grower, bootstrap_rows: bool = True, handoff: int = HANDOFF):
    """(classes, trees): each tree maps a node to (feature, threshold, class counts, gain).  Rows with a null
    label or null features are left out."""
    kind = df.schema[features].dataType.typeName()
    x = F.col(features).cast("array<double>") if kind == "array" else vector_to_array(features)
    rows = (df.where(F.col(features).isNotNull() & F.col(label).isNotNull())
            .select(x.alias("x"), F.col(label).cast("double").alias("y")))
    # numbered once and written: a lost executor must not draw other rows
    checkpoint_root(df.sparkSession)
    rows = rows.withColumn("k", F.monotonically_increasing_id()).checkpoint()
    n = rows.count()
    if not n:
        raise ValueError("no rows to fit")
    classes = np.array(sorted(r["y"] for r in rows.select("y").distinct().collect()))
    g.classes = len(classes)
    d = len(rows.first()["x"])
    if g.features == "sqrt":
        g.features = max(1, math.isqrt(d))
    elif isinstance(g.features, float):
        g.features = max(1, int(g.features * d))
    out: list[dict] = [{} for _ in range(trees)]
    if n <= handoff:
        ready = [(t, 1) for t in range(trees)]
    else:
        ready = _top(rows, d, classes, trees, g, bootstrap_rows, handoff, out, _bin_edges(rows, d))
    for t, node, f, cut, counts, gain in _subtrees(rows, classes, g, bootstrap_rows, out, ready):
        out[t][int(node)] = (f, cut, counts, gain)
    return classes, out


def _splits(tree: dict) -> dict:
    return {node: v[:2] for node, v in tree.items()}


def _top(rows, d, classes, trees, g, boot, handoff, out, edges) -> list:
    """Split nodes of more than ``handoff`` rows by histograms, level by level; returns the nodes to hand off."""
    live, ready, level = [(t, 1) for t in range(trees)], [], 0
    width = BINS * g.classes
    while live:
        grown = []
        for at in range(0, len(live), NODES_A_PASS):
            now = live[at:at + NODES_A_PASS]
            number = {tn: i for i, tn in enumerate(now)}
            trees_now = {t: _splits(out[t]) for t, _ in now}
            sub = {i: subset(g.seed, t, node, d, g.features or d) for (t, node), i in number.items()}

            def count(batches):
                total: dict = {}
                seen = np.zeros(len(now), np.int64)
                for b in batches:
                    if not b.num_rows:
                        continue
                    x, y = _matrix(b.column(0)), np.searchsorted(classes, b.column(1).to_numpy(zero_copy_only=False))
                    keys = b.column(2).to_numpy(zero_copy_only=False)
                    bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
                    for t, splits in trees_now.items():
                        w = bootstrap(g.seed, t, keys) if boot else np.ones(len(y), np.int64)
                        node_of = route(splits, x)
                        for node in set(node_of):
                            i = number.get((t, node))
                            if i is None:
                                continue
                            r = np.flatnonzero(node_of == node)
                            seen[i] += int((w[r] > 0).sum())
                            h = total.setdefault(i, np.zeros((len(sub[i]), width), np.int64))
                            for j, f in enumerate(sub[i]):
                                h[j] += np.bincount(bins[r, f] * g.classes + y[r], weights=w[r], minlength=width).astype(np.int64)
                ids = sorted(total)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([int(seen[i]) for i in ids], pa.int64()),
                                                  pa.array([total[i].tobytes() for i in ids], pa.binary())], names=["i", "seen", "h"])

            def best(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                seen, h = 0, None
                for b in batches:
                    for s, raw in zip(b.column(1).to_pylist(), b.column(2)):
                        part = np.frombuffer(raw.as_buffer(), np.int64)
                        seen, h = seen + s, part.copy() if h is None else h + part
                i = key[0].as_py()
                h = h.reshape(len(sub[i]), BINS, g.classes)
                counts, found = h[0].sum(axis=0), None
                for j, f in enumerate(sub[i]):
                    left = np.cumsum(h[j], axis=0)[:len(edges[f])]
                    s = best_split(left, counts, g.kind, g.leaf) if len(left) else None
                    if s and (found is None or s[1] > found[2] + 1e-9 * max(1.0, counts.sum())):
                        found = (int(f), float(edges[f][s[0]]), s[1])
                f, cut, gain = found or (-1, 0.0, 0.0)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([seen], pa.int64()), pa.array([f], pa.int32()),
                                                  pa.array([cut]), pa.array([gain]), pa.array([counts.astype(float).tolist()])],
                                                 names=["i", "seen", "f", "cut", "gain", "counts"])

            got = (rows.mapInArrow(count, "i int, seen long, h binary").groupBy("i")
                   .applyInArrow(best, "i int, seen long, f int, cut double, gain double, counts array<double>").collect())
            for r in got:
                t, node = now[r["i"]]
                counts = np.array(r["counts"])
                if r["seen"] <= handoff and not g.stop(counts, level):
                    ready.append((t, node))
                elif g.stop(counts, level) or r["f"] < 0:
                    out[t][node] = (-1, 0.0, counts.tolist(), 0.0)
                else:
                    out[t][node] = (r["f"], r["cut"], counts.tolist(), r["gain"])
                    grown += [(t, 2 * node), (t, 2 * node + 1)]
        live, level = grown, level + 1
    return ready


def _subtrees(rows, classes, g, boot, out, ready):
    """Grow the handed-off nodes, each in one task; yields (tree, node, feature, threshold, counts, gain)."""
    wanted = {}
    for i, (t, node) in enumerate(ready):
        wanted.setdefault(t, {})[node] = i
    if not wanted:
        return
    splits = {t: _splits(out[t]) for t in wanted}

    def send(batches):
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(2).to_numpy(zero_copy_only=False)
            x = _matrix(b.column(0))
            for t, nodes in wanted.items():
                w = bootstrap(g.seed, t, keys) if boot else np.ones(len(keys), np.int64)
                node_of = route(splits[t], x) if splits[t] else np.full(len(x), 1, object)
                to = np.array([nodes.get(v, -1) for v in node_of])
                r = np.flatnonzero((w > 0) & (to >= 0))
                if len(r):
                    idx = pa.array(r)
                    yield pa.RecordBatch.from_arrays([pa.array(to[r].astype(np.int32)), b.column(0).take(idx), b.column(1).take(idx), b.column(2).take(idx),
                                                      pa.array(w[r])], names=["i", "x", "y", "k", "w"])

    def finish(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        x = np.concatenate([_matrix(b.column(1)) for b in parts])
        y = np.searchsorted(classes, np.concatenate([b.column(2).to_numpy(zero_copy_only=False) for b in parts]))
        k = np.concatenate([b.column(3).to_numpy(zero_copy_only=False) for b in parts])
        w = np.concatenate([b.column(4).to_numpy(zero_copy_only=False) for b in parts]).astype(float)
        o = np.argsort(k, kind="stable")                         # the order of rows decides nothing
        i = key[0].as_py()
        t, node = ready[i]
        nodes = g.grow(x[o], y[o], w[o], t, node, int(node).bit_length() - 1)
        yield pa.RecordBatch.from_arrays([pa.array([t] * len(nodes), pa.int32()), pa.array([str(v[0]) for v in nodes]), pa.array([v[1] for v in nodes], pa.int32()),
                                          pa.array([v[2] for v in nodes], pa.float64()), pa.array([v[3] for v in nodes], pa.list_(pa.float64())),
                                          pa.array([v[4] for v in nodes], pa.float64())], names=["t", "node", "f", "cut", "counts", "gain"])

    done = (rows.mapInArrow(send, "i int, x array<double>, y double, k long, w long").groupBy("i")
            .applyInArrow(finish, "t int, node string, f int, cut double, counts array<double>, gain double"))
    for r in done.toLocalIterator():
        yield r["t"], r["node"], r["f"], r["cut"], r["counts"], r["gain"]


class ForestModel:
    """Trees by node; ``scores`` are the mean class shares of the leaves reached."""

    def __init__(self, features: str, classes, trees):
        self.features, self.class_values, self.trees = features, np.asarray(classes, float), trees

    def _flat(self):
        """Trees as arrays: feature, threshold, left child, right child, class shares."""
        flat = []
        for tree in self.trees:
            order = sorted(tree, key=lambda v: (v.bit_length(), v))
            number = {node: i for i, node in enumerate(order)}
            f = np.array([tree[v][0] for v in order], np.int32)
            shares = np.array([np.array(tree[v][2]) / max(1e-300, sum(tree[v][2])) for v in order])
            flat.append((f, np.array([tree[v][1] for v in order]), np.array([number.get(2 * v, 0) for v in order], np.int32),
                         np.array([number.get(2 * v + 1, 0) for v in order], np.int32), shares))
        return flat

    def transform(self, df: DataFrame) -> DataFrame:
        flat, classes = df.sparkSession.sparkContext.broadcast(self._flat()), self.class_values
        width = int(classes.max()) + 1 if (classes == classes.astype(int)).all() and classes.min() >= 0 else None

        @F.arrow_udf("array<double>")
        def score(v: pa.Array) -> pa.Array:
            x = _matrix(v)
            total = np.zeros((len(x), len(classes)))
            for f, cut, left, right, shares in flat.value:
                at = np.zeros(len(x), np.int32)
                while (on := np.flatnonzero(f[at] >= 0)).size:
                    a = at[on]
                    at[on] = np.where(x[on, f[a]] <= cut[a], left[a], right[a])
                total += shares[at]
            total /= len(flat.value)
            if width is not None and width != len(classes):
                wide = np.zeros((len(x), width))
                wide[:, classes.astype(int)] = total
                total = wide
            return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * total.shape[1]), pa.array(total.ravel()))

        kind = df.schema[self.features].dataType.typeName()
        x = F.col(self.features).cast("array<double>") if kind == "array" else vector_to_array(self.features)
        out = df.withColumn("scores", score(x))
        at = F.array_position("scores", F.array_max("scores"))
        number = (at - 1).cast("double") if width is not None else F.element_at(F.array(*[F.lit(float(c)) for c in classes]), at.cast("int"))
        return out.withColumn("prediction", number)

    def feature_importance(self) -> np.ndarray:
        """Mean decrease of impurity, each tree's adding up to 1, then their mean adding up to 1."""
        d = 1 + max((v[0] for t in self.trees for v in t.values()), default=0)
        total = np.zeros(d)
        for t in self.trees:
            one = np.zeros(d)
            for f, _, _, gain in t.values():
                if f >= 0:
                    one[f] += gain
            total += one / one.sum() if one.sum() else one
        return total / total.sum() if total.sum() else total

    def state(self) -> dict:
        return {"features": self.features, "classes": self.class_values.tolist(),
                "trees": [[[str(v), *t[v]] for v in sorted(t)] for t in self.trees]}

    @classmethod
    def from_state(cls, state: dict) -> "ForestModel":
        return cls(state["features"], state["classes"], [{int(v): (f, cut, counts, gain) for v, f, cut, counts, gain in t} for t in state["trees"]])
