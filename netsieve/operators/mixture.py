"""Gaussian mixtures of all classes by EM, one Arrow pass an iteration.

A pass returns, for every class and component at once, the sums that the next parameters need:
responsibilities, and first and second moments about the present mean (centred, so that nothing
large cancels).  They are added in two levels like the sums of the logistic regression; the
driver holds the parameters alone (classes x components x features squared).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .logistic import _sums

START_ROWS = 2_000               # of a class, for the start alone; EM reads every row
LLOYD_ROUNDS = 20
FLOOR = 1e-14                    # of a covariance's largest eigenvalue
TINY = 1e-300


class Gaussians:
    """Weights, means and covariances of the components of one class."""

    def __init__(self, weights, means, covs):
        self.weights, self.means, self.covs = (np.asarray(v, float) for v in (weights, means, covs))
        vals, vecs = np.linalg.eigh(self.covs)
        vals = np.maximum(vals, np.maximum(vals[:, -1:] * FLOOR, TINY))
        self.white = vecs / np.sqrt(vals)[:, None, :]
        self.norm = np.log(np.maximum(self.weights, TINY)) - 0.5 * (
            np.log(vals).sum(axis=1) + self.means.shape[1] * np.log(2 * np.pi))

    def joint(self, x: np.ndarray) -> np.ndarray:
        """log(weight * density), rows x components."""
        out = np.empty((len(x), len(self.weights)))
        for j, (mean, white) in enumerate(zip(self.means, self.white)):
            z = (x - mean) @ white
            out[:, j] = self.norm[j] - 0.5 * (z * z).sum(axis=1)
        return out

    def sums(self, x: np.ndarray) -> np.ndarray:
        """[log likelihood, then per component: responsibility, first and second moments about its mean]."""
        joint = self.joint(x)
        top = joint.max(axis=1, keepdims=True)
        share = np.exp(joint - top)
        total = share.sum(axis=1, keepdims=True)
        share /= total
        out = [np.array([(top + np.log(total)).sum()])]
        for j, mean in enumerate(self.means):
            c = x - mean
            r = c * share[:, j:j + 1]
            out += [share[:, j].sum(keepdims=True), r.sum(axis=0), (r.T @ c).ravel()]
        return np.concatenate(out)

    def width(self) -> int:
        k, d = self.means.shape
        return 1 + k * (1 + d + d * d)

    def updated(self, s: np.ndarray, reg: float) -> "Gaussians":
        """The next parameters from the sums of all rows; a component without rows stays where it is."""
        k, d = self.means.shape
        s = s[1:].reshape(k, -1)
        n = s[:, 0]
        means, covs = self.means.copy(), self.covs.copy()
        for j in np.flatnonzero(n > 1e-12):
            shift = s[j, 1:1 + d] / n[j]
            means[j] += shift
            covs[j] = s[j, 1 + d:].reshape(d, d) / n[j] - np.outer(shift, shift) + reg * np.eye(d)
        return Gaussians(n / n.sum(), means, (covs + covs.transpose(0, 2, 1)) / 2)


def fit_mixtures(rows: DataFrame, start: dict, reg: float = 1e-6, max_iter: int = 100, tol: float = 1e-3) -> dict:
    """EM over ``rows`` (an array of features, a class number) from ``start``, {class: Gaussians}.

    Every class steps in the same pass.  One is finished after ``max_iter`` steps, or when its mean log
    likelihood gains less than ``tol`` in a step (one component: after the first, which is exact).
    Returns {class: Gaussians}."""
    now, last = dict(start), dict.fromkeys(start, -np.inf)
    open_ = sorted(start)
    for _ in range(max_iter):
        if not open_:
            break
        at = np.cumsum([0] + [1 + now[c].width() for c in open_])
        classes, mixtures = np.array(open_), [now[c] for c in open_]

        def part(x, y):
            out = np.zeros(at[-1])
            for i, c in enumerate(classes):
                mine = x[y == c]
                if len(mine):
                    out[at[i]] = len(mine)
                    out[at[i] + 1:at[i + 1]] = mixtures[i].sums(mine)
            return out

        s = _sums(rows, part, int(at[-1]))
        still = []
        for i, c in enumerate(open_):
            n, mine = s[at[i]], s[at[i] + 1:at[i + 1]]
            if not n:
                continue
            mean = mine[0] / n
            now[c] = now[c].updated(mine, reg)
            if len(now[c].weights) > 1 and not mean - last[c] < tol:
                still.append(c)
            last[c] = mean
        open_ = still
    return now


def _seeded(x: np.ndarray, k: int, rng) -> np.ndarray:
    """Cluster numbers of k-means with spread-out starting rows."""
    centres = x[[rng.integers(len(x))]]
    while len(centres) < k:
        far = ((x[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1)
        if not far.sum():
            break                                         # fewer different rows than components
        centres = np.vstack([centres, x[rng.choice(len(x), p=far / far.sum())]])
    for _ in range(LLOYD_ROUNDS):
        of = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.stack([x[of == j].mean(axis=0) if (of == j).any() else c for j, c in enumerate(centres)])
        if np.array_equal(moved, centres):
            break
        centres = moved
    return ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)


def starts(rows: DataFrame, k: int, reg: float = 1e-6, seed: int = 42) -> dict:
    """{class: Gaussians} to begin with: k-means (features scaled to unit variance) over at most
    START_ROWS rows a class, those first in a hash order.  A class gets at most as many components as
    it has different rows there.  Equal tables give equal starts, however they are partitioned."""
    x, y = rows.columns[:2]
    order = F.xxhash64(x, F.lit(seed))
    picked = (rows.withColumn("_h", order)
              .withColumn("_r", F.row_number().over(Window.partitionBy(y).orderBy("_h", x)))
              .where(F.col("_r") <= START_ROWS).select(x, y, "_r").orderBy(y, "_r").toArrow())
    if not picked.num_rows:
        raise ValueError("no rows to fit")
    flat = pa.concat_arrays(picked.column(0).chunks).flatten().to_numpy(zero_copy_only=False)
    xs, ys = flat.reshape(picked.num_rows, -1).astype(float), picked.column(1).to_numpy()
    out = {}
    for c in np.unique(ys):
        mine = xs[ys == c]
        scale = mine.std(axis=0)
        of = _seeded(mine / np.where(scale > 0, scale, 1.0), min(k, len(mine)), np.random.default_rng(seed))
        groups = [mine[of == j] for j in np.unique(of)]
        d = mine.shape[1]
        out[float(c)] = Gaussians([len(g) / len(mine) for g in groups], [g.mean(axis=0) for g in groups],
                                  [np.cov(g.T, bias=True).reshape(d, d) + reg * np.eye(d) for g in groups])
    return out
