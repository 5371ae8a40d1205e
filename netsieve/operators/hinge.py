"""One-vs-rest linear SVMs, of mapped features too, by L-BFGS.

The objective of a class is mean hinge loss + |w|^2 / (2 C n), the intercept free.  A step is one
Arrow pass over the plain rows that returns loss and gradient of all classes as sums of a task:
the mapped features (random Fourier features) are made a slice at a time inside the pass and
kept nowhere, so a fit stores its plain rows and nothing else.
"""

from __future__ import annotations

import math
from collections.abc import Generator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .logistic import _sums

MEMORY = 10                      # steps whose curvature is remembered
TRIALS = 12                      # step sizes tried along a direction
TOL = 1e-6                       # decrease of the objective over MEMORY steps, relative, that ends the fit
SLICE = 4096                     # rows whose mapped features exist at once


def as_array(df: DataFrame, features: str) -> Column:
    kind = df.schema[features].dataType.typeName()
    return F.col(features).cast("array<double>") if kind == "array" else vector_to_array(features)


def _slices(x: np.ndarray, mapper):
    """(rows, mapped features and a column of ones) of ``x``, SLICE rows at a time."""
    for at in range(0, len(x), SLICE):
        rows = slice(at, min(at + SLICE, len(x)))
        z = x[rows]
        if mapper is not None:
            w, b = mapper
            z = math.sqrt(2.0 / len(w)) * np.cos(z @ w.T + b)
        yield rows, np.concatenate([z, np.ones((len(z), 1))], axis=1)


def lbfgs(x: np.ndarray, steps: int) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Minimise: yields points, is sent (value, gradient) of each, returns the last point taken.  The step
    size is bisected until it meets the weak Wolfe conditions, which a hinge loss allows for."""
    f, g = yield x
    pairs: list = []
    past = [f]
    for _ in range(steps):
        if np.abs(g).max() <= 1e-12:
            break
        d, back = -g, []
        for s, y, r in reversed(pairs):
            a = r * (s @ d)
            d = d - a * y
            back.append(a)
        if pairs:
            s, y, r = pairs[-1]
            d = d / (r * (y @ y))
        for (s, y, r), a in zip(pairs, reversed(back)):
            d = d + (a - r * (y @ d)) * s
        if g @ d >= 0:
            pairs, d = [], -g
        slope, low, high = g @ d, 0.0, math.inf
        t = 1.0 if pairs else 1.0 / np.linalg.norm(g)
        for _ in range(TRIALS):
            value, grad = yield x + t * d
            size = t
            if value > f + 1e-4 * t * slope:
                high = t
            elif grad @ d < 0.9 * slope:
                low = t
            else:
                break
            t = (low + high) / 2 if high < math.inf else 2 * t
        else:
            if not value < f:
                break
        s, y = size * d, grad - g
        if s @ y > 1e-12 * (y @ y):
            pairs = (pairs + [(s, y, 1.0 / (s @ y))])[-MEMORY:]
        x, f, g = x + s, value, grad
        past.append(f)
        if len(past) > MEMORY and past[-1 - MEMORY] - f <= TOL * abs(f):
            break
    return x


def fit_hinge(df: DataFrame, features: str, label: str, c: float, max_iter: int, mapper=None) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients classes x mapped features, intercepts) of one SVM a class index, 0 to the largest."""
    rows = df.where(F.col(label).isNotNull()).select(as_array(df, features).alias("x"), F.col(label).cast("double").alias("y")).persist()
    try:
        got = rows.agg(F.max("y").alias("top"), F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
        if not got["n"]:
            raise ValueError("no rows to fit")
        k, n = int(got["top"]) + 1, got["n"]
        width = (got["d"] if mapper is None else len(mapper[0])) + 1
        ridge = np.append(np.full(width - 1, 1.0 / (c * max(n, 1))), 0.0)

        def evaluate(points: np.ndarray, of: np.ndarray) -> list[tuple[float, np.ndarray]]:
            def part(x, y):
                out = np.zeros((len(of), 1 + width))
                for at, z in _slices(x, mapper):
                    sign = np.where(y[at][:, None] == of[None], 1.0, -1.0)
                    short = 1.0 - sign * (z @ points.T)
                    out[:, 0] += np.maximum(short, 0.0).sum(axis=0)
                    out[:, 1:] -= np.where(short > 0, sign, 0.0).T @ z
                return out.ravel()

            s = _sums(rows, part, len(of) * (1 + width)).reshape(len(of), -1) / n
            return [(v[0] + 0.5 * (ridge * w * w).sum(), v[1:] + ridge * w) for v, w in zip(s, points)]

        fits = {i: lbfgs(np.zeros(width), max_iter) for i in range(k)}
        at, done = {i: next(fit) for i, fit in fits.items()}, {}
        while at:                                                # every fit under way shares a pass
            ids = list(at)
            for i, value in zip(ids, evaluate(np.stack([at[i] for i in ids]), np.array(ids, float))):
                try:
                    at[i] = fits[i].send(value)
                except StopIteration as end:
                    done[i] = end.value
                    del at[i]
    finally:
        rows.unpersist()
    w = np.stack([done[i] for i in range(k)])
    return w[:, :-1], w[:, -1]


def margins_udf(w: np.ndarray, b: np.ndarray, mapper=None):
    """Margins of the classes from a column of plain features, a batch at a time."""
    full = np.concatenate([w, b[:, None]], axis=1)

    @F.arrow_udf("array<double>")
    def margins(v: pa.Array) -> pa.Array:
        x = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(v), -1)
        out = np.zeros((len(x), len(full)))
        for at, z in _slices(x, mapper):
            out[at] = z @ full.T
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(full)), pa.array(out.ravel()))
    return margins
