"""Multinomial logistic regression by Newton steps.

The objective is C * sum(loss) + |w|^2 / 2 (intercepts free).  Features are centred and scaled
inside, which changes nothing but the numbers' size: the penalty is rescaled with them.  A step
is one Arrow pass over the rows that returns loss, gradient and Hessian as sums of a task, added
in two levels so that the driver gets about the square root of the partitions; where the
Hessian would be too large, conjugate gradients solve for the step with one pass a product.
A handful of steps reaches the optimum to rounding.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

HESSIAN = 1500                   # classes x (features + 1) up to which the Hessian is formed
CG_STEPS = 200
CG_TOL = 1e-8
HALVINGS = 30
CONVERGED = 1e-9                 # largest component of the gradient of the mean loss


def _rows(batch: pa.RecordBatch):
    """(features, label) of a batch."""
    x = batch.column(0)
    n = batch.num_rows
    flat = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1), batch.column(1).to_numpy(zero_copy_only=False)


def _sums(rows: DataFrame, part, width: int) -> np.ndarray:
    """Sum over all rows of ``part(x, y)`` (a vector of ``width``)."""
    def first(batches):
        total = np.zeros(width)
        for b in batches:
            if b.num_rows:
                total += part(*_rows(b))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    def add(batches):
        total = np.zeros(width)
        for b in batches:
            for x in b.column(0):
                total += np.frombuffer(x.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    n = rows.rdd.getNumPartitions()
    out = rows.mapInArrow(first, "s binary")
    if n > 16:
        out = out.repartition(math.isqrt(n)).mapInArrow(add, "s binary")
    return sum(np.frombuffer(r["s"]) for r in out.collect())


def _probabilities(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class probabilities, log of their normaliser) of margins."""
    top = z.max(axis=1, keepdims=True)
    e = np.exp(z - top)
    s = e.sum(axis=1, keepdims=True)
    return e / s, (top + np.log(s))[:, 0]


def _design(mean, scale, x):
    """Scaled features and a column of ones."""
    return np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1)


class _Problem:
    """The objective over the rows, in scaled features: coefficients as classes x (features + 1)."""

    def __init__(self, rows: DataFrame, classes: np.ndarray, mean, scale, c: float, penalised: bool, n: int):
        self.rows, self.classes, self.mean, self.scale = rows, classes, mean, scale
        self.k, self.d = len(classes), len(mean) + 1
        # of the mean loss; a scaled coefficient is scale times the plain one
        ridge = np.append(1.0 / scale ** 2, 0.0) / (c * n) if penalised else np.zeros(self.d)
        self.ridge, self.n = np.tile(ridge, (self.k, 1)), n

    def evaluate(self, w: np.ndarray, hessian: bool):
        """(objective, gradient, Hessian or None) at ``w``, all of the mean loss with the penalty."""
        k, d, classes, design = self.k, self.d, self.classes, partial(_design, self.mean, self.scale)
        p_all = k * d

        def part(x, y):
            a = design(x)
            z = a @ w.T
            p, norm = _probabilities(z)
            of = np.searchsorted(classes, y)
            out = [np.array([(norm - z[np.arange(len(y)), of]).sum()])]
            r = p.copy()
            r[np.arange(len(y)), of] -= 1
            out.append((r.T @ a).ravel())
            if hessian:
                h = np.empty((k, d, k, d))
                for i in range(k):
                    for j in range(i + 1):
                        q = p[:, i] * ((i == j) - p[:, j])
                        h[i, :, j] = h[j, :, i] = a.T @ (a * q[:, None])
                out.append(h.reshape(-1))
            return np.concatenate(out)

        s = _sums(self.rows, part, 1 + p_all + (p_all * p_all if hessian else 0)) / self.n
        loss = s[0] + 0.5 * (self.ridge * w * w).sum()
        grad = s[1:1 + p_all].reshape(k, d) + self.ridge * w
        return loss, grad, s[1 + p_all:].reshape(p_all, p_all) + np.diag(self.ridge.ravel()) if hessian else None

    def times(self, w: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Hessian at ``w`` times ``v``."""
        design = partial(_design, self.mean, self.scale)

        def part(x, y):
            a = design(x)
            p, _ = _probabilities(a @ w.T)
            u = p * (a @ v.T)
            u -= p * u.sum(axis=1, keepdims=True)
            return (u.T @ a).ravel()
        return _sums(self.rows, part, self.k * self.d).reshape(self.k, self.d) / self.n + self.ridge * v

    def step(self, w, grad, h) -> np.ndarray:
        if h is not None:
            # classes may be shifted together for nothing: the smallest of the equal steps
            return -np.linalg.lstsq(h, grad.ravel(), rcond=1e-13)[0].reshape(grad.shape)
        x, r = np.zeros_like(grad), -grad
        q, rr = r.copy(), (r * r).sum()
        stop = CG_TOL ** 2 * rr
        for _ in range(CG_STEPS):
            if rr <= stop:
                break
            hq = self.times(w, q)
            curve = (q * hq).sum()
            if curve <= 0:
                break
            x += rr / curve * q
            r -= rr / curve * hq
            new = (r * r).sum()
            q, rr = r + new / rr * q, new
        return x


def fit_multinomial(df: DataFrame, features: str, label: str, c: float = 1.0, penalised: bool = True,
                    max_iter: int = 100, tol: float = 1e-4):
    """(classes, coefficients classes x features, intercepts, steps).  Rows with a null label or null
    features are left out.  Of equal optima the one whose intercepts (without a penalty, whose
    coefficients too) add up to 0 over the classes is returned; a constant feature gets 0."""
    kind = df.schema[features].dataType.typeName()
    x = F.col(features).cast("array<double>") if kind == "array" else vector_to_array(features)
    rows = df.where(F.col(features).isNotNull() & F.col(label).isNotNull()).select(x.alias("x"), F.col(label).cast("double").alias("y"))
    rows = rows.persist()
    try:
        first = rows.first()
        if first is None:
            raise ValueError("no rows to fit")
        classes = np.array(sorted(r["y"] for r in rows.select("y").distinct().collect()))
        d = len(first["x"])
        s = _sums(rows, lambda x, y: np.concatenate([[len(x)], x.sum(axis=0)]), 1 + d)
        n, mean = int(s[0]), s[1:] / s[0]
        scale = np.sqrt(_sums(rows, lambda x, y: ((x - mean) ** 2).sum(axis=0), d) / n)
        constant = scale <= 1e-12 * np.maximum(1.0, np.abs(mean))
        scale = np.where(constant, 1.0, scale)
        p = _Problem(rows, classes, mean, scale, c, penalised, n)
        w = np.zeros((len(classes), d + 1))
        form = w.size <= HESSIAN
        loss, grad, h = p.evaluate(w, form)
        steps = 0
        while steps < max_iter and len(classes) > 1 and np.abs(grad).max() > min(tol, CONVERGED):
            move = p.step(w, grad, h)
            slope, size = (grad * move).sum(), 1.0
            for _ in range(HALVINGS):
                new = p.evaluate(w + size * move, form)
                if new[0] <= loss + 1e-4 * size * slope:
                    break
                size /= 2
            else:
                break                                            # no smaller objective in floating point
            w, (loss, grad, h) = w + size * move, new
            steps += 1
    finally:
        rows.unpersist()
    plain = np.where(constant, 0.0, w[:, :-1] / scale)
    if not penalised:
        plain = plain - plain.mean(axis=0)
    bias = w[:, -1] - (w[:, :-1] / scale) @ mean
    return classes, plain, bias - bias.mean(), steps


class LogisticModel:
    """Coefficients by class; ``scores`` are the class probabilities by class index."""

    def __init__(self, features: str, classes, coefficients, intercepts, steps: int = 0):
        self.features, self.class_values = features, np.asarray(classes, float)
        self.coefficients, self.intercepts, self.steps = np.asarray(coefficients, float), np.asarray(intercepts, float), steps

    def transform(self, df: DataFrame) -> DataFrame:
        w, b, classes = self.coefficients, self.intercepts, self.class_values
        # one score an index up to the largest class, as a list of classes 0 .. k - 1 has
        width = int(classes.max()) + 1 if len(classes) and (classes == classes.astype(int)).all() and classes.min() >= 0 else None

        @F.arrow_udf("array<double>")
        def score(x: pa.Array) -> pa.Array:
            n = len(x)
            m = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
            p, _ = _probabilities(m @ w.T + b)
            if width is not None and width != len(classes):
                wide = np.zeros((n, width))
                wide[:, classes.astype(int)] = p
                p = wide
            return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))

        kind = df.schema[self.features].dataType.typeName()
        x = F.col(self.features).cast("array<double>") if kind == "array" else vector_to_array(self.features)
        out = df.withColumn("scores", score(x))
        at = F.array_position("scores", F.array_max("scores"))
        number = (at - 1).cast("double") if width is not None else F.element_at(F.array(*[F.lit(float(c)) for c in classes]), at.cast("int"))
        return out.withColumn("prediction", number)

    def feature_importance(self):
        return np.abs(self.coefficients).mean(axis=0)

    def state(self) -> dict:
        return {"features": self.features, "classes": self.class_values.tolist(), "coefficients": self.coefficients.tolist(),
                "intercepts": self.intercepts.tolist(), "steps": self.steps}

    @classmethod
    def from_state(cls, state: dict) -> "LogisticModel":
        return cls(**state)
