"""A logistic model that learns batch by batch, without reading older batches again.

The state of the model is its coefficients, the curvature (Hessian) of everything learned so
far around them, and the features' second moments.  A batch is learned by Newton steps on

    loss of the batch's rows + 1/2 (w - w0)' H0 (w - w0)

(w0, H0 from the state; at first 0 and the penalty), one Arrow pass a step over the batch alone;
its own curvature is then added to H0.  The quadratic stands for all older rows, so a batch
weighs as much as its rows, early or late.  Two states learned from different rows of one
preparation can be merged: curvatures add, coefficients are their curvature-weighted mean.

The state is written once a batch under ``<state>/batch=<id>``.  A batch reads the newest state
of an earlier batch, so a batch that is run again starts from the same state and gives the same.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.logistic import HALVINGS, HESSIAN, LogisticModel, _design, _Problem, _sums
from ..operators.prep import Preprocessor, PreprocessorModel, PrepState
from ..session import exists, scratch_dir
from .batches import _results, run_batches

STATE = "meta string, arrays map<string, binary>"
_RESULT = "n long, classes int, steps int, accuracy_before double"
NEWTON_STEPS = 50
MIN_GRADIENT = 1e-8              # of the mean loss


class OnlineLogistic:
    """Multinomial logistic regression with the objective of :class:`LogisticRegression`
    (C * loss + |w|^2 / 2, intercepts free), learned in batches.

    ``mean`` and ``scale`` (of the first batch) only set the size of the numbers and stay for life.
    A class first seen in a later batch starts at one row among all learned before."""

    def __init__(self, mean, scale, c: float = 1.0):
        self.mean, self.scale, self.c = np.asarray(mean, float), np.asarray(scale, float), float(c)
        self.d = len(self.mean) + 1
        self.classes: list[str] = []
        self.n = 0
        self.w = np.zeros((0, self.d))
        self.h = np.zeros((0, self.d, 0, self.d))
        self.moments = np.zeros((self.d, self.d))        # sum of a a' over the rows, a = (scaled x, 1)

    def _ridge(self) -> np.ndarray:
        return np.append(1.0 / self.scale ** 2, 0.0) / self.c

    def add_classes(self, names) -> None:
        new = [c for c in sorted(names) if c not in self.classes]
        if not new:
            return
        old, k = len(self.classes), len(self.classes) + len(new)
        if k * self.d > HESSIAN:
            raise ValueError(f"{k} classes x {self.d} features: the curvature of more than {HESSIAN} coefficients is not kept")
        w, h = np.zeros((k, self.d)), np.zeros((k, self.d, k, self.d))
        w[:old], h[:old, :, :old] = self.w, self.h
        for i in range(old, k):
            h[i, :, i] += np.diag(self._ridge())
            if self.n:
                p = 1.0 / (self.n + 1)
                w[i, -1] = (self.w[:, -1].max() if old else 0.0) + np.log(p)
                h[i, :, i] += p * (1 - p) * self.moments
        self.classes, self.w, self.h = self.classes + new, w, h

    def learn(self, rows: DataFrame) -> int:
        """Learn ``rows`` (x array<double>, y double: index into ``classes``); returns the steps."""
        k, d = len(self.classes), self.d
        mean, scale = self.mean, self.scale
        s = _sums(rows, lambda x, y: np.concatenate([[len(x)], (lambda a: (a.T @ a).ravel())(_design(mean, scale, x))]), 1 + d * d)
        n = int(s[0])
        if not n:
            return 0
        p = _Problem(rows, np.arange(k, dtype=float), mean, scale, self.c, False, n)
        w0, h0 = self.w, self.h.reshape(k * d, k * d) / n

        def at(w):
            loss, grad, h = p.evaluate(w, True)
            away = (w - w0).ravel()
            pull = h0 @ away
            return loss + 0.5 * away @ pull, grad.ravel() + pull, h

        w, steps = w0, 0
        loss, grad, h = at(w)
        while steps < NEWTON_STEPS and k > 1 and np.abs(grad).max() > MIN_GRADIENT:
            move = -np.linalg.lstsq(h + h0, grad, rcond=1e-13)[0]
            slope, size = grad @ move, 1.0
            for _ in range(HALVINGS):
                new = at(w + size * move.reshape(k, d))
                if new[0] <= loss + 1e-4 * size * slope:
                    break
                size /= 2
            else:
                break
            w, (loss, grad, h) = w + size * move.reshape(k, d), new
            steps += 1
        self.w, self.n = w, self.n + n
        self.h = ((h0 + h) * n).reshape(k, d, k, d)
        self.moments = self.moments + s[1:].reshape(d, d)
        return steps

    def merged(self, other: "OnlineLogistic") -> "OnlineLogistic":
        """One model of the rows of both (the same mean, scale and C)."""
        if self.c != other.c or not (np.array_equal(self.mean, other.mean) and np.array_equal(self.scale, other.scale)):
            raise ValueError("models of different preparations cannot be merged")
        out = OnlineLogistic(self.mean, self.scale, self.c)
        names = sorted(set(self.classes) | set(other.classes))
        k, d = len(names), self.d
        total, pull = np.zeros((k * d, k * d)), np.zeros(k * d)
        for m in (self, other):
            full = m.copy()
            full.add_classes(names)
            order = [full.classes.index(c) for c in names]
            h = full.h[order][:, :, order].reshape(k * d, k * d)
            total += h
            pull += h @ full.w[order].ravel()
        out.classes, out.n, out.moments = names, self.n + other.n, self.moments + other.moments
        total -= np.diag(np.tile(self._ridge(), k))                                  # the penalty counts once
        out.w = np.linalg.lstsq(total, pull, rcond=1e-13)[0].reshape(k, d)
        out.h = total.reshape(k, d, k, d)
        return out

    def copy(self) -> "OnlineLogistic":
        return OnlineLogistic.from_row(*self.row())

    def model(self, features: str = "features") -> LogisticModel:
        """The classifier so far; its class indexes follow ``classes``."""
        plain = self.w[:, :-1] / self.scale
        bias = self.w[:, -1] - plain @ self.mean
        return LogisticModel(features, np.arange(len(self.classes)), plain, bias - bias.mean())

    def row(self) -> tuple[str, dict]:
        arrays = {k: bytearray(np.ascontiguousarray(getattr(self, k)).tobytes()) for k in ("mean", "scale", "w", "h", "moments")}
        return json.dumps({"classes": self.classes, "n": self.n, "c": self.c}), arrays

    @classmethod
    def from_row(cls, meta: str, arrays: dict) -> "OnlineLogistic":
        a, m = {k: np.frombuffer(bytes(v)) for k, v in arrays.items()}, json.loads(meta)
        out = cls(a["mean"], a["scale"], m["c"])
        k, d = len(m["classes"]), out.d
        out.classes, out.n = m["classes"], m["n"]
        out.w, out.h, out.moments = a["w"].reshape(k, d), a["h"].reshape(k, d, k, d), a["moments"].reshape(d, d)
        return out


def read_online(spark: SparkSession, state: str, before: int | None = None):
    """(model, preprocessor) of the newest batch under ``state``, of those before ``before`` if
    given; None if there is none."""
    if not exists(spark, state):
        return None
    rows = spark.read.schema(f"{STATE}, prep string, batch int").parquet(state)
    if before is not None:
        rows = rows.where(F.col("batch") < before)
    last = rows.agg(F.max("batch")).first()[0]           # of the folder names alone
    if last is None:
        return None
    row = rows.where(F.col("batch") == last).first()
    return OnlineLogistic.from_row(row["meta"], row["arrays"]), PreprocessorModel(PrepState.from_json(row["prep"]))


def _first_scale(rows: DataFrame, d: int):
    s = _sums(rows, lambda x, y: np.concatenate([[len(x)], x.sum(axis=0)]), 1 + d)
    mean = s[1:] / s[0]
    scale = np.sqrt(_sums(rows, lambda x, y: ((x - mean) ** 2).sum(axis=0), d) / s[0])
    return mean, np.where(scale <= 1e-12 * np.maximum(1.0, np.abs(mean)), 1.0, scale)


def stream_logistic_online(spark: SparkSession, folder: str, categorical, numerical, batch_files: int = 3,
                           target: str = "label", c: float = 1.0, state: str | None = None,
                           sink: str | None = None) -> DataFrame:
    """Learn a logistic model from arriving files.  Per batch: its rows are first scored with the
    model of the batches before (the accuracy is one on unseen rows; null in the first batch), then
    learned.  The preprocessor is fitted on the first batch and kept; later categories that it has
    not seen count as none.  Rows without a label are left out; a batch without any leaves the
    model as it is.  Returns (batch_id, n, classes, steps, accuracy_before)."""
    sink = sink or scratch_dir(spark, "stream-online")
    state = state or scratch_dir(spark, "stream-online-state")

    def handle(df: DataFrame, batch_id: int):
        df = df.where(F.col(target).isNotNull())
        known = read_online(spark, state, before=batch_id)
        counts = [(r[0], r[1]) for r in df.groupBy(F.col(target).cast("string")).count().collect()]
        if not counts:
            return None
        prep = known[1] if known else Preprocessor(target, categorical, numerical).fit(df)
        if prep.state.tables:
            raise ValueError("a column has too many categories for a model kept on the driver")
        feats = prep.transform(df.withColumn("_y", F.col(target).cast("string")), keep=["_y"]).select("features", "_y")
        feats = feats.persist()
        try:
            accuracy = None
            if known and known[0].classes:
                names = F.array(*[F.lit(x) for x in known[0].classes])
                scored = known[0].model().transform(feats)
                right = F.element_at(names, F.col("prediction").cast("int") + 1) == F.col("_y")
                accuracy = float(scored.agg(F.avg(right.cast("double"))).first()[0])
            arrays = feats.select(vector_to_array("features").alias("x"), "_y")
            if known:
                online = known[0]
            else:
                d = len(arrays.first()["x"])
                online = OnlineLogistic(*_first_scale(arrays.select("x", F.lit(0.0).alias("y")), d), c)
            online.add_classes(x for x, _ in counts)
            number = F.array_position(F.array(*[F.lit(x) for x in online.classes]), F.col("_y")) - 1
            steps = online.learn(arrays.select("x", number.cast("double").alias("y")))
        finally:
            feats.unpersist()
        row = (*online.row(), prep.state.to_json())
        spark.createDataFrame([row], f"{STATE}, prep string").coalesce(1).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        return spark.createDataFrame([(sum(n for _, n in counts), len(online.classes), steps, accuracy)], _RESULT)

    run_batches(spark, folder, handle, sink, batch_files=batch_files)
    return _results(spark, sink, f"{_RESULT}, batch_id int")


def online_predictions(spark: SparkSession, state: str, df: DataFrame, keep=()) -> DataFrame:
    """``keep`` columns and ``predicted`` (class text) of ``df`` by the newest model under ``state``."""
    found = read_online(spark, state)
    if found is None:
        raise ValueError(f"no model under {state}")
    online, prep = found
    out = online.model().transform(prep.transform(df, keep=list(keep)))
    names = F.array(*[F.lit(x) for x in online.classes])
    return out.select(*keep, F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted"))
