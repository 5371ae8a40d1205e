"""Mixtures by distributed EM against EM in plain numpy from the same start."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from netsieve.operators import models as M
from netsieve.operators.mixture import Gaussians, fit_mixtures, starts


def plain_em(x, weights, means, covs, reg, steps):
    weights, means, covs = list(weights), list(means), list(covs)
    n, d = x.shape
    for _ in range(steps):
        dens = np.stack([w * np.exp(-0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m))
                         / np.sqrt((2 * np.pi) ** d * np.linalg.det(c)) for w, m, c in zip(weights, means, covs)], axis=1)
        r = dens / dens.sum(axis=1, keepdims=True)
        for j in range(len(weights)):
            t = r[:, j].sum()
            weights[j], means[j] = t / n, r[:, j] @ x / t
            diff = x - means[j]
            covs[j] = (diff * r[:, j:j + 1]).T @ diff / t + reg * np.eye(d)
    return np.array(weights), np.array(means), np.array(covs)


def table(spark, data, parts=5):
    rows = [([float(v) for v in r], float(y)) for y, x in data.items() for r in x]
    return spark.createDataFrame(rows, "x array<double>, y double").repartition(parts)


def blobs(seed, n=300):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal([0, 0, 1000], [1, 2, 5], (n, 3)), rng.normal([6, 3, 1030], [2, 1, 9], (n // 2, 3))])


def test_equal_to_plain_em(spark):
    data = {0: blobs(1), 1: blobs(2) * [1, -1, 2], 4: blobs(3)[:40]}
    rows = table(spark, data)
    start = starts(rows, 2)
    got = fit_mixtures(rows, start, 1e-6, 15, float("-inf"))
    for c, x in data.items():
        want = plain_em(x, start[c].weights, start[c].means, start[c].covs, 1e-6, 15)
        for a, b in zip((got[c].weights, got[c].means, got[c].covs), want):
            assert np.allclose(a, b, rtol=1e-7, atol=1e-7)


def test_start_and_fit_do_not_hang_on_partitions(spark):
    data = {0: blobs(5), 1: blobs(6)}
    a, b = (fit_mixtures(t, starts(t, 3)) for t in (table(spark, data, 1), table(spark, data, 7)))
    for c in data:
        assert np.allclose(a[c].means, b[c].means, rtol=1e-6) and np.allclose(a[c].weights, b[c].weights, rtol=1e-6)


def test_likelihood_grows_and_tolerance_ends(spark):
    x = blobs(7)
    rows = table(spark, {0: x})
    scores = []
    for steps in (1, 3, 9, 60):
        g = fit_mixtures(rows, starts(rows, 3), max_iter=steps)[0]
        scores.append(g.sums(x)[0])
    assert scores == sorted(scores)
    assert scores[-1] > scores[0]


def test_one_component_is_the_closed_form(spark):
    x = blobs(8)
    rows = table(spark, {0: x})
    g = fit_mixtures(rows, starts(rows, 1))[0]
    assert np.allclose(g.means[0], x.mean(axis=0)) and np.allclose(g.covs[0], np.cov(x.T, bias=True) + 1e-6 * np.eye(3))


def test_small_equal_and_constant_rows(spark):
    data = {0: np.tile([[1.0, 2.0]], (9, 1)), 1: np.array([[5.0, 5.0]]), 2: np.array([[0.0, 0.0], [9.0, 0.0], [9.0, 0.0]])}
    rows = table(spark, data)
    got = fit_mixtures(rows, starts(rows, 5))
    assert [len(got[c].weights) for c in (0, 1, 2)] == [1, 1, 2]
    assert all(np.isfinite(g.covs).all() and np.isclose(g.weights.sum(), 1) for g in got.values())
    with pytest.raises(ValueError):
        starts(rows.limit(0), 2)


def test_a_component_without_rows_stays():
    g = Gaussians([0.5, 0.5], [[0.0], [1e6]], [[[1.0]], [[1.0]]])
    x = np.linspace(-1, 1, 9)[:, None]
    after = g.updated(g.sums(x), 1e-6)
    assert after.means[1, 0] == 1e6 and after.weights.tolist() == [1.0, 0.0] and np.isfinite(after.joint(x)[:, 0]).all()


def test_classifier_leaves_out_rows_without_a_class(spark):
    data = [(Vectors.dense(r), float(y)) for y, s in ((0, 11), (1, 12)) for r in blobs(s)[:, :2] + 20 * y]
    df = spark.createDataFrame([*data, (Vectors.dense([0.0, 0.0]), None)], ["features", "label_idx"])
    out = M.GMMClassifier(2).fit(df).transform(df).where("label_idx is not null")
    assert out.agg(F.avg((F.col("prediction") == F.col("label_idx")).cast("double"))).first()[0] > 0.98
