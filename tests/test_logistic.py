"""Newton steps against a numpy optimum."""

import numpy as np
import pytest

from netsieve.operators import logistic as L, models as M
from netsieve.sources.sinks import load_model, save_model


def optimum(x, y, c, penalised):
    """Gradient close to 0 by plain Newton steps in numpy, all classes at once."""
    k, (n, d) = int(y.max()) + 1, x.shape
    a = np.concatenate([x, np.ones((n, 1))], axis=1)
    ridge = np.tile(np.append(np.full(d, 1.0 if penalised else 0.0), 0.0), k)
    w = np.zeros(k * (d + 1))
    one = np.eye(k)[y.astype(int)]
    for _ in range(60):
        z = a @ w.reshape(k, -1).T
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = c * ((p - one).T @ a).ravel() + ridge * w
        h = np.zeros((k * (d + 1),) * 2)
        for i in range(n):
            h += c * np.kron(np.diag(p[i]) - np.outer(p[i], p[i]), np.outer(a[i], a[i]))
        w = w - np.linalg.lstsq(h + np.diag(ridge), g, rcond=1e-13)[0]
    w = w.reshape(k, -1)
    if not penalised:
        w = w - w.mean(axis=0)
    return w[:, :-1], w[:, -1] - w[:, -1].mean()


def data(seed=0, n=240, d=4, k=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.array([1.0, 50.0, 0.01, 3.0])[:d] + np.array([0.0, 1000.0, 5.0, -2.0])[:d]
    z = (x - x.mean(axis=0)) / x.std(axis=0) @ rng.normal(size=(d, k)) + rng.gumbel(size=(n, k)) * 1.5
    return x, z.argmax(axis=1).astype(float)


def frame(spark, x, y, parts=3):
    return spark.createDataFrame([(i, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))],
                                 "uid long, features array<double>, label_idx double").repartition(parts)


@pytest.mark.parametrize("c,penalty,parts", [(1.0, "l2", 3), (0.01, "l2", 30), (1.0, "none", 3)])
def test_coefficients_equal_the_optimum(spark, c, penalty, parts):
    x, y = data()
    model = M.Logistic(C=c, penalty=penalty).fit(frame(spark, x, y, parts))
    w, b = optimum(x, y, c, penalty == "l2")
    scale = x.std(axis=0)
    assert np.abs(model.coefficients - w).max() <= 1e-6 * max(1.0, np.abs(w).max())
    assert np.abs((model.coefficients - w) * scale).max() <= 1e-6 and np.abs(model.intercepts - b).max() <= 1e-5
    assert model.steps <= 15


def test_conjugate_gradients_reach_the_same_optimum(spark, monkeypatch):
    x, y = data(3, n=150, d=3)
    df = frame(spark, x, y, 2)
    want = M.Logistic().fit(df)
    monkeypatch.setattr(L, "HESSIAN", 1)
    got = M.Logistic().fit(df)
    assert np.abs(got.coefficients - want.coefficients).max() <= 1e-6 * max(1.0, np.abs(want.coefficients).max())


def test_odd_inputs(spark, tmpdir_path):
    x, y = data(5, n=60, d=2, k=2)
    x = np.concatenate([x, np.full((60, 1), 7.0)], axis=1)                      # a constant feature
    y = np.where(y == 1, 3.0, 1.0)                                              # classes 1 and 3
    df = frame(spark, x, y)
    more = df.unionByName(spark.createDataFrame([(900, None, 1.0), (901, [1.0, 2.0, 3.0], None)], df.schema))
    model = M.Logistic().fit(more)
    assert model.coefficients.shape == (2, 3) and (model.coefficients[:, 2] == 0).all()
    out = model.transform(df).select("uid", "prediction", "scores").collect()
    assert {r["prediction"] for r in out} <= {1.0, 3.0} and all(len(r["scores"]) == 4 and abs(sum(r["scores"]) - 1) < 1e-9 for r in out)
    save_model(spark, model, f"{tmpdir_path}/m")
    again = load_model(spark, f"{tmpdir_path}/m").transform(df).select("uid", "prediction", "scores").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))
    one = M.Logistic().fit(df.where("label_idx = 1"))
    assert {r["prediction"] for r in one.transform(df).collect()} == {1.0}
    with pytest.raises(ValueError, match="no rows"):
        M.Logistic().fit(df.where("false"))
    separable = frame(spark, np.array([[-2.0], [-1.0], [1.0], [2.0]]), np.array([0.0, 0.0, 1.0, 1.0]), 1)
    assert [r["prediction"] for r in M.Logistic(penalty="none", max_iter=30).fit(separable).transform(separable).orderBy("uid").collect()] == [0, 0, 1, 1]
