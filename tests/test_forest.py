"""Trees grown by subtree hand-off against a plain recursive tree."""

import numpy as np
import pytest

from netsieve.operators import forest as G, models as M
from netsieve.sources.sinks import load_model, save_model


def gini(c):
    return 1 - sum((v / sum(c)) ** 2 for v in c) if sum(c) else 0.0


def plain(x, y, k, depth, split, leaf, at=0):
    """The class shares a row ends in, by recursion over all cuts."""
    counts = [int((y == c).sum()) for c in range(k)]
    n = len(y)
    share = np.tile(np.array(counts) / n, (n, 1))
    if (depth is not None and at >= depth) or n < split or max(counts) == n:
        return share
    best = None
    for f in range(x.shape[1]):
        values = sorted(set(x[:, f]))
        for a, b in zip(values, values[1:]):
            left = x[:, f] <= a
            if left.sum() < leaf or n - left.sum() < leaf:
                continue
            parts = [[int((y[s] == c).sum()) for c in range(k)] for s in (left, ~left)]
            gain = n * gini(counts) - sum(sum(p) * gini(p) for p in parts)
            if gain > 1e-9 * n and (best is None or gain > best[0] + 1e-9 * n):
                best = (gain, left)
    if best is None:
        return share
    out = np.empty((n, k))
    for s in (best[1], ~best[1]):
        out[s] = plain(x[s], y[s], k, depth, split, leaf, at + 1)
    return out


def data(seed, n=260, d=3, k=3, values=8):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, values, (n, d)).astype(float)
    y = ((x[:, 0] > 3).astype(int) + (x[:, 1] + rng.integers(0, 3, n) > 6)).astype(int) % k
    return x, y


def frame(spark, x, y, parts=4):
    return spark.createDataFrame([(i, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))],
                                 "uid long, features array<double>, label_idx double").repartition(parts)


def shares(model, df):
    return np.array([r["scores"] for r in model.transform(df).orderBy("uid").collect()])


@pytest.mark.parametrize("depth,split,leaf,handoff", [(None, 2, 1, 10_000), (40, 9, 1, 10_000), (3, 2, 4, 10_000), (None, 5, 2, 60), (4, 2, 1, 1)])
def test_one_tree_equals_the_plain_one(spark, monkeypatch, depth, split, leaf, handoff):
    monkeypatch.setattr(G, "HANDOFF", handoff)
    x, y = data(1)
    df = frame(spark, x, y)
    g = G.Grower(0, depth=depth, split=split, leaf=leaf)
    model = G.ForestModel("features", *G.fit_forest(df, "features", "label_idx", 1, g, bootstrap_rows=False, handoff=handoff))
    assert np.abs(shares(model, df) - plain(x, y, 3, depth, split, leaf)).max() < 1e-12


def test_depth_beyond_any_number_of_bits(spark):
    """A chain of 80 values that alternate in class: one cut a level is not needed, but none is refused."""
    x, y = np.arange(80.0)[:, None], np.arange(80) % 2
    df = frame(spark, x, y)
    model = M.RandomForest(n_estimators=1, max_depth=100, bootstrap=False, max_features=None).fit(df)
    assert (shares(model, df).argmax(axis=1) == y).all()
    stairs = np.cumsum(2.0 ** np.arange(70))[:, None]
    g = G.Grower(2)
    grown = g.grow(stairs, np.arange(70) % 2, np.ones(70), 0, 1, 0)
    assert sum(n[1] < 0 for n in grown) == 70


def test_forest_settings_saving_and_accuracy(spark, tmpdir_path):
    x, y = data(7, n=900)
    df = frame(spark, x, y)
    model = M.RandomForest(n_estimators=15, min_samples_split=6, criterion="entropy").fit(df)
    p = shares(model, df)
    assert np.abs(p.sum(axis=1) - 1).max() < 1e-9 and (p.argmax(axis=1) == y).mean() > 0.8
    again = M.RandomForest(n_estimators=15, min_samples_split=6, criterion="entropy").fit(df.repartition(2).coalesce(1).orderBy("uid"))
    assert len(model.trees) == 15 and len({len(t) for t in model.trees}) > 3 and len(again.trees) == 15
    imp = model.feature_importance()
    assert imp.sum() == pytest.approx(1) and imp[:2].sum() > 0.7
    save_model(spark, model, f"{tmpdir_path}/f")
    assert np.abs(shares(load_model(spark, f"{tmpdir_path}/f"), df) - p).max() < 1e-12
    more = df.unionByName(spark.createDataFrame([(9000, None, 1.0), (9001, [1.0, 2.0, 3.0], None)], df.schema))
    assert len(M.RandomForest(n_estimators=2).fit(more).trees) == 2
    with pytest.raises(ValueError, match="no rows"):
        M.RandomForest().fit(df.where("false"))


def test_histograms_and_handoff_agree_for_a_forest(spark):
    """Eight values a feature: the histograms see every cut, so handing off early or late gives the same trees."""
    x, y = data(3, n=500)
    df = frame(spark, x, y, 1)
    fits = [G.fit_forest(df, "features", "label_idx", 4, G.Grower(0, depth=5, features=2), True, handoff)[1] for handoff in (10_000, 100)]
    models = [G.ForestModel("features", [0, 1, 2], t) for t in fits]
    a, b = (shares(m, df) for m in models)
    assert (np.abs(a - b).max(axis=1) < 1e-12).mean() > 0.99
