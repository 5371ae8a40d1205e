"""kNN: neighbours in the other folds only, found in the nearest group first; grids scored by one search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from netsieve.operators import knn, models as M
from netsieve.operators.tuning import grid_search


def frame(spark, n=600, copies=40):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(n, 3)) * [1, 5, 1], 1)
    x[:copies] = x[0]                                                # more copies than neighbours, in every fold
    rows = [(f"r{i:04d}", v.tolist(), float(v.sum() > 0), i % 4) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "uid string, features array<double>, label_idx double, fold int")


@pytest.mark.parametrize("grouped", [True, False])
def test_neighbours(spark, monkeypatch, grouped):
    monkeypatch.setattr(knn, "UNIT_ROWS", 64)                        # several groups of cells
    df = frame(spark)
    rows = sorted(map(tuple, df.collect()))
    model = knn.KNNClassifier(5, pivots=30).fit(df, id_col="uid", group_col="fold" if grouped else None)
    assert model._layout()[2].shape[1] > 3
    got = {}
    for r in model.neighbours(df, exclude_self=not grouped).collect():
        got.setdefault(r["_q_id"], {})[r["rank"]] = (r["d2"], r["_t_id"])
    x = np.array([r[1] for r in rows])
    for i, (uid, v, _, fold) in enumerate(rows):
        d2 = knn._fold(np.repeat(x[i:i + 1], len(rows), axis=0), x)
        away = [(d2[j], r[0]) for j, r in enumerate(rows) if (r[3] != fold if grouped else j != i)]
        assert [got[uid][k] for k in range(1, 6)] == sorted(away)[:5]


def test_grid_scores_are_those_of_separate_fits(spark, monkeypatch):
    monkeypatch.setattr(knn, "UNIT_ROWS", 64)
    fits = []
    fit = knn.KNNClassifier.fit
    monkeypatch.setattr(knn.KNNClassifier, "fit", lambda *a, **k: fits.append(1) or fit(*a, **k))
    df = frame(spark, 300).drop("fold")
    grid = {"n_neighbors": [1, 4], "weights": ["uniform", "distance"]}
    shared = grid_search("knn", grid, df, k=3)[1].collect()
    assert len(fits) == 2                                            # the search, and the best model

    class Each(M.KNN):
        grid_scores = None

    each = grid_search(Each, grid, df, k=3)[1].collect()
    assert [(r["params"], r["is_best"]) for r in shared] == [(r["params"], r["is_best"]) for r in each]
    assert [r["mean_score"] for r in shared] == pytest.approx([r["mean_score"] for r in each], abs=1e-12)
    assert [r["std_score"] for r in shared] == pytest.approx([r["std_score"] for r in each], abs=1e-12)
