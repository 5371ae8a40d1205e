"""Models: exact kNN against brute force, merged NB statistics, determinism, accuracy,
save/load, registry."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from netsieve import fixtures
from netsieve.operators import models as M
from netsieve.operators.knn import KNNClassifier
from netsieve.plans.q_models import signal_frames
from netsieve.sources.sinks import load_model, save_model
from netsieve.streaming import batch_moments, merged_moments


def brute_knn(vecs, labels, ids, k, exclude_self):
    out = {}
    for i in range(len(vecs)):
        d = ((vecs - vecs[i]) ** 2).sum(axis=1)
        order = sorted(range(len(vecs)), key=lambda j: (d[j], ids[j]))
        if exclude_self:
            order = [j for j in order if j != i]
        votes = {}
        for j in order[:k]:
            votes[labels[j]] = votes.get(labels[j], 0) + 1
        out[ids[i]] = min(votes, key=lambda l: (-votes[l], l))
    return out


@pytest.mark.parametrize("pivots", [None, 1, 7])
def test_knn_exact(spark, pivots):
    emb = fixtures.table(spark, SF001, "embeddings")
    rows = emb.orderBy("vec_id").collect()
    vecs = np.array([r["embedding"] for r in rows], dtype=np.float64)
    ids = [r["vec_id"] for r in rows]
    labels = [r["label"] for r in rows]
    want = brute_knn(vecs, labels, ids, 5, True)
    model = KNNClassifier(5, pivots=pivots).fit(emb, vec="embedding", label_col="label", id_col="vec_id")
    got = {r["vec_id"]: r["prediction"] for r in model.transform(emb, exclude_self=True).collect()}
    assert got == want


def test_nb_batches_equal_one_shot(spark):
    sig = fixtures.flows_signal(spark, SF01)
    feats = ["orig_pkts", "resp_bytes", "duration"]
    parts = None
    for f in ["capture-0", "capture-1", "capture-2", "capture-3"]:
        b = batch_moments(sig.where(F.col("source_file") == f), feats)
        parts = b if parts is None else parts.unionByName(b)
    got = {(r["label"], r["feature"]): (r["n"], r["mean"], r["var"]) for r in merged_moments(parts).collect()}
    for r in sig.groupBy("label").agg(*[F.var_pop(c).alias(c) for c in feats], F.count("*").alias("n")).collect():
        for c in feats:
            n, _, v = got[(r["label"], c)]
            assert n == r["n"] and abs(v - r[c]) <= 1e-9 * max(1.0, abs(r[c]))


@pytest.fixture(scope="module")
def frames(spark):
    train, test, prep = signal_frames(spark, SF01)
    return train.cache(), test.cache(), prep


def _acc(model, test):
    return model.transform(test).agg(F.avg((F.col("prediction") == F.col("label_idx")).cast("double"))).first()[0]


def test_models_beat_majority(frames):
    train, test, _ = frames
    majority = test.groupBy("label_idx").count().agg(F.max("count")).first()[0] / test.count()
    for name, params in [("random_forest", {"n_estimators": 20, "max_depth": 8}),
                         ("logistic_regression", {"max_iter": 200}), ("gaussian_nb", {}),
                         ("knn", {"n_neighbors": 5}), ("gmm", {"n_components": 3}),
                         ("svm", {"n_components": 100})]:
        acc = _acc(M.REGISTRY[name](**params).fit(train), test)
        assert acc > majority + 0.1, (name, acc, majority)


def test_same_seed_same_predictions(frames):
    train, test, _ = frames
    a = M.RandomForest(n_estimators=10, max_depth=5).fit(train).transform(test).select("uid", "prediction")
    b = M.RandomForest(n_estimators=10, max_depth=5).fit(train).transform(test).select("uid", "prediction")
    assert a.exceptAll(b).count() == 0


def test_save_load_roundtrip(spark, frames, tmpdir_path):
    train, test, _ = frames
    for name, params in [("random_forest", {"n_estimators": 5}), ("gaussian_nb", {}), ("gmm", {"n_components": 2}),
                         ("knn", {})]:
        m = M.REGISTRY[name](**params).fit(train)
        path = f"{tmpdir_path}/{name}"
        save_model(spark, m, path)
        back = load_model(spark, path)
        a = m.transform(test).select("uid", "prediction")
        b = back.transform(test).select("uid", "prediction")
        assert a.exceptAll(b).count() == 0, name


def test_registry_extension(frames):
    class Constant:
        def __init__(self, **_):
            pass

        def fit(self, df, features="features", label="label_idx"):
            return self

        def transform(self, df):
            return df.withColumn("prediction", F.lit(0.0))

    M.register_model("constant", Constant)
    try:
        built = M.build_models({"constant": {}, "svm": {"enabled": False}})
        assert list(built) == ["constant"]
    finally:
        M.REGISTRY.pop("constant")


@pytest.mark.parametrize("exclude_self", [True, False])
def test_knn_exact_with_hot_duplicate(spark, exclude_self):
    """A third of the training vectors identical: still equal to brute force."""
    rng = np.random.default_rng(7)
    n = 240
    vecs = rng.normal(size=(n, 3)).round(1)
    vecs[::3] = [0.5, -0.5, 0.0]
    labels = [int(x) for x in rng.integers(0, 3, size=n)]
    ids = list(range(n))
    df = spark.createDataFrame([(i, vecs[i].tolist(), labels[i]) for i in ids],
                               "vec_id long, embedding array<double>, label int").repartition(6)
    want = brute_knn(vecs, labels, ids, 5, exclude_self)
    model = KNNClassifier(5, pivots=5).fit(df, vec="embedding", label_col="label", id_col="vec_id")
    got = {r["vec_id"]: r["prediction"] for r in model.transform(df, exclude_self=exclude_self).collect()}
    assert got == want
    nb = model.neighbours(df, exclude_self)
    want_nb = {}
    for i in ids:
        d = ((vecs - vecs[i]) ** 2).sum(axis=1)
        order = [j for j in sorted(ids, key=lambda j: (d[j], j)) if not (exclude_self and j == i)]
        want_nb[i] = sorted(order[:5])
    got_nb = {}
    for r in nb.collect():
        got_nb.setdefault(r["_q_id"], []).append(r["_t_id"])
    assert {k: sorted(v) for k, v in got_nb.items()} == want_nb
