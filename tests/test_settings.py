"""Settings are accepted, mapped or refused, never dropped; models are tuned and saved."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from netsieve import session
from netsieve.operators import models as M
from netsieve.operators.tuning import grid_search
from netsieve.plans.q_models import FlowSignalNB, signal_frames
from netsieve.sources.sinks import load_model, load_models, save_model


@pytest.mark.parametrize("cfg", [{"nosuch": {}}, {"knn": {"weights": "other"}}, {"gaussian_nb": {"typo": 1}}, {"random_forest": {"min_samples_split": 0.5}},
                                 {"random_forest": {"min_samples_split": 1}}, {"svm": {"kernel": "poly"}}, {"gmm": {"covariance_type": "diag"}},
                                 {"logistic_regression": {"solver": "saga"}}])
def test_refused(cfg):
    with pytest.raises((ValueError, TypeError)):
        M.build_models(cfg)


def test_reference_settings_are_accepted():
    cfg = {"random_forest": {"enabled": True, "n_estimators": 100, "max_depth": 10, "min_samples_split": 2},
           "svm": {"enabled": True, "kernel": "rbf", "C": 1.0, "probability": True}, "knn": {"n_neighbors": 5}, "gaussian_nb": {"enabled": True},
           "logistic_regression": {"max_iter": 1000, "solver": "lbfgs", "multi_class": "auto"}, "gmm": {"n_components": 5}}
    assert sorted(M.build_models(cfg)) == sorted(cfg)


def test_checkpoint_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


@pytest.fixture(scope="module")
def frames(spark):
    train, test, _ = signal_frames(spark, SF001)
    return train.cache(), test.cache()


def test_knn_distance_weights(spark):
    df = spark.createDataFrame([(0, [0.0], 0.0), (1, [1.0], 1.0), (2, [1.1], 1.0)], "uid long, v array<double>, y double")
    q = spark.createDataFrame([(9, [0.1])], "uid long, v array<double>")
    def predict(w):
        return M.KNN(3, weights=w).fit(df, "v", "y").transform(q).first()
    assert predict("uniform")["prediction"] == 1.0 and predict("distance")["prediction"] == 0.0
    assert sum(predict("distance")["scores"]) == pytest.approx(1.0)


def test_svm_probability(frames):
    train, test = frames
    model = M.SVM(probability=True, n_components=40, max_iter=15).fit(train)
    out = model.transform(test).select("scores").collect()
    assert all(abs(sum(r["scores"]) - 1) < 1e-6 and min(r["scores"]) >= 0 for r in out)


class Majority:
    """A user model that can be saved."""

    def __init__(self, top=None):
        self.top = top

    def fit(self, df, features="features", label="label_idx"):
        return Majority(df.groupBy(label).count().orderBy(F.desc("count"), label).first()[0])

    def transform(self, df):
        return df.withColumn("prediction", F.lit(self.top))

    def state(self):
        return {"top": self.top}

    @classmethod
    def from_state(cls, state):
        return cls(**state)


def test_every_model_is_saved_and_loaded(spark, frames, tmpdir_path):
    train, test = frames
    models = {"random_forest": M.RandomForest(n_estimators=5, max_depth=4), "logistic_regression": M.Logistic(max_iter=20),
              "gaussian_nb": M.GaussianNB(), "knn": M.KNN(), "gmm": M.GMMClassifier(2, max_iter=10),
              "svm": M.SVM(n_components=20, max_iter=10, probability=True), "majority": Majority()}
    for name, est in models.items():
        model = est.fit(train)
        save_model(spark, model, f"{tmpdir_path}/{name}")
        again = load_model(spark, f"{tmpdir_path}/{name}")
        a, b = (sorted((r["uid"], r["prediction"]) for r in m.transform(test).select("uid", "prediction").collect()) for m in (model, again))
        assert a == b, name
    with pytest.raises(TypeError):
        save_model(spark, FlowSignalNB(), f"{tmpdir_path}/none")


def test_damaged_model_is_an_error(spark, tmpdir_path):
    save_model(spark, Majority(1.0), f"{tmpdir_path}/gaussian_nb")
    spark.createDataFrame([("{}",)], "meta string").coalesce(1).write.mode("overwrite").json(f"{tmpdir_path}/gaussian_nb/_netsieve_meta")
    with pytest.raises(Exception):
        load_models(spark, tmpdir_path)


def test_tuning_of_other_models(frames):
    train, test = frames
    model, table = grid_search("knn", {"n_neighbors": [1, 5]}, train, k=3)
    got = table.collect()
    assert [r["params"] for r in got] == ["n_neighbors=1", "n_neighbors=5"] and sum(r["is_best"] for r in got) == 1
    assert "prediction" in model.transform(test).columns
    with pytest.raises(ValueError):
        grid_search("nosuch", {}, train)


def test_ready_for_fit_raises_partitions(spark):
    n = spark.sparkContext.defaultParallelism * M.MIN_ROWS
    assert M.ready_for_fit(spark.range(n).coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_covariance_does_not_cancel(spark):
    from netsieve.operators.mixture import fit_mixtures, starts
    df = spark.range(1000).select(F.array((F.col("id") % 2 + 1e9).cast("double"), (F.col("id") % 5).cast("double")).alias("x"),
                                  F.lit(0.0).alias("y"))
    cov = fit_mixtures(df, starts(df, 1, reg=0.0), reg=0.0)[0.0].covs[0]
    assert cov[0, 0] == pytest.approx(0.25, rel=1e-9) and cov[1, 1] == pytest.approx(2.0, rel=1e-9)
