"""SVMs by L-BFGS: they store no mapped features, reach Spark ML's optimum and survive saving."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from netsieve.operators import models as M
from netsieve.operators.hinge import fit_hinge
from netsieve.sources.sinks import load_model, save_model


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.3 * rng.normal(size=600) > 0).astype(int) + (x[:, 2] > 1.2)
    df = spark.createDataFrame([(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))], "uid long, v array<double>, label_idx double")
    return df.withColumn("features", array_to_vector("v")).cache()


def _objective(w, b, x, sign, reg):
    return np.maximum(0, 1 - sign * (x @ w + b)).mean() + 0.5 * reg * (w @ w)


def test_no_worse_than_spark_ml(rows):
    w, b = fit_hinge(rows, "features", "label_idx", 1.0, 50)
    got = rows.collect()
    x, y = np.array([r["v"] for r in got]), np.array([r["label_idx"] for r in got])
    for i in range(3):
        svc = LinearSVC(maxIter=50, regParam=1 / 600, standardization=False).fit(
            rows.select("features", (F.col("label_idx") == i).cast("double").alias("label")))
        sign = np.where(y == i, 1.0, -1.0)
        assert _objective(w[i], b[i], x, sign, 1 / 600) <= _objective(svc.coefficients.toArray(), svc.intercept, x, sign, 1 / 600) * 1.01 + 1e-4


def test_fit_keeps_no_mapped_features(spark, rows):
    widest = [0]
    real = type(rows).persist

    def persist(self, *a):
        widest[0] = max(widest[0], max((len(r) for r in self.select("x").first()), default=0) if "x" in self.columns else 10**6)
        return real(self, *a)

    type(rows).persist = persist
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    try:
        M.SVM(n_components=64, max_iter=5).fit(rows)
    finally:
        type(rows).persist = real
    assert widest[0] == 3                                        # the plain rows, not their 64 components
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before


def test_saved_and_loaded(spark, rows, tmp_path):
    for probability in (False, True):
        model = M.SVM(n_components=30, max_iter=20, probability=probability).fit(rows)
        save_model(spark, model, f"{tmp_path}/svm{probability}")
        back = load_model(spark, f"{tmp_path}/svm{probability}")
        a, b = (m.transform(rows).select("uid", "prediction", "scores") for m in (model, back))
        assert a.exceptAll(b).count() == 0
