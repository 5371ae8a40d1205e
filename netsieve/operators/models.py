"""Classifiers.  Each wrapper: ``Wrapper(**params).fit(df, features, label) -> model``;
``model.transform(df)`` adds ``prediction`` (DOUBLE class index) and, where the model
scores classes, ``scores`` (ARRAY<DOUBLE>, one per class index).

random_forest: Spark ML.  logistic_regression: Newton steps (logistic.py).  gaussian_nb: class statistics from one
aggregate, scoring by column expressions.  knn: see knn.py.  svm: random Fourier
features (RBF kernel approximation) + one-vs-rest linear SVMs (hinge.py).  gmm: EM of a mixture per class
(mixture.py), scored as a mixture log-density in an Arrow UDF.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .forest import ForestModel, Grower, fit_forest
from .hinge import as_array, fit_hinge, margins_udf
from .knn import KNNClassifier
from .logistic import LogisticModel, fit_multinomial
from .mixture import fit_mixtures, starts

SPARK_MAX_DEPTH = 30


ROWS_PER_PARTITION = 500_000
MIN_ROWS = 1_000
FOREST_ROWS = 50_000             # of a partition of a Spark ML forest: a row holds a draw a tree
# settings that say how to run, not what to compute
RUN_SETTINGS = {"n_jobs": None, "verbose": None}


def ready_for_fit(df: DataFrame, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Persist a training frame sized for iterative fitting.

    Iterative estimators (LR, GMM, SVM, CV) read their input once per iteration: the
    lineage behind it (splits, joins) must be computed once, and the partitions must
    neither be thousands of slivers (task overhead per iteration) nor a few giant ones.
    The frame is persisted first and counted from that copy.  Target: about
    ``rows_per_partition`` rows each, and a partition per core once there are MIN_ROWS rows
    for each; fewer partitions come from ``coalesce``, more from one repartition."""
    from .rank import track
    kept = track(df)
    n = kept.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    want = max(1, -(-n // rows_per_partition), min(cores, n // MIN_ROWS))
    cur = kept.rdd.getNumPartitions()
    if cur > max(want, cores):
        return kept.coalesce(max(want, cores))
    return track(kept.repartition(want)) if cur < want else kept


def strict(model: str, given: dict, accepted: dict) -> None:
    """Raise on a setting that ``model`` does not have, or on a value it cannot honour.
    ``accepted`` maps a name to None (any value) or to the values that are honoured."""
    for k, v in given.items():
        if k not in accepted:
            raise ValueError(f"{model}: unknown setting {k!r}")
        if accepted[k] is not None and v not in accepted[k]:
            raise ValueError(f"{model}: {k}={v!r} is not supported (supported: {accepted[k]})")


def _vec_len(df: DataFrame, vec: str) -> int:
    meta = df.schema[vec].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    return len(df.select(vec).first()[0])


# ------------------------------------------------------------------ Spark ML wrappers

class _SparkML:
    def __init__(self, **params):
        self.params = params

    def _estimator(self, n: int):
        raise NotImplementedError

    def fit(self, df: DataFrame, features: str = "features", label: str = "label_idx"):
        n = df.count() if self._needs_n else 0
        est = self._estimator(n).setFeaturesCol(features).setLabelCol(label)
        return _SparkMLModel(est.fit(df))

    _needs_n = False


class _SparkMLModel:
    def __init__(self, model):
        self.model = model

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df)
        if "probability" in out.columns:
            out = out.withColumn("scores", vector_to_array("probability"))
        drop = [c for c in ("rawPrediction", "probability") if c in out.columns]
        return out.drop(*drop)

    def feature_importance(self):
        m = self.model
        if hasattr(m, "featureImportances"):
            return m.featureImportances.toArray()
        if hasattr(m, "coefficientMatrix"):
            return np.abs(m.coefficientMatrix.toArray()).mean(axis=0)
        return None

    def save(self, path: str):
        self.model.write().overwrite().save(path)


class RandomForest(_SparkML):
    """n_estimators trees.  Up to Spark's depth of 30 the forest is Spark ML's; max_depth None (no
    bound), a larger one or min_samples_split above 2 grows it by subtree hand-off (forest.py)."""

    def __init__(self, **params):
        strict("random_forest", params, {
            "n_estimators": None, "max_depth": None, "random_state": None, "seed": None, "min_samples_leaf": None,
            "min_samples_split": None, "criterion": ["gini", "entropy"], "max_features": None, "bootstrap": [True, False], **RUN_SETTINGS})
        split = params.get("min_samples_split", 2)
        if isinstance(split, float) or split < 2:
            raise ValueError(f"random_forest: min_samples_split={split!r} is not supported (a whole number from 2)")
        super().__init__(**params)

    def fit(self, df: DataFrame, features: str = "features", label: str = "label_idx"):
        p = self.params
        depth = p.get("max_depth")
        if depth is not None and int(depth) <= SPARK_MAX_DEPTH and p.get("min_samples_split", 2) == 2 and p.get("bootstrap", True):
            parts = -(-df.count() // FOREST_ROWS)
            # a task reads a partition of drawn rows a level: more partitions, not larger ones
            return super().fit(df.repartition(parts) if parts > df.rdd.getNumPartitions() else df, features, label)
        grower = Grower(0, p.get("criterion", "gini"), None if depth is None else int(depth), int(p.get("min_samples_split", 2)),
                        max(1, int(p.get("min_samples_leaf", 1))), p.get("max_features", "sqrt"), int(p.get("random_state", p.get("seed", 42))))
        return ForestModel(features, *fit_forest(df, features, label, int(p.get("n_estimators", 100)), grower, p.get("bootstrap", True)))

    def _estimator(self, n):
        p = self.params
        depth = int(p["max_depth"])
        subset = {None: "all"}.get(p.get("max_features", "sqrt"), str(p.get("max_features", "sqrt")))
        return RandomForestClassifier(numTrees=int(p.get("n_estimators", 100)), maxDepth=depth,
                                      impurity=p.get("criterion", "gini"), featureSubsetStrategy=subset,
                                      seed=int(p.get("random_state", p.get("seed", 42))), maxMemoryInMB=1024,
                                      cacheNodeIds=False, minInstancesPerNode=max(1, int(p.get("min_samples_leaf", 1))))


class Logistic:
    """Multinomial, C * sum(loss) + |w|^2 / 2, to the optimum by Newton steps (logistic.py);
    ``max_iter`` bounds the steps."""

    def __init__(self, **params):
        strict("logistic_regression", params, {
            "C": None, "max_iter": None, "tol": None, "random_state": None, "solver": ["lbfgs", "newton-cg"],
            "multi_class": ["auto", "multinomial"], "penalty": ["l2", None, "none"], **RUN_SETTINGS})
        self.params = params

    def fit(self, df: DataFrame, features: str = "features", label: str = "label_idx") -> LogisticModel:
        p = self.params
        return LogisticModel(features, *fit_multinomial(
            df, features, label, float(p.get("C", 1.0)), p.get("penalty", "l2") not in (None, "none"),
            int(p.get("max_iter", 100)), float(p.get("tol", 1e-4))))


# ------------------------------------------------------------------ Gaussian naive Bayes

class GaussianNB:
    """Per class: prior, mean and population variance of each feature (+ var_smoothing x
    the largest feature variance); predict the class of largest log likelihood.  One pass:
    the overall variances follow from the class moments."""

    def __init__(self, var_smoothing: float = 1e-9):
        self.var_smoothing = var_smoothing

    def fit(self, df: DataFrame, features="features", label: str = "label_idx"):
        if isinstance(features, (list, tuple)):
            cols = list(features)
            stats = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"),
                                          F.array(*[F.avg(c) for c in cols]).alias("mean"),
                                          F.array(*[F.var_pop(c) for c in cols]).alias("var"))
            rows = [(r[label], r["n"], np.array(r["mean"], float), np.array(r["var"], float)) for r in stats.collect()]
        else:
            from pyspark.ml.stat import Summarizer
            s = Summarizer.metrics("count", "mean", "variance").summary(F.col(features))
            cols = None
            rows = [(r[label], r["s"]["count"], r["s"]["mean"].toArray(),
                     r["s"]["variance"].toArray() * (r["s"]["count"] - 1) / r["s"]["count"])
                    for r in df.groupBy(label).agg(s.alias("s")).collect()]
        rows.sort(key=lambda r: r[0])
        n = np.array([r[1] for r in rows], float)
        theta, var = np.stack([r[2] for r in rows]), np.stack([r[3] for r in rows])
        prior = n / n.sum()
        mean = prior @ theta
        eps = self.var_smoothing * float((prior @ (var + (theta - mean) ** 2)).max(initial=0.0))
        return GaussianNBModel(features, cols, [r[0] for r in rows], theta, var + eps, prior)


def _nb_udf(theta: np.ndarray, var: np.ndarray, prior: np.ndarray):
    """Joint log likelihoods of a vector column, a batch at a time."""
    const = np.log(prior) - 0.5 * np.log(2.0 * np.pi * var).sum(axis=1)

    @F.pandas_udf(ArrayType(DoubleType()))
    def score(v: pd.Series) -> pd.Series:
        x = np.stack(v.to_numpy()).astype(np.float64)
        out = np.stack([const[k] - 0.5 * ((x - theta[k]) ** 2 / var[k]).sum(axis=1) for k in range(len(prior))], axis=1)
        return pd.Series(list(out))
    return score


class GaussianNBModel:
    def __init__(self, features, cols, classes, theta, var, prior):
        self.features, self.cols, self.classes = features, cols, classes
        self.theta, self.var, self.prior = theta, var, prior

    def jll(self) -> F.Column:
        """Array of joint log likelihoods: expressions over a few columns, numpy over a vector."""
        if self.cols is None:
            return _nb_udf(self.theta, self.var, self.prior)(vector_to_array(self.features))
        out = []
        for k in range(len(self.classes)):
            e = F.lit(float(math.log(self.prior[k]) - 0.5 * np.sum(np.log(2.0 * np.pi * self.var[k]))))
            quad = F.lit(0.0)
            for i, c in enumerate(self.cols):
                quad = quad + (F.col(c) - F.lit(float(self.theta[k, i]))) ** 2 / F.lit(float(self.var[k, i]))
            out.append(e - F.lit(0.5) * quad)
        return F.array(*out)

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumn("_jll", self.jll()).withColumn("_best", F.array_max("_jll"))
        cls = F.array(*[F.lit(c) for c in self.classes])
        out = out.withColumn("prediction", F.element_at(cls, F.array_position("_jll", F.col("_best")).cast("int")))
        # normalised class probabilities from the joint log likelihoods
        exps = F.transform("_jll", lambda j: F.exp(j - F.col("_best")))
        out = out.withColumn("_exp", exps)
        total = F.aggregate("_exp", F.lit(0.0), lambda a, b: a + b)
        return out.withColumn("scores", F.transform("_exp", lambda e: e / total)).drop("_jll", "_best", "_exp")


def merge_moments(parts: DataFrame, keys, n="n", mean="mean", m2="m2") -> DataFrame:
    """Combine per-part (n, mean, M2) of each key into totals: mean = sum(n mean) / N,
    M2 = sum(M2_b + n_b (mean_b - mean)^2) -- the pairwise update summed over parts, with
    no raw sums of squares to cancel."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys)
    tot_n = F.sum(n).over(w)
    with_mean = parts.withColumn("_N", tot_n).withColumn("_mu", F.sum(F.col(n) * F.col(mean)).over(w) / F.col("_N"))
    return with_mean.groupBy(*keys).agg(
        F.first("_N").alias("n"), F.first("_mu").alias("mean"),
        F.sum(F.col(m2) + F.col(n) * (F.col(mean) - F.col("_mu")) ** 2).alias("m2"))


# ------------------------------------------------------------------ SVM (RBF, approximated)

class SVM:
    """kernel='rbf': z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma I), b ~ U(0, 2 pi)
    (random Fourier features), then one-vs-rest linear SVMs; gamma='scale' is
    1 / (n_features * var(X)).  kernel='linear' skips the map.  ``scores`` are the margins
    of the classes; with ``probability`` a multinomial logistic model of the margins,
    fitted on the training rows, turns them into probabilities."""

    def __init__(self, kernel: str = "rbf", C: float = 1.0, gamma="scale", n_components: int = 200,
                 max_iter: int = 50, random_state: int = 42, probability: bool = False):
        if kernel not in ("rbf", "linear"):
            raise ValueError(f"svm: kernel={kernel!r} is not supported (supported: rbf, linear)")
        self.probability = bool(probability)
        self.kernel, self.C, self.gamma = kernel, float(C), gamma
        self.D, self.max_iter, self.seed = int(n_components), int(max_iter), int(random_state)

    def fit(self, df: DataFrame, features="features", label: str = "label_idx"):
        d = _vec_len(df, features)
        mapper = None
        if self.kernel == "rbf":
            gamma = self.gamma
            if gamma == "scale":
                arr = F.explode(vector_to_array(features))
                s = df.select(arr.alias("x")).agg(F.var_pop("x")).first()[0] or 1.0
                gamma = 1.0 / (d * s) if s > 0 else 1.0
            rng = np.random.default_rng(self.seed)
            W = rng.normal(0.0, math.sqrt(2.0 * float(gamma)), size=(self.D, d))
            b = rng.uniform(0.0, 2.0 * math.pi, size=self.D)
            mapper = (W, b)
        model = SVMModel(*fit_hinge(df, features, label, self.C, self.max_iter, mapper), features, mapper)
        if self.probability:
            margins = df.select(array_to_vector(model.margins(df)).alias("_svm_x"), label)
            model.platt = LogisticRegression(featuresCol="_svm_x", labelCol=label, probabilityCol="_svm_p", predictionCol="_svm_c",
                                             rawPredictionCol="_svm_r", family="multinomial", maxIter=50).fit(margins)
        return model


class SVMModel:
    def __init__(self, coefficients, intercepts, features, mapper, platt=None):
        self.coefficients, self.intercepts = np.asarray(coefficients, float), np.asarray(intercepts, float)
        self.features, self.mapper, self.platt = features, mapper, platt

    def margins(self, df: DataFrame):
        return margins_udf(self.coefficients, self.intercepts, self.mapper)(as_array(df, self.features))

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumn("scores", self.margins(df))
        out = out.withColumn("prediction", (F.array_position("scores", F.array_max("scores")) - 1).cast("double"))
        if self.platt is None:
            return out
        out = self.platt.transform(out.withColumn("_svm_x", array_to_vector("scores"))).withColumn("scores", vector_to_array("_svm_p"))
        return out.drop("_svm_x", "_svm_p", "_svm_c", "_svm_r")


# ------------------------------------------------------------------ GMM classifier

def _gmm_score_udf(params):
    """params: per class index -> list of (log weight, mean, covariance + 1e-6 I)."""
    prepared = []
    for comps in params:
        pc = []
        for logw, mu, cov in comps:
            sign, logdet = np.linalg.slogdet(cov)
            inv = np.linalg.inv(cov)
            pc.append((logw, mu, inv, logdet))
        prepared.append(pc)

    @F.pandas_udf(ArrayType(DoubleType()))
    def score(v: pd.Series) -> pd.Series:
        x = np.stack(v.to_numpy()).astype(np.float64)
        d = x.shape[1]
        out = np.empty((len(x), len(prepared)))
        for k, comps in enumerate(prepared):
            if not comps:
                out[:, k] = -np.inf
                continue
            terms = []
            for logw, mu, inv, logdet in comps:
                diff = x - mu[None, :]
                maha = np.einsum("ij,jk,ik->i", diff, inv, diff)
                terms.append(logw - 0.5 * (d * np.log(2 * np.pi) + logdet + maha))
            t = np.stack(terms, axis=1)
            m = t.max(axis=1)
            out[:, k] = m + np.log(np.exp(t - m[:, None]).sum(axis=1))
        return pd.Series(list(out))
    return score


class GMMClassifier:
    """One Gaussian mixture per class (components = min(n_components, different class rows)),
    fitted by EM for all classes at once (mixture.py); class score = mixture log density
    (``reg_covar`` on the diagonal of every covariance); softmax over classes; argmax (uniform
    priors).  Rows without a class are left out."""

    def __init__(self, n_components: int = 5, reg_covar: float = 1e-6, max_iter: int = 100,
                 random_state: int = 42, tol: float = 1e-3, covariance_type: str = "full"):
        strict("gmm", {"covariance_type": covariance_type}, {"covariance_type": ["full"]})
        self.k, self.reg, self.max_iter, self.seed = int(n_components), reg_covar, int(max_iter), random_state
        self.tol = float(tol)

    def fit(self, df: DataFrame, features="features", label: str = "label_idx"):
        rows = df.where(F.col(label).isNotNull()).select(vector_to_array(features).alias("x"),
                                                         F.col(label).cast("double").alias("y"))
        found = fit_mixtures(rows, starts(rows, self.k, self.reg, self.seed), self.reg, self.max_iter, self.tol)
        return gmm_model(found, features)


def gmm_model(mixtures: dict, features: str = "features") -> "GMMModel":
    """The classifier of fitted mixtures, {class: Gaussians}."""
    classes = sorted(mixtures)
    params = [[(math.log(max(w, 1e-300)), mu, cov) for w, mu, cov in zip(m.weights, m.means, m.covs)]
              for m in (mixtures[c] for c in classes)]
    return GMMModel(classes, params, features)


class GMMModel:
    def __init__(self, classes, params, features):
        self.classes, self.params, self.features = classes, params, features
        self._udf = _gmm_score_udf(params)

    def transform(self, df: DataFrame) -> DataFrame:
        ll = self._udf(vector_to_array(self.features))
        out = df.withColumn("_ll", ll)
        mx = F.array_max("_ll")
        soft = F.transform("_ll", lambda x: F.exp(x - mx))
        tot = F.aggregate(soft, F.lit(0.0), lambda a, b: a + b)
        out = out.withColumn("scores", F.transform(soft, lambda x: x / tot))
        cls = F.array(*[F.lit(float(c)) for c in self.classes])
        out = out.withColumn("prediction", F.element_at(cls, F.array_position("_ll", mx).cast("int")))
        return out.drop("_ll")


class KNN:
    """Registry adapter around the exact pivot-pruned kNN.  Rows are told apart by
    ``id_col``; ``weights='distance'`` votes by inverse distance."""

    def __init__(self, n_neighbors: int = 5, weights: str = "uniform", id_col: str = "uid", **kw):
        strict("knn", {"weights": weights, **kw}, {
            "weights": ["uniform", "distance"], "metric": ["minkowski", "euclidean"], "p": [2], "algorithm": None,
            "leaf_size": None, "pivots": None, "seed": None, **RUN_SETTINGS})
        self.id_col = id_col
        self.est = KNNClassifier(n_neighbors, weights=weights, **{k: kw[k] for k in ("pivots", "seed") if k in kw})

    def fit(self, df: DataFrame, features="features", label: str = "label_idx", id_col: str | None = None):
        return _KNNAdapter(self.est.fit(df, features, label, id_col or self.id_col))

    @classmethod
    def grid_scores(cls, combos, df: DataFrame, features: str, label: str, fold: str) -> list[dict] | None:
        """{fold: accuracy} of each settings in ``combos``, all from one search for the nearest rows of
        other folds; None where the settings do not share it (other ids)."""
        each = [cls(**c) for c in combos]
        if len({m.id_col for m in each}) != 1:
            return None
        widest = max((m.est for m in each), key=lambda e: e.k)
        model = widest.fit(df, features, label, each[0].id_col, fold)
        return model.fold_scores(df, [(m.est.k, m.est.weights) for m in each])


class _KNNAdapter:
    def __init__(self, model):
        self.model = model

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


# ------------------------------------------------------------------ registry

REGISTRY = {
    "random_forest": RandomForest,
    "logistic_regression": Logistic,
    "knn": KNN,
    "gaussian_nb": GaussianNB,
    "svm": SVM,
    "gmm": GMMClassifier,
}


def register_model(name: str, factory) -> None:
    """Add a model: ``factory(**params)`` must give an object with fit(df, features, label)."""
    REGISTRY[name] = factory


def build_models(model_configs: dict, seed: int = 42) -> dict:
    """Instantiate every enabled model from its settings (``enabled: false`` skipped).  An
    unknown name or setting is an error."""
    out = {}
    for name, cfg in model_configs.items():
        cfg = dict(cfg or {})
        if not cfg.pop("enabled", True):
            continue
        if name not in REGISTRY:
            raise ValueError(f"unknown model {name!r}; known: {sorted(REGISTRY)}")
        if name in ("random_forest", "logistic_regression", "svm"):
            cfg.setdefault("random_state", seed)
        out[name] = REGISTRY[name](**cfg)
    return out
