"""Catalog: classifiers, tuning, importance, projection."""

from __future__ import annotations

import time

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from .. import fixtures
from ..operators import models as M
from ..operators.knn import KNNClassifier
from ..operators.mixture import Gaussians, fit_mixtures
from ..operators.prep import Preprocessor, PrepState, label_classes, label_index_expr
from ..operators.split import split_stratified
from ..operators.tuning import grid_search
from .catalog import register
from .defaults import DEFAULT_CONFIG

SIG_NUM = ["orig_pkts", "resp_pkts", "resp_bytes", "duration", "orig_bytes"]
SIG_CAT = ["proto", "conn_state"]


def signal_frames(spark, sf):
    """flows_signal -> stratified split -> preprocessor fitted on train -> (train, test, prep)."""
    sig = fixtures.flows_signal(spark, sf)
    parts = split_stratified(sig, "label")
    prep = Preprocessor("label", SIG_CAT, SIG_NUM).fit(parts.where(F.col("split") == "train"))
    feats = prep.transform(parts, keep=["uid", "split"])
    train = M.ready_for_fit(feats.where(F.col("split") == "train"))
    test = M.ready_for_fit(feats.where(F.col("split") == "test"))
    return train, test, prep


def _predictions(model, test):
    out = model.transform(test)
    return out.select("uid", F.col("label_idx").cast("int").alias("actual"),
                      F.col("prediction").cast("int").alias("predicted"))


def _model_query(name, params, doc):
    def q(spark, sf):
        train, test, _ = signal_frames(spark, sf)
        model = M.REGISTRY[name](**params).fit(train)
        return _predictions(model, test)
    q.__name__ = f"q_ml_{name}"
    q.__doc__ = doc
    return q


register("ml_random_forest")(_model_query(
    "random_forest", {"n_estimators": 100, "max_depth": 10},
    "Random forest (100 trees, depth 10): test-split predictions on flows_signal."))
register("ml_logistic")(_model_query(
    "logistic_regression", {"max_iter": 1000},
    "Multinomial logistic regression, L2 with C = 1: test-split predictions."))
_STUMP_F = ("orig_pkts", "duration")
_STUMP_SQL = """
with d as (select uid, label, orig_pkts::double v0, duration::double v1 from flows_signal),
l as (select 0 f, v0 v, label from d union all select 1, v1, label from d),
c as (select f, v, label, count(*) n from l group by all),
t as (select label, count(*) n from d group by label),
g as (select x.f, x.v, t.label, t.n, sum(coalesce(c.n, 0)) over (partition by x.f, t.label order by x.v) ln
      from (select distinct f, v from l) x cross join t left join c on c.f = x.f and c.v = x.v and c.label = t.label),
s as (select f, v, sum(ln * ln)::double / sum(ln) + sum((n - ln) * (n - ln))::double / sum(n - ln) gain from g group by f, v having sum(n - ln) > 0),
b as (select f, v from s order by round(gain, 9) desc, f, v limit 1),
e as (select uid, d.label, (case when b.f = 0 then v0 else v1 end) <= b.v side from d, b),
m as (select side, label, row_number() over (partition by side order by count(*) desc, label) k from e group by side, label)
select uid, e.label, m.label as predicted from e join m on m.side = e.side and m.k = 1"""


@register("ml_decision_stump", _STUMP_SQL, ("flows_signal",))
def q_ml_decision_stump(spark, sf):
    """One tree of one split, exact: the best cut of two features over all rows, and the larger class
    on each side."""
    sig = fixtures.flows_signal(spark, sf).select("uid", "label", F.array(*[F.col(c).cast("double") for c in _STUMP_F]).alias("features"))
    classes = label_classes(sig, "label")
    number = label_index_expr(PrepState("label", [], [], labels=classes), "label")
    stump = M.RandomForest(n_estimators=1, max_depth=1, bootstrap=False, max_features=None)
    out = stump.fit(sig.withColumn("label_idx", number)).transform(sig)
    names = F.array(*[F.lit(c) for c in classes])
    return out.select("uid", "label", F.element_at(names, (F.col("prediction") + 1).cast("int")).alias("predicted"))


_LR_STEPS = 12
_LR_SQL = "with d as (select uid, ln(1 + orig_pkts) x, (label <> 'benign')::int y from flows_signal),\ns0 as (select 0.0::double w, 0.0::double b)" + "".join(f""",
p{i} as (select x, y, 1 / (1 + exp(-(w * x + b))) p, w from d, s{i}),
h{i} as (select sum((p - y) * x) + any_value(w) / 2 gw, sum(p - y) gb, sum(p * (1 - p) * x * x) + 0.5 hww, sum(p * (1 - p) * x) hwb, sum(p * (1 - p)) hbb from p{i}),
s{i + 1} as (select w - (hbb * gw - hwb * gb) / (hww * hbb - hwb * hwb) w, b - (hww * gb - hwb * gw) / (hww * hbb - hwb * hwb) b from s{i}, h{i})"""
    for i in range(_LR_STEPS)) + f"\nselect uid, round(1 / (1 + exp(-(w * x + b))), 6) as p from d, s{_LR_STEPS}"


@register("ml_logistic_binary", _LR_SQL, ("flows_signal",))
def q_ml_logistic_binary(spark, sf):
    """Probability of an attack from one feature (two classes), for all rows; in SQL, Newton steps for
    the difference of the two classes' coefficients, whose penalty is half as large."""
    sig = fixtures.flows_signal(spark, sf).select("uid", F.array(F.log1p("orig_pkts")).alias("features"),
                                                  (F.col("label") != "benign").cast("double").alias("label_idx"))
    model = M.Logistic().fit(sig)
    return model.transform(sig).select("uid", F.round(F.col("scores")[1], 6).alias("p"))


register("ml_svm")(_model_query(
    "svm", {"kernel": "rbf", "C": 1.0},
    "RBF SVM via random Fourier features + one-vs-rest LinearSVC: test-split predictions."))
register("ml_gmm")(_model_query(
    "gmm", {"n_components": 3},
    "Per-class Gaussian mixtures, class = largest mixture log density: test-split predictions."))


_GMM_F = ("orig_pkts", "duration")
_GMM_SQL = """
with d as (select uid, label, orig_pkts x, duration y from flows_signal),
st as (select label, avg(x) mx, avg(y) my, var_pop(x) + 1e-6 vx, var_pop(y) + 1e-6 vy, covar_pop(x, y) c from d group by label),
j as (select uid, d.label, st.label as cls,
        -0.5 * (ln(vx * vy - c * c) + (vy * (x - mx) ** 2 - 2 * c * (x - mx) * (y - my) + vx * (y - my) ** 2) / (vx * vy - c * c)) as ll
      from d, st),
r as (select uid, label, cls, row_number() over (partition by uid order by ll desc, cls) as rk from j)
select uid, label, cls as predicted from r where rk = 1"""


@register("ml_gmm_single", _GMM_SQL, ("flows_signal",))
def q_ml_gmm_single(spark, sf):
    """One Gaussian a class over two features (the closed form of the mixture): the class of
    the largest density, for all rows."""
    sig = fixtures.flows_signal(spark, sf).select("uid", "label", array_to_vector(F.array(*_GMM_F)).alias("features"))
    classes = label_classes(sig, "label")
    number = label_index_expr(PrepState("label", [], [], labels=classes), "label")
    model = M.GMMClassifier(n_components=1).fit(sig.withColumn("label_idx", number))
    names = F.array(*[F.lit(c) for c in classes])
    return model.transform(sig).select("uid", "label", F.element_at(names, (F.col("prediction") + 1).cast("int")).alias("predicted"))


_EM_STEPS = 8
_EM_SQL = """
with d as (select uid, label, ln(1 + orig_pkts) x from flows_signal),
a as (select label, avg(x) m, var_pop(x) v from d group by label),
s0 as (select label, j, 0.5::double w, m + j * sqrt(v) m, v + 1e-6 v from a, (values (-1), (1)) t(j))""" + "".join(f""",
e{i} as (select d.uid, d.label, s.j, x, s.m, ln(s.w) - 0.5 * (ln(2 * pi() * s.v) + (x - s.m) ** 2 / s.v) q from d join s{i} s using (label)),
r{i} as (select label, j, x, m, exp(q - max(q) over (partition by uid)) / sum(exp(q)) over (partition by uid) * exp(max(q) over (partition by uid)) r from e{i}),
t{i} as (select label, j, any_value(m) m, sum(r) n, sum(r * (x - m)) / sum(r) g, sum(r * (x - m) ** 2) / sum(r) h from r{i} group by label, j),
s{i + 1} as (select label, j, n / sum(n) over (partition by label) w, m + g m, h - g * g + 1e-6 v from t{i})"""
    for i in range(_EM_STEPS)) + f"""
, c as (select label, j, w, m, v from s{_EM_STEPS})
select label, cast(row_number() over (partition by label order by j) - 1 as int) as component,
  round(w, 6) as weight, round(m, 6) as mean, round(v, 6) as var from c"""


@register("ml_gmm_em", _EM_SQL, ("flows_signal",))
def q_ml_gmm_em(spark, sf):
    """Eight EM steps of two components a class over one feature, all classes in one pass a step, from
    starts one deviation below and above the class mean."""
    sig = fixtures.flows_signal(spark, sf).withColumn("x", F.log1p("orig_pkts"))
    classes = label_classes(sig, "label")
    number = label_index_expr(PrepState("label", [], [], labels=classes), "label")
    rows = sig.select(F.array("x").alias("x"), number.cast("double").alias("y"))
    at = rows.groupBy("y").agg(F.avg(F.col("x")[0]).alias("m"), F.var_pop(F.col("x")[0]).alias("v")).collect()
    start = {r["y"]: Gaussians([0.5, 0.5], [[r["m"] - r["v"] ** 0.5], [r["m"] + r["v"] ** 0.5]], [[[r["v"] + 1e-6]]] * 2)
             for r in at}
    found = fit_mixtures(rows, start, max_iter=_EM_STEPS, tol=float("-inf"))
    return spark.createDataFrame(
        [(classes[int(c)], j, round(float(g.weights[j]), 6), round(float(g.means[j, 0]), 6), round(float(g.covs[j, 0, 0]), 6))
         for c, g in found.items() for j in range(2)], "label string, component int, weight double, mean double, var double")


_NB_SQL = """
with d as (select uid, label, """ + ", ".join(SIG_NUM) + """ from flows_signal),
st as (select label, count(*) as n, """ + ", ".join(
    f"avg({c}) as m_{c}, var_pop({c}) as v_{c}" for c in SIG_NUM) + """ from d group by label),
eps as (select 1e-9 * greatest(""" + ", ".join(f"var_pop({c})" for c in SIG_NUM) + """) as e from d),
tot as (select sum(n) as n_all from st),
j as (select d.uid, d.label, st.label as cls,
        ln(st.n / (select n_all from tot)) - 0.5 * (""" + " + ".join(
    f"ln(2 * pi() * (v_{c} + (select e from eps)))" for c in SIG_NUM) + """)
        - 0.5 * (""" + " + ".join(
    f"(d.{c} - m_{c}) * (d.{c} - m_{c}) / (v_{c} + (select e from eps))" for c in SIG_NUM) + """) as jll
      from d, st),
r as (select uid, label, cls, row_number() over (partition by uid order by jll desc, cls) as rk from j)
select uid, label, cls as predicted from r where rk = 1"""


@register("ml_gaussian_nb", _NB_SQL, ("flows_signal",))
def q_ml_gaussian_nb(spark, sf):
    """Gaussian naive Bayes on the five flows_signal numerics, fitted and applied to all rows."""
    sig = fixtures.flows_signal(spark, sf)
    model = M.GaussianNB().fit(sig, SIG_NUM, "label")
    return model.transform(sig).select("uid", "label", F.col("prediction").alias("predicted"))


class FlowSignalNB:
    """A user model as the registry expects one: built from settings, ``fit(df, features,
    label)`` returns a model with ``transform``.  It fixes its own feature list (the five
    flows_signal numerics) and delegates to the Gaussian NB."""

    def __init__(self, var_smoothing: float = 1e-9, **_):
        self.var_smoothing = var_smoothing

    def fit(self, df, features="features", label="label_idx"):
        return M.GaussianNB(var_smoothing=self.var_smoothing).fit(df, SIG_NUM, label)


@register("ml_model_registry", _NB_SQL, ("flows_signal",))
def q_ml_model_registry(spark, sf):
    """A user model added to the registry by name, instantiated from a model config by
    build_models (disabled entries skipped), then fitted and applied like a built-in."""
    M.register_model("flow_signal_nb", FlowSignalNB)
    built = M.build_models({"flow_signal_nb": {"var_smoothing": 1e-9}, "svm": {"enabled": False}})
    if sorted(built) != ["flow_signal_nb"]:
        raise RuntimeError(f"unexpected models {sorted(built)}")
    sig = fixtures.flows_signal(spark, sf)
    model = built["flow_signal_nb"].fit(sig, label="label")
    return model.transform(sig).select("uid", "label", F.col("prediction").alias("predicted"))


@register("sink_models", _NB_SQL, ("flows_signal",))
def q_sink_models(spark, sf):
    """Models saved under their names in the shared folder, then loaded by name (an
    estimator from the settings where none is saved, disabled ones skipped).  The loaded
    Gaussian NB scores every flows_signal row exactly as the fitted one."""
    from ..session import scratch_dir
    from ..sources.sinks import load_models, save_models
    sig = fixtures.flows_signal(spark, sf)
    out_dir = scratch_dir(spark, "models")
    save_models(spark, {"gaussian_nb": M.GaussianNB().fit(sig, SIG_NUM, "label")}, out_dir)
    loaded = load_models(spark, out_dir, {"gaussian_nb": {}, "svm": {"enabled": False}})
    model = loaded["gaussian_nb"]
    return model.transform(sig).select("uid", "label", F.col("prediction").alias("predicted"))


_KNN_SQL = """
with e as (select vec_id, label, cast(embedding as double[]) as v from embeddings),
p as (select a.vec_id as q, b.vec_id as t, b.label as tl,
             list_reduce(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])),
                         lambda x, y: x + y) as d
      from e a join e b on a.vec_id <> b.vec_id),
r as (select q, tl, row_number() over (partition by q order by d, t) as rn from p),
v as (select q, tl, count(*) as c from r where rn <= 5 group by q, tl),
w as (select q, tl, row_number() over (partition by q order by c desc, tl) as rk from v)
select e.vec_id, e.label as actual, w.tl as predicted from e join w on e.vec_id = w.q and w.rk = 1"""


@register("ml_knn", _KNN_SQL)
def q_ml_knn(spark, sf):
    """Exact 5-NN, leave-one-out over all embeddings (pivot-pruned candidates, no all-pairs join)."""
    emb = fixtures.table(spark, sf, "embeddings")
    model = KNNClassifier(5).fit(emb, vec="embedding", label_col="label", id_col="vec_id")
    out = model.transform(emb, exclude_self=True, keep=["vec_id", "label"])
    return out.select("vec_id", F.col("label").alias("actual"), F.col("prediction").alias("predicted"))


@register("ml_train_all")
def q_ml_train_all(spark, sf):
    """Fit and save every enabled model of the default settings; training seconds and test
    accuracy."""
    from ..session import scratch_dir
    from ..sources.sinks import save_model
    train, test, _ = signal_frames(spark, sf)
    out_dir = scratch_dir(spark, "train-all")
    n_classes = train.select("label_idx").distinct().count()
    cfg = {k: dict(v) for k, v in DEFAULT_CONFIG["training"]["models"].items()}
    cfg["gmm"]["n_components"] = min(cfg["gmm"]["n_components"], n_classes)
    rows = []
    for name, est in M.build_models(cfg).items():
        t0 = time.time()
        model = est.fit(train)
        secs = time.time() - t0
        save_model(spark, model, f"{out_dir}/{name}")
        acc = _predictions(model, test).agg(F.avg((F.col("actual") == F.col("predicted")).cast("double"))).first()[0]
        rows.append((name, float(secs), float(acc)))
    return spark.createDataFrame(rows, "model string, training_seconds double, accuracy double")


@register("ml_tune")
def q_ml_tune(spark, sf):
    """Grids of a Spark ML forest, the Gaussian NB and kNN, each with stratified 5-fold
    cross-validation on accuracy."""
    train, _, _ = signal_frames(spark, sf)
    grids = {"random_forest": (RandomForestClassifier(seed=42), {"numTrees": [5, 10], "maxDepth": [3, 6]}),
             "gaussian_nb": ("gaussian_nb", {"var_smoothing": [1e-9, 1e-3]}), "knn": ("knn", {"n_neighbors": [3, 7]})}
    out = None
    for name, (model, grid) in grids.items():
        table = grid_search(model, grid, train, k=5)[1].withColumn("model", F.lit(name))
        out = table if out is None else out.unionByName(table)
    return out


@register("feature_importance")
def q_feature_importance(spark, sf):
    """Forest importances by feature name, top 20 descending."""
    train, _, prep = signal_frames(spark, sf)
    model = M.RandomForest(n_estimators=50, max_depth=10).fit(train)
    imp = model.feature_importance()
    names = prep.feature_names()
    df = spark.createDataFrame([(n, float(v)) for n, v in zip(names, imp)], "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(20)


@register("project_2d")
def q_project_2d(spark, sf):
    """Two principal components of the preprocessed features, with the class, for all rows (of every
    split; the preprocessor is fitted on the training rows)."""
    sig = fixtures.flows_signal(spark, sf)
    parts = split_stratified(sig, "label")
    prep = Preprocessor("label", SIG_CAT, SIG_NUM).fit(parts.where(F.col("split") == "train"))
    allf = M.ready_for_fit(prep.transform(parts, keep=["uid"]))
    pca = PCA(k=2, inputCol="features", outputCol="pc").fit(allf)
    arr = vector_to_array("pc")
    return pca.transform(allf).select("uid", F.col("label_idx").alias("label"),
                                      arr[0].alias("pc1"), arr[1].alias("pc2"))
