"""Evaluation tables on predictions that real models give: null predictions, absent classes,
label types, large counts."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from netsieve import fixtures
from netsieve.operators import evaluate as ev
from netsieve.operators import models as M
from netsieve.plans.q_models import SIG_NUM


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture()
def preds(spark):
    data = [("m", 0, 0), ("m", 0, None), ("m", 1, 0), ("m", 1, 1), ("k", 0, 0), ("k", 2, 2), ("k", None, 2)]
    return spark.createDataFrame(data, "model string, actual int, predicted int")


def test_null_predictions(preds):
    cm = {r["actual"]: r.asDict() for r in ev.confusion_matrix(preds).collect()}
    assert cm[0]["pred_null"] == 1 and cm[0]["pred_0"] == 2 and cm[1]["pred_1"] == 1 and cm[2]["pred_2"] == 1
    rep = {r["class"]: r for r in ev.class_report(preds).collect()}
    assert rep["0"]["support"] == 3 and rep["0"]["recall"] == pytest.approx(2 / 3) and rep["accuracy"]["f1"] == pytest.approx(4 / 6)
    assert ev.accuracy(preds).first()["accuracy"] == pytest.approx(4 / 6)


def test_confusion_by_model(preds):
    got = {(r["model"], r["actual"]): (r["pred_0"], r["pred_1"], r["pred_2"]) for r in ev.confusion_matrix(preds, by=["model"]).collect()}
    assert got["m", 1] == (1, 1, 0) and got["k", 0] == (1, 0, 0) and got["k", 1] == (0, 0, 0) and len(got) == 6


def test_class_report_reads_the_predictions_once(spark):
    plan = ev.class_report(fixtures.predictions(spark, SF01))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 1 or plan.count("Scan parquet") <= 1


def test_score_matrix_compares_in_the_label_type(spark):
    df = spark.createDataFrame([(2.0, 0.9), (1.0, 0.1)], "label_idx double, s double")
    assert rows(ev.score_matrix_long(df, {2: "s"}, "label_idx"), "class", "is_pos") == [("2", 0), ("2", 1)]


def test_auc_of_absent_class_and_large_counts(spark):
    curve = spark.createDataFrame([("a", 3 * 10**9, 0, 3 * 10**9, 0), ("a", 0, 3 * 10**9, 3 * 10**9, 3 * 10**9), ("b", 0, 5, 0, 5)],
                                  "class string, pos long, neg long, tps long, fps long")
    assert {r["class"]: r["auc"] for r in ev.roc_auc(curve).collect()} == {"a": 1.0, "b": None}


def test_roc_of_fitted_models(spark):
    sig = fixtures.flows_signal(spark, SF01)
    nb = M.GaussianNB().fit(sig, SIG_NUM, "label")
    pred = nb.transform(sig)
    auc = {r["class"]: r["auc"] for r in ev.roc_auc(ev.roc_curve(ev.model_scores_long(pred, nb.classes, "label"))).collect()}
    assert set(auc) == set(nb.classes)
    s = pred.select("label", F.get("scores", nb.classes.index("scan")).alias("s")).collect()
    pos, neg = [r["s"] for r in s if r["label"] == "scan"], [r["s"] for r in s if r["label"] != "scan"]
    import bisect
    neg.sort()
    wins = sum(bisect.bisect_left(neg, p) + (bisect.bisect_right(neg, p) - bisect.bisect_left(neg, p)) / 2 for p in pos)
    assert auc["scan"] == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-9)


def drawn(scores):
    """Points of one class, by plain loops: (threshold, tps, fps)."""
    steps = {}
    for s, y in scores:
        p, n = steps.get(s, (0, 0))
        steps[s] = (p + y, n + 1 - y)
    keys, out, t, f = sorted(steps, reverse=True), [(float("inf"), 0, 0)], 0, 0
    for i, k in enumerate(keys):
        t, f = t + steps[k][0], f + steps[k][1]
        if i in (0, len(keys) - 1) or steps[k] != steps[keys[i + 1]]:
            out.append((k, t, f))
    return out


def area(points):
    p, n = points[-1][1], points[-1][2]
    return sum((b[2] - a[2]) * (a[1] + b[1]) for a, b in zip(points, points[1:])) / (2 * p * n)


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_drawn_curve_over_range_edges(spark, coalesce):
    import random
    rng = random.Random(3)
    data = [("a", rng.randrange(400) / 400, int(rng.random() < 0.3)) for _ in range(3000)]
    data += [("b", i / 500, 1 if i >= 250 else 0) for i in range(500)]           # two straight lines
    data += [(None, 0.5, 1), (None, 0.5, 0), (None, 0.25, 1), (None, None, 1), ("pos", 0.1, 1)]
    df = spark.createDataFrame(data, "class string, score double, is_pos int")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(key)
    spark.conf.set(key, coalesce)
    try:
        got = ev.roc_points(df).collect()
        auc = {r["class"]: r["auc"] for r in ev.roc_auc(ev.roc_curve(df)).collect()}
    finally:
        spark.conf.set(key, was)
    for c in ("a", "b", None, "pos"):
        want = drawn([(s, y) for k, s, y in data if k == c and s is not None])
        mine = sorted(((r["threshold"], r["tps"], r["fps"]) for r in got if r["class"] == c), reverse=True)
        assert mine == want
        if c != "pos":
            assert auc[c] == pytest.approx(area(want))
    assert len([r for r in got if r["class"] == "b"]) == 4
    assert {r["fpr"] for r in got if r["class"] == "pos"} == {None}
    assert ev.roc_points(df.where("false")).count() == 0
