"""Catalog: evaluation and analysis tables on F2 `predictions`."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..operators import evaluate as ev
from .catalog import register

F2 = ("predictions",)
CLASSES = [0, 1, 2, 3]


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _pred(spark, sf):
    return fixtures.predictions(spark, sf)


@register("eval_accuracy", "select round(avg(cast(predicted = actual as double)), 6) as accuracy "
                           "from predictions", F2)
def q_eval_accuracy(spark, sf):
    """Share of rows with predicted == actual."""
    return ev.accuracy(_pred(spark, sf)).select(r6("accuracy").alias("accuracy"))


_LABELS = [-1, 0, 1, 2, 3]


@register("eval_confusion", "with l as (select actual as label from predictions union "
          "select predicted from predictions) select l.label as actual, " + ", ".join(
              f"cast(coalesce(sum(case when p.predicted = {v} then 1 else 0 end), 0) as bigint) as \"pred_{v}\""
              for v in _LABELS) + " from l left join predictions p on p.actual = l.label group by l.label", F2)
def q_eval_confusion(spark, sf):
    """Actual x predicted counts over the union of labels, zero cells included."""
    return ev.confusion_matrix(_pred(spark, sf))


def _report_sql(src: str, by: str = "") -> str:
    """Oracle text for the class report of ``src`` (columns [model,] actual, predicted)."""
    b = f"{by}, " if by else ""
    on = (lambda a, c: f"{a}.{by} = {c}.{by} and ") if by else (lambda a, c: "")
    g = f"group by {by}" if by else ""
    return f"""
cm as (select {b}actual, predicted, count(*) as n from {src} group by {b}actual, predicted),
l as (select {b}actual as label from cm union select {b}predicted from cm),
per as (select {'l.' + by + ', ' if by else ''}cast(l.label as varchar) as class,
  coalesce((select sum(n) from cm where {on('cm', 'l')}cm.actual = l.label), 0) as support,
  coalesce((select sum(n) from cm where {on('cm', 'l')}cm.predicted = l.label), 0) as n_pred,
  coalesce((select sum(n) from cm where {on('cm', 'l')}cm.actual = l.label and cm.predicted = l.label), 0) as tp
  from l),
m as (select *, case when n_pred > 0 then tp / n_pred else 0 end as precision,
             case when support > 0 then tp / support else 0 end as recall from per),
f as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall)
                     else 0 end as f1 from m),
rep as (
select {b}class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1,
       cast(support as bigint) as support from f
union all select {b}'accuracy', null, null, round(sum(tp) / sum(support), 6), cast(sum(support) as bigint)
  from f {g}
union all select {b}'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
  cast(sum(support) as bigint) from f {g}
union all select {b}'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  cast(sum(support) as bigint) from f {g})"""


def _report_out(df):
    return df.select(*[c for c in df.columns if c not in ("precision", "recall", "f1")],
                     r6("precision").alias("precision"), r6("recall").alias("recall"), r6("f1").alias("f1"))


@register("eval_class_report", "with " + _report_sql("predictions") + " select * from rep", F2)
def q_eval_class_report(spark, sf):
    """Precision, recall, F1, support per class; accuracy, macro and weighted rows."""
    return _report_out(ev.class_report(_pred(spark, sf)))


# A second scored "model" for the multi-model tables: the majority-class baseline,
# derived from the data by one aggregate.
_MAJ_SQL = "(select actual from predictions group by actual order by count(*) desc, actual limit 1)"
_MODELS_SQL = (f"scored as (select 'f2_model' as model, actual, predicted from predictions union all "
               f"select 'majority' as model, actual, {_MAJ_SQL} as predicted from predictions)")


def scored_models(spark, sf):
    p = _pred(spark, sf)
    top = p.groupBy("actual").count().orderBy(F.desc("count"), "actual").first()
    base = p.select(F.lit("f2_model").alias("model"), "actual", "predicted")
    guess = F.lit(top["actual"] if top else None).cast("int")
    return base.unionByName(p.select(F.lit("majority").alias("model"), "actual", guess.alias("predicted")))


@register("eval_all", "with " + _MODELS_SQL + ", " + _report_sql("scored", "model") + " select * from rep", F2)
def q_eval_all(spark, sf):
    """The class report of every scored model, from one long (model, actual, predicted) frame."""
    return _report_out(ev.class_report(scored_models(spark, sf), by=["model"]))


@register("eval_summary", "with " + _MODELS_SQL + " select model, round(avg(cast(actual = predicted as double)), 6)"
          " as accuracy from scored group by model", F2)
def q_eval_summary(spark, sf):
    """Per model accuracy, best first (training / inference seconds are added by the run)."""
    acc = ev.accuracy(scored_models(spark, sf), by=["model"])
    return acc.select("model", r6("accuracy").alias("accuracy")).orderBy(F.desc("accuracy"))


@register("sink_comparison_csv", "with " + _MODELS_SQL + " select model, round(avg(cast(actual = predicted as double)),"
          " 6) as accuracy from scored group by model", F2)
def q_sink_comparison_csv(spark, sf):
    """The model comparison table written as one headed CSV file in the shared folder and
    read back: the file holds exactly the summary's rows."""
    from ..session import scratch_dir
    from ..sources.sinks import write_comparison_csv
    path = scratch_dir(spark, "comparison")
    write_comparison_csv(q_eval_summary(spark, sf), path)
    return spark.read.option("header", "true").schema("model string, accuracy double").csv(path)


# ---------------------------------------------------------------- ROC

def class_scores(spark, sf):
    """Per-class scores from F2: class 2 has `score`, other classes the predicted indicator."""
    p = _pred(spark, sf)
    cols = {}
    exprs = []
    for c in CLASSES:
        e = F.col("score") if c == 2 else (F.col("predicted") == c).cast("double")
        exprs.append(e.alias(f"s_{c}"))
        cols[c] = f"s_{c}"
    wide = p.select("uid", "actual", *exprs)
    return ev.score_matrix_long(wide, cols, keep=["uid"])


@register("roc_absent_class", "with s as (select cast(c as varchar) as class, score * (c + 1) as score, "
          "cast(actual = c as int) as is_pos from predictions, (values (2), (7)) v(c)), a as (select class, score, "
          "sum(is_pos) as pos, sum(1 - is_pos) as neg from s group by 1, 2), c as (select *, "
          "sum(pos) over (partition by class order by score desc rows unbounded preceding) as tps, "
          "sum(pos) over (partition by class) as p_all, sum(neg) over (partition by class) as n_all from a) "
          "select class, round(sum(cast(neg as double) * (2 * tps - pos)) / nullif(2 * max(cast(p_all as double)) * "
          "max(n_all), 0), 6) as auc from c group by class", F2)
def q_roc_absent_class(spark, sf):
    """AUC of a class that occurs (2) and of one that never does (7: no area, null)."""
    p = _pred(spark, sf).select("actual", F.array(F.col("score") * 3, F.col("score") * 8).alias("scores"))
    curve = ev.roc_curve(ev.model_scores_long(p, [2, 7], "actual"))
    return ev.roc_auc(curve).select("class", r6("auc").alias("auc"))


@register("eval_confusion_by_model", "with " + _MODELS_SQL + ", l as (select m.model, x.label from "
          "(select distinct model from scored) m, (select actual as label from scored union select predicted from scored) x) "
          "select l.model, l.label as actual, " + ", ".join(
              f"cast(coalesce(sum(case when p.predicted = {v} then 1 else 0 end), 0) as bigint) as \"pred_{v}\""
              for v in _LABELS) + " from l left join scored p on p.model = l.model and p.actual = l.label group by l.model, l.label", F2)
def q_eval_confusion_by_model(spark, sf):
    """The confusion matrix of every scored model."""
    return ev.confusion_matrix(scored_models(spark, sf), by=["model"])


_SCORES_SQL = ("s as (select cast(c as varchar) as class, case when c = 2 then score "
               "else cast(predicted = c as double) end as score, cast(actual = c as int) as is_pos "
               "from predictions, (values (0), (1), (2), (3)) v(c))")


def _curve_sql(class_expr: str) -> str:
    return f"""a as (select {class_expr} as class, score, cast(sum(is_pos) as bigint) as pos,
                   cast(sum(1 - is_pos) as bigint) as neg from s group by 1, 2),
c as (select *, cast(sum(pos) over (partition by class order by score desc rows unbounded preceding) as bigint) as tps,
                cast(sum(neg) over (partition by class order by score desc rows unbounded preceding) as bigint) as fps,
                sum(pos) over (partition by class) as p_all, sum(neg) over (partition by class) as n_all from a)"""


@register("roc_curve", "with " + _SCORES_SQL + ", " + _curve_sql("class") +
          " select class, score as threshold, pos, neg, tps, fps, round(tps / p_all, 6) as tpr, "
          "round(fps / n_all, 6) as fpr from c", F2)
def q_roc_curve(spark, sf):
    """One-vs-rest TPR/FPR at each distinct score, per class."""
    cur = ev.roc_curve(class_scores(spark, sf))
    return cur.select("class", "threshold", "pos", "neg", "tps", "fps",
                      r6("tpr").alias("tpr"), r6("fpr").alias("fpr"))


@register("roc_points", "with " + _SCORES_SQL + ", " + _curve_sql("class") +
          ", w as (select *, row_number() over o as rn, lead(pos) over o as npos, lead(neg) over o as nneg from c "
          "window o as (partition by class order by score desc)), "
          "p as (select class, cast(score as double) as threshold, tps, fps, p_all, n_all from w "
          "where rn = 1 or npos is null or npos <> pos or nneg <> neg union all "
          "select class, cast('infinity' as double), 0, 0, p_all, n_all from w where rn = 1) "
          "select class, threshold, tps, fps, round(tps / p_all, 6) as tpr, round(fps / n_all, 6) as fpr from p", F2)
def q_roc_points(spark, sf):
    """The drawn curve per class: from (0, 0), without the points between equal steps."""
    cur = ev.roc_points(class_scores(spark, sf))
    return cur.select("class", "threshold", "tps", "fps", r6("tpr").alias("tpr"), r6("fpr").alias("fpr"))


@register("roc_auc", "with " + _SCORES_SQL + ", " + _curve_sql("class") +
          " select class, round(sum(neg * (2 * tps - pos)) / (2 * max(p_all) * max(n_all)), 6) as auc "
          "from c group by class", F2)
def q_roc_auc(spark, sf):
    """Area under each one-vs-rest curve (trapezoid from (0, 0))."""
    return ev.roc_auc(ev.roc_curve(class_scores(spark, sf))).select("class", r6("auc").alias("auc"))


@register("roc_micro", "with " + _SCORES_SQL + ", " + _curve_sql("'micro'") +
          ", auc as (select round(sum(neg * (2 * tps - pos)) / (2 * max(p_all) * max(n_all)), 6) as auc from c)"
          " select score as threshold, tps, fps, round(tps / p_all, 6) as tpr, round(fps / n_all, 6) as fpr, "
          "(select auc from auc) as auc from c", F2)
def q_roc_micro(spark, sf):
    """All (row, class) pairs pooled: one curve and its area."""
    pooled = class_scores(spark, sf).withColumn("class", F.lit("micro"))
    cur = ev.roc_curve(pooled)
    auc = ev.roc_auc(cur)
    return (cur.join(F.broadcast(auc), "class")
            .select("threshold", "tps", "fps", r6("tpr").alias("tpr"), r6("fpr").alias("fpr"),
                    r6("auc").alias("auc")))


# ---------------------------------------------------------------- analysis

@register("top_k", "select uid, score from predictions order by score desc, uid limit 20", F2)
def q_top_k(spark, sf):
    """The 20 highest scores (ties by uid)."""
    return ev.top_k(_pred(spark, sf).select("uid", "score"), "score", 20, "uid")


@register("misclass_summary", "select actual, predicted, count(*) as n from predictions "
                              "where actual <> predicted group by 1, 2", F2)
def q_misclass_summary(spark, sf):
    """Misclassified counts by (actual, predicted), largest first."""
    return ev.misclass_summary(_pred(spark, sf))


@register("misclass_feature_means", " union all ".join(
    f"select '{f}' as feature, round(avg(case when actual <> predicted then {f} end), 6) as misclassified_mean, "
    f"round(avg(case when actual = predicted then {f} end), 6) as correct_mean, "
    f"round(avg(case when actual <> predicted then {f} end) - avg(case when actual = predicted then {f} end), 6)"
    f" as difference from predictions" for f in ("f_value", "f_pkts")), F2)
def q_misclass_feature_means(spark, sf):
    """Per feature: mean among wrong rows, among right rows, and the difference."""
    t = ev.misclass_feature_means(_pred(spark, sf), ["f_value", "f_pkts"])
    return t.select("feature", *[r6(c).alias(c) for c in ("misclassified_mean", "correct_mean", "difference")])
