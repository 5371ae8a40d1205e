"""Evaluation tables: accuracy, confusion matrix, per-class report, ROC / AUC,
misclassification summaries, top-k.  Everything reduces the (possibly huge) prediction
frame with one aggregate first; later steps work on classes x classes rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import checkpoint_root
from .rank import running_sums


def accuracy(df: DataFrame, actual: str = "actual", predicted: str = "predicted", by=()) -> DataFrame:
    """Share of rows with predicted == actual; a null prediction is wrong."""
    right = F.coalesce((F.col(actual) == F.col(predicted)).cast("double"), F.lit(0.0))
    return df.where(F.col(actual).isNotNull()).groupBy(*by).agg(F.avg(right).alias("accuracy"))


def confusion_counts(df: DataFrame, actual="actual", predicted="predicted", by=()) -> DataFrame:
    """Long form (by..., actual, predicted, n) of the observed cells (one shuffle)."""
    return df.groupBy(*by, actual, predicted).agg(F.count(F.lit(1)).alias("n"))


def _labels(cm: DataFrame, actual, predicted, by) -> DataFrame:
    return (cm.select(*by, F.col(actual).alias("label"))
              .union(cm.select(*by, F.col(predicted).alias("label"))).distinct())


def confusion_matrix(df: DataFrame, actual="actual", predicted="predicted", by=()) -> DataFrame:
    """Wide form: one row per (by..., label) with the label in the union of actual and
    predicted, one ``pred_<label>`` count column per label, zeros included.  A null
    prediction (a row the model could not score) counts in ``pred_null``, which is there
    only if such rows are; rows without an actual label are left out."""
    by = list(by)
    checkpoint_root(df.sparkSession)
    cm = confusion_counts(df.where(F.col(actual).isNotNull()), actual, predicted, by).checkpoint(eager=True)
    seen = [r[0] for r in _labels(cm, actual, predicted, ()).collect()]
    labels = sorted(x for x in seen if x is not None)
    every = cm.select(*by).distinct() if by else df.sparkSession.range(1).select()
    rows = every.select(*by, F.explode(F.array(*[F.lit(x) for x in labels])).alias("_l")) if labels else None
    if rows is None:
        return cm.select(*by, F.col(actual).alias("actual"))
    wide = cm.groupBy(*by, F.col(actual).alias("_a")).agg(
        *[F.sum(F.when(F.col(predicted) == F.lit(x), F.col("n"))).alias(f"pred_{x}") for x in labels],
        *([F.sum(F.when(F.col(predicted).isNull(), F.col("n"))).alias("pred_null")] if None in seen else []))
    cols = [c for c in wide.columns if c.startswith("pred_")]
    cond = F.col("_l") == F.col("_a")
    r, w = rows.alias("r"), wide.alias("w")
    for c in by:
        cond = cond & F.col(f"r.{c}").eqNullSafe(F.col(f"w.{c}"))
    return (r.join(w, cond, "left").select(*[F.col(f"r.{c}").alias(c) for c in by],
                                           F.col("_l").cast(df.schema[actual].dataType).alias("actual"),
                                           *[F.coalesce(F.col(f"w.`{c}`"), F.lit(0)).cast("long").alias(c) for c in cols]))


def class_report(df: DataFrame, actual="actual", predicted="predicted", by=()) -> DataFrame:
    """Per-class precision, recall, F1, support over the union of labels (0 on a zero
    division), then rows 'accuracy', 'macro avg', 'weighted avg'.

    One pass over the predictions: each confusion cell gives its count to its actual and to
    its predicted label, and the rest works on (by, label) rows.  A null prediction counts
    as wrong and forms no class; rows without an actual label are left out."""
    by = list(by)
    cm = confusion_counts(df.where(F.col(actual).isNotNull()), actual, predicted, by)
    hit = F.coalesce(F.col(actual) == F.col(predicted), F.lit(False))
    zero = F.lit(0).cast("long")
    sides = F.array(F.struct(F.col(actual).alias("label"), F.col("n").alias("support"), zero.alias("n_pred"),
                             F.when(hit, F.col("n")).otherwise(zero).alias("tp")),
                    F.struct(F.col(predicted).alias("label"), zero.alias("support"), F.col("n").alias("n_pred"), zero.alias("tp")))
    per = (cm.select(*by, F.explode(sides).alias("s")).select(*by, "s.*").where("label is not null")
           .groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("support", "n_pred", "tp")]))
    p = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.select(*by, F.col("label").cast("string").alias("class"), p.alias("precision"), r.alias("recall"), "support", "tp")
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0)))
    rows = per.groupBy(*by).agg(
        F.collect_list(F.struct("class", "precision", "recall", "f1", "support")).alias("classes"),
        F.sum("support").alias("n"), F.sum("tp").alias("tp"),
        *[F.avg(c).alias(f"m_{c}") for c in ("precision", "recall", "f1")],
        *[F.sum(F.col(c) * F.col("support")).alias(f"w_{c}") for c in ("precision", "recall", "f1")])
    none = F.lit(None).cast("double")

    def line(name, precision, recall, f1):
        return F.struct(F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
                        f1.alias("f1"), F.col("n").alias("support"))

    def weighted(c):
        return F.try_divide(F.col(f"w_{c}"), F.col("n"))

    extra = F.array(line("accuracy", none, none, F.try_divide(F.col("tp"), F.col("n"))),
                    line("macro avg", F.col("m_precision"), F.col("m_recall"), F.col("m_f1")),
                    line("weighted avg", weighted("precision"), weighted("recall"), weighted("f1")))
    return rows.select(*by, F.explode(F.concat("classes", extra)).alias("_r")).select(*by, "_r.*")


def score_matrix_long(df: DataFrame, score_cols: dict, actual="actual", keep=()) -> DataFrame:
    """(keep..., class, score, is_pos) from per-class score columns {class: column}.  Classes
    are compared in the type of the actual label (2 and 2.0 are one class)."""
    kind = df.schema[actual].dataType
    parts = [F.struct(F.lit(str(k)).alias("class"), F.col(c).cast("double").alias("score"),
                      F.coalesce((F.col(actual) == F.lit(k).cast(kind)).cast("int"), F.lit(0)).alias("is_pos"))
             for k, c in score_cols.items()]
    return df.select(*keep, F.explode(F.array(*parts)).alias("_s")).select(*keep, "_s.*")


def model_scores_long(pred: DataFrame, classes, actual: str = "label_idx", scores: str = "scores", keep=()) -> DataFrame:
    """(keep..., class, score, is_pos) of a fitted model's ``scores`` array, whose entries
    follow ``classes`` (label values, in order): what :func:`roc_curve` takes."""
    cols = {c: f"_s{i}" for i, c in enumerate(classes)}
    wide = pred.select(*keep, actual, *[F.get(F.col(scores), i).alias(f"_s{i}") for i in range(len(cols))])
    return score_matrix_long(wide, cols, actual, keep)


def _score_steps(scores: DataFrame, class_col, score_col, pos_col, **kw) -> DataFrame:
    """Positives and negatives of each distinct score with their running sums and totals."""
    agg = (scores.where(F.col(score_col).isNotNull()).groupBy(class_col, score_col)
                 .agg(F.sum(pos_col).cast("long").alias("pos"),
                      F.sum(F.lit(1) - F.col(pos_col)).cast("long").alias("neg")))
    return running_sums(agg, [F.col(score_col).desc()], ["pos", "neg"], [class_col], total_prefix="all_", **kw)


def roc_curve(scores: DataFrame, class_col="class", score_col="score", pos_col="is_pos") -> DataFrame:
    """One-vs-rest ROC per class: at each distinct score (descending) the true and false
    positives at or above it, and their rates (null for a class without positives or
    negatives).  Ties are merged by one aggregate; the running sums are range-partitioned,
    so a class with billions of distinct scores is not put on one task, and the class totals
    come from the same statistics.  Rows without a score are left out."""
    cum = _score_steps(scores, class_col, score_col, pos_col)
    return cum.select(class_col, F.col(score_col).alias("threshold"), "pos", "neg",
                      F.col("cum_pos").alias("tps"), F.col("cum_neg").alias("fps"),
                      F.try_divide(F.col("cum_pos"), F.col("all_pos")).alias("tpr"),
                      F.try_divide(F.col("cum_neg"), F.col("all_neg")).alias("fpr"))


def roc_points(scores: DataFrame, class_col="class", score_col="score", pos_col="is_pos") -> DataFrame:
    """The curve as it is drawn: (class, threshold, tps, fps, tpr, fpr) from the start (0, 0), at
    threshold infinity, through the points where its direction changes to the last one.

    A point is left out where the step to it and the step from it are equal (the same positives
    and the same negatives): it lies on the line between its neighbours, so the drawn curve and
    its area stay.  The step from a point is the next point's counts, which lie in the next
    range for the last row of a range.  Rows without a score are left out; a class without
    positives or negatives has null rates."""
    c = _score_steps(scores, class_col, score_col, pos_col, next_cols=["pos", "neg"])
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    turns = F.col("next_pos").isNull() | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    zero = F.lit(0).cast("long")
    start = F.struct(F.lit(float("inf")).alias("threshold"), zero.alias("tps"), zero.alias("fps"))
    here = F.struct(F.col(score_col).cast("double").alias("threshold"), F.col("cum_pos").alias("tps"), F.col("cum_neg").alias("fps"))
    points = (c.where(first | turns).withColumn("_p", F.explode(F.when(first, F.array(start, here)).otherwise(F.array(here))))
              .select(class_col, "all_pos", "all_neg", "_p.*"))
    return points.select(class_col, "threshold", "tps", "fps", F.try_divide("tps", "all_pos").alias("tpr"),
                         F.try_divide("fps", "all_neg").alias("fpr"))


def roc_auc(curve: DataFrame, class_col="class") -> DataFrame:
    """Trapezoid area from (0, 0) through every curve point: each point adds
    neg * (2 * tps - pos) / (2 P N); a plain aggregate, no ordered pass.  Null for a class
    without positives or without negatives."""
    neg, tps, pos = (F.col(c).cast("double") for c in ("neg", "tps", "pos"))
    return curve.groupBy(class_col).agg(
        F.try_divide(F.sum(neg * (2 * tps - pos)),
                     2 * F.max("tps").cast("double") * F.max("fps").cast("double")).alias("auc"))


def misclass_summary(df: DataFrame, actual="actual", predicted="predicted") -> DataFrame:
    return (df.where(F.col(actual) != F.col(predicted)).groupBy(actual, predicted)
              .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), actual, predicted))


def misclass_feature_means(df: DataFrame, features, actual="actual", predicted="predicted") -> DataFrame:
    """Per feature: mean among misclassified rows, among correct rows, their difference;
    ordered by absolute difference.  One aggregate over the data."""
    wrong = F.col(actual) != F.col(predicted)
    aggs = []
    for f in features:
        aggs += [F.avg(F.when(wrong, F.col(f))).alias(f"w__{f}"), F.avg(F.when(~wrong, F.col(f))).alias(f"r__{f}")]
    row = df.agg(*aggs)
    parts = [F.struct(F.lit(f).alias("feature"), F.col(f"w__{f}").alias("misclassified_mean"),
                      F.col(f"r__{f}").alias("correct_mean")) for f in features]
    long = row.select(F.explode(F.array(*parts)).alias("s")).select("s.*")
    long = long.withColumn("difference", F.col("misclassified_mean") - F.col("correct_mean"))
    return long.orderBy(F.abs("difference").desc())


def top_k(df: DataFrame, order_col: str, k: int, tiebreak: str | None = None) -> DataFrame:
    """The k rows with the largest ``order_col`` (TakeOrderedAndProject: k rows per task)."""
    order = [F.col(order_col).desc()] + ([F.col(tiebreak)] if tiebreak else [])
    return df.orderBy(*order).limit(k)
