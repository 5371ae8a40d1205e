"""Grid search with stratified k-fold cross-validation on Spark ML estimators."""

from __future__ import annotations

import itertools
import statistics
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F
from pyspark.util import inheritable_thread_target

from .sampling import class_counts, class_quotas
from .threshold import hash_cuts


def stratified_folds(df: DataFrame, label: str, k: int = 5, seed: int = 42, uid="uid",
                     fold_col: str = "fold") -> DataFrame:
    """Fold 0..k-1 of every row: each class, in hash order, is cut at k - 1 threshold keys
    into runs whose sizes differ by at most one row."""
    counts = class_counts(df, label)
    table = class_quotas(df, label, {c: [n * (i + 1) // k for i in range(k - 1)] for c, n in counts.items()})
    return hash_cuts(df, [label], table, sum(counts.values()), uid, seed, cut_col=fold_col, n_groups=len(counts))


def grid_search(model, grid: dict, df: DataFrame, label: str = "label_idx",
                features: str = "features", k: int = 5, metric: str = "accuracy",
                parallelism: int = 4, seed: int = 42, uid="uid"):
    """Returns (best model, table of (params, mean, std, is_best)).

    ``model`` is a Spark ML estimator (``grid`` then maps its Param names to values, run by
    Spark's CrossValidator), or a registry name or factory of this package, whose settings
    ``grid`` names; those are scored by accuracy on the same stratified folds."""
    from .models import REGISTRY, ready_for_fit
    folds = ready_for_fit(stratified_folds(df, label, k, seed, uid))
    if isinstance(model, str):
        if model not in REGISTRY:
            raise ValueError(f"unknown model {model!r}; known: {sorted(REGISTRY)}")
        model = REGISTRY[model]
    if hasattr(model, "setFeaturesCol"):
        return _spark_grid(model, grid, folds, label, features, k, metric, parallelism, seed)
    if metric != "accuracy":
        raise ValueError("only Spark ML estimators can be scored by another metric than accuracy")
    return _factory_grid(model, grid, folds, label, features, k, parallelism)


def _table(spark, names, combos, means, stds, best):
    rows = [(", ".join(f"{n}={c[n]}" for n in names), float(m), None if s is None else float(s), i == best)
            for i, (c, m, s) in enumerate(zip(combos, means, stds))]
    return spark.createDataFrame(rows, "params string, mean_score double, std_score double, is_best boolean")


def _first_best(means) -> int:
    return max(range(len(means)), key=lambda i: (means[i], -i))


def _spark_grid(estimator, grid, folds, label, features, k, metric, parallelism, seed):
    est = estimator.setFeaturesCol(features).setLabelCol(label)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), list(values))
    maps = builder.build()
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=ev, foldCol="fold",
                        numFolds=k, parallelism=parallelism, seed=seed, collectSubModels=False)
    model = cv.fit(folds)
    combos = [{p.name: v for p, v in pm.items()} for pm in maps]
    stds = model.stdMetrics or [None] * len(maps)
    table = _table(folds.sparkSession, list(grid), combos, model.avgMetrics, stds, _first_best(model.avgMetrics))
    return model.bestModel, table


def _factory_grid(factory, grid, folds, label, features, k, parallelism):
    """Every (settings, fold) pair is an independent fit; driver threads run ``parallelism``
    of them at a time.  A factory with ``grid_scores`` scores all pairs in one pass, with the same
    result."""
    names = list(grid)
    combos = [dict(zip(names, values)) for values in itertools.product(*grid.values())]

    def score(task):
        combo, f = task
        model = factory(**combo).fit(folds.where(F.col("fold") != f), features, label)
        right = (F.col("prediction") == F.col(label)).cast("double")
        return model.transform(folds.where(F.col("fold") == f)).agg(F.avg(F.coalesce(right, F.lit(0.0)))).first()[0]

    shared = getattr(factory, "grid_scores", None)
    scores = shared(combos, folds, features, label, "fold") if shared and k > 1 else None
    if scores is not None:
        got = [s.get(f) for s in scores for f in range(k)]
    else:
        tasks = [(c, f) for c in combos for f in range(k)]
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            got = list(pool.map(inheritable_thread_target(score), tasks))
    per = [[x for x in got[i * k:(i + 1) * k] if x is not None] for i in range(len(combos))]
    means = [statistics.fmean(x) if x else 0.0 for x in per]
    best = _first_best(means)
    stds = [statistics.pstdev(x) if x else None for x in per]
    model = factory(**combos[best]).fit(folds, features, label)
    return model, _table(folds.sparkSession, names, combos, means, stds, best)
