"""The configured training run: a plain dict in, DataFrames out.

discover -> scan (or feature cache) -> features -> balance / cap / fraction (once, over all
files) -> split (time if a timestamp exists, else stratified) -> preprocessor fitted on
train -> every enabled model fitted once on all selected rows -> evaluation tables and
the comparison summary.  Per-batch refits (the reference's file-batch loop) are offered
by ``netsieve.streaming.stream_fit_snapshots``.
"""

from __future__ import annotations

import itertools
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import CompositeFeatures, NetworkTrafficFeatures, TimeBasedFeatures
from ..operators import evaluate as ev
from ..operators import models as M
from ..operators.aggregates import class_distribution
from ..operators.prep import Preprocessor, select_features
from ..operators.rank import track
from ..operators.sampling import sample_balanced, sample_fraction, sample_stratified_cap
from ..operators.split import split_stratified, split_time
from ..operators.tuning import grid_search
from ..session import scratch_dir
from ..sources import cache as fcache
from ..sources import files as fsrc
from ..sources.sinks import save_model, write_comparison_csv
from .defaults import merged

EXTRACTORS = {"network_traffic": NetworkTrafficFeatures, "time_based": TimeBasedFeatures}


def register_extractor(name: str, cls) -> None:
    """Make a user's extractor (a :class:`FeatureExtractor` subclass without required arguments, or
    any callable that returns an extractor) available by name to ``features.extractors``."""
    if not callable(cls):
        raise TypeError(f"extractor {name!r} must be a class or a callable that returns an extractor")
    EXTRACTORS[name] = cls


def build_extractor(names) -> CompositeFeatures:
    """The named extractors, in order; a name that is not registered raises."""
    unknown = [n for n in names if n not in EXTRACTORS]
    if unknown:
        raise ValueError(f"unknown extractors {unknown}: known are {sorted(EXTRACTORS)}, others by register_extractor")
    return CompositeFeatures([EXTRACTORS[n]() for n in names])


def load_flows(spark: SparkSession, cfg: dict) -> tuple[DataFrame, int]:
    data, feats = cfg["data"], cfg["features"]
    files = fsrc.discover_files(spark, data["path"], data.get("file_pattern", "*.csv"), data.get("num_files"))
    paths = [r["path"] for r in files.collect()]
    if not paths:
        raise FileNotFoundError(f"no data files under {data['path']}")
    ex = build_extractor(feats.get("extractors", []))
    cap = None
    if data.get("max_chunks_per_file"):
        cap = int(data["max_chunks_per_file"]) * int(data.get("chunk_size", 50_000))
    if data.get("cache_processed"):
        root = data.get("cache_dir") or scratch_dir(spark, "feature-cache")
        df = fcache.cached_features(spark, files, ex, root, cap).drop("extractor", "file_key")
    else:
        raw = fsrc.scan_flows(spark, paths, cap=cap)
        df = ex.extract_features(raw.drop("_block"))
    return df, len(paths)


def id_columns(df: DataFrame, cfg: dict) -> list[str]:
    """Columns that tell any two rows apart: as configured, else the row id of a scan, else
    uid.  No id is taken from the data unless asked for: uid may be null or repeat."""
    given = cfg["data"].get("id_columns")
    if given:
        return [given] if isinstance(given, str) else list(given)
    for c in ("row_id", "uid"):
        if c in df.columns:
            return [c]
    raise ValueError("no row id: name data.id_columns, or scan the rows from files")


def select_rows(df: DataFrame, cfg: dict, n_files: int, target: str) -> DataFrame:
    data = cfg["data"]
    seed = cfg["training"].get("seed", 42)
    max_rows = data.get("max_rows")
    ids = id_columns(df, cfg)
    if data.get("balance_classes") and target in df.columns:
        df = sample_balanced(df, target, "file_path", max_rows, n_files, seed, ids, data.get("balance_policy", "per_file"))
    if max_rows:
        df = sample_stratified_cap(df, int(max_rows), target, seed, ids)
    elif data.get("sample_fraction"):
        df = sample_fraction(df, float(data["sample_fraction"]), target, seed, ids)
    return df


def tuned(name: str, cfg: dict, grid: dict, train: DataFrame, ids, seed: int):
    """The best of a model's settings by cross-validation: (settings, table)."""
    fixed = {k: v for k, v in cfg.items() if k not in grid and k != "enabled"}
    _, table = grid_search(lambda **p: M.REGISTRY[name](**fixed, **p), grid, train, k=5, seed=seed, uid=ids)
    names = list(grid)
    combos = [dict(zip(names, values)) for values in itertools.product(*grid.values())]
    best = next(i for i, r in enumerate(table.collect()) if r["is_best"])
    return {**cfg, **combos[best]}, table


def run_training(spark: SparkSession, config: dict | None = None, frame: DataFrame | None = None) -> dict:
    """Run the whole flow.  ``frame`` may replace the file scan (already featurised rows)."""
    cfg = merged(config)
    feats, tr = cfg["features"], cfg["training"]
    target = feats.get("target_column", "label")
    seed = tr.get("seed", 42)
    unknown = [n for n in tr.get("param_grids", {}) if n not in M.REGISTRY]
    if unknown:
        raise ValueError(f"grids for unknown models {unknown}: known are {sorted(M.REGISTRY)}")
    if frame is None:
        df, n_files = load_flows(spark, cfg)
    else:
        df, n_files = frame, frame.select("file_path").distinct().count() if "file_path" in frame.columns else 1
    df = select_rows(df, cfg, n_files, target)
    dist = class_distribution(df, target)
    ids = id_columns(df, cfg)
    if "timestamp" in df.columns:
        parts = split_time(df, "timestamp", tiebreak=ids)
    else:
        parts = split_stratified(df, target, seed=seed, uid=ids)
    numeric, categorical = select_features(df, target, feats.get("categorical_columns"), feats.get("numerical_columns"))
    categorical = [c for c in categorical if c not in (*ids, "row_id", "file_path", "file_name")]
    prep = Preprocessor(target, categorical, numeric).fit(parts.where(F.col("split") == "train"))
    data = prep.transform(parts, keep=[*ids, "split"])
    train = M.ready_for_fit(data.where(F.col("split") == "train"))
    test = M.ready_for_fit(data.where(F.col("split") == "test"))
    n_classes = len(prep.state.labels)
    model_cfg = {k: dict(v) for k, v in tr.get("models", {}).items()}
    if "gmm" in model_cfg:
        model_cfg["gmm"]["n_components"] = min(int(model_cfg["gmm"].get("n_components", 5)), n_classes)
    if "knn" in model_cfg and len(ids) == 1:
        model_cfg["knn"].setdefault("id_col", ids[0])
    out_dir = tr.get("output_dir")
    tuning = {}
    if tr.get("hyperparameter_tuning"):
        for name, grid in tr.get("param_grids", {}).items():
            if model_cfg.get(name, {}).get("enabled", True) and name in model_cfg:
                model_cfg[name], tuning[name] = tuned(name, model_cfg[name], grid, train, ids, seed)
    timings, fitted, scored, curves = [], {}, [], []
    classes = [float(i) for i in range(n_classes)]
    for name, est in M.build_models(model_cfg, seed).items():
        t0 = time.time()
        model = est.fit(train)
        fit_s = time.time() - t0
        fitted[name] = model
        if out_dir:
            save_model(spark, model, f"{out_dir}/{name}")
        t0 = time.time()
        out = model.transform(test)
        has_scores = "scores" in out.columns
        pred = track(out.select(F.lit(name).alias("model"), F.col("label_idx").cast("int").alias("actual"),
                                F.col("prediction").cast("int").alias("predicted"), *(["scores"] if has_scores else [])))
        pred.count()
        if has_scores:       # entries follow the classes the model was fitted on
            fitted_on = getattr(model, "classes", None) or getattr(getattr(model, "model", None), "classes", None) or classes
            curves.append(ev.model_scores_long(pred, fitted_on, "actual", keep=["model"]))
        pred = pred.drop("scores")
        timings.append((name, float(fit_s), float(time.time() - t0)))
        scored.append(pred)
    scored_all = scored[0]
    for p in scored[1:]:
        scored_all = scored_all.unionByName(p)
    report = ev.class_report(scored_all, by=["model"])
    acc = ev.accuracy(scored_all, by=["model"])
    times = spark.createDataFrame(timings, "model string, training_time double, inference_time double")
    summary = times.join(acc, "model").orderBy(F.desc("accuracy"))
    if out_dir:
        write_comparison_csv(summary, f"{out_dir}/model_comparison.csv")
    roc = None
    for c in curves:
        roc = c if roc is None else roc.unionByName(c)
    if roc is not None:                          # one curve per model and class
        roc = ev.roc_curve(roc.withColumn("class", F.concat_ws("/", "model", "class")))
    return {"confusion": ev.confusion_matrix(scored_all, by=["model"]), "roc": roc, "tuning": tuning,
            "class_distribution": dist, "splits": parts.groupBy("split").count(), "preprocessor": prep,
            "models": fitted, "predictions": scored_all, "report": report, "summary": summary}
