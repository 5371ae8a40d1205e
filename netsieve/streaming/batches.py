"""File batches as Structured Streaming micro-batches.

``readStream.text(folder)`` with ``maxFilesPerTrigger = n`` and ``trigger(availableNow)``
turns "process the files n at a time" into micro-batches; ``foreachBatch`` runs the batch
job.  A CSV schema binds by position, so the lines of a batch are parsed per header: the
files of a batch are grouped by their header line, each group is parsed with its own columns,
and the groups are unioned by name.  Every per-batch output is written to
``<sink>/batch_id=<id>`` with dynamic partition overwrite, so a retried batch replaces its own
rows instead of adding them twice.  A batch whose data the handler refuses (ValueError) is
recorded in the status table and the stream goes on; any other error stops the stream, and
the batch is run again when it is restarted.
"""

from __future__ import annotations

import hashlib
import logging
import traceback
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.aggregates import class_distribution
from ..operators.models import merge_moments
from ..operators.rank import released
from ..session import checkpoint_root, exists, scratch_dir
from ..sources import records as rec
from ..sources.files import META, _group_by_header, _same_types, _typed, infer_undeclared, parsed

log = logging.getLogger("netsieve.streaming")
STREAM_META = rec.LINE_META


def _stream(spark: SparkSession, folder: str, pattern: str, batch_files: int) -> DataFrame:
    raw = (spark.readStream.format("text").option("maxFilesPerTrigger", batch_files)
           .option("pathGlobFilter", pattern).option("lineSep", "\n").load(folder))
    # file metadata must be projected in the stream itself: a micro-batch frame has none
    return raw.select("value", *[F.col(m).alias(a) for m, a in zip(META, STREAM_META)])


def parse_lines(lines: DataFrame, label: bool = True) -> DataFrame | None:
    """Typed rows of CSV lines (columns value and STREAM_META), each file under its own
    header; None without any.  The files of a batch are few, their headers are read from
    the files themselves.  Line breaks inside quotes and undeclared columns are treated as in a
    scan of files."""
    spark = lines.sparkSession
    checkpoint_root(spark)
    counts = rec.quote_counts(lines).checkpoint()
    paths = [r[0] for r in counts.select(STREAM_META[0]).distinct().collect()]
    if rec.files_with_broken_lines(counts):
        lines = rec.records(lines, counts)
    out = None
    raw = {unquote(p): p for p in paths}                 # file metadata is percent-encoded
    for names, group in sorted(_group_by_header(spark, raw).items()):
        mine = lines.where(F.col(STREAM_META[0]).isin([raw[p] for p in group]))
        rows = parsed(mine, len(names), list(STREAM_META), names)
        typed = infer_undeclared(_typed(rows, names, label, STREAM_META), names)
        if out is None:
            out = typed
        else:
            out, typed = _same_types(out, typed)
            out = out.unionByName(typed, allowMissingColumns=True)
    return out


def _write_batch(df: DataFrame, sink: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(sink))


STATUS = "status string, error string"


def run_batches(spark: SparkSession, folder: str, handler, sink: str, pattern: str = "*.csv",
                batch_files: int = 3, label: bool = True) -> DataFrame:
    """Run ``handler(typed_batch_df, batch_id) -> DataFrame | None`` on every micro-batch
    of ``batch_files`` files; results land in ``sink`` partitioned by batch id.  Returns the
    status table (batch_id, status, error); failed batches are logged as warnings too."""
    raw = _stream(spark, folder, pattern, batch_files)
    status_sink = f"{sink.rstrip('/')}_status"

    def each(batch: DataFrame, batch_id: int) -> None:
        with released():
            lines = batch.persist()
            try:
                typed = parse_lines(lines, label)
                if typed is None or typed.isEmpty():
                    return                            # empty batch: skipped
                try:
                    out = handler(typed.drop("_block"), batch_id)
                    if out is not None:
                        _write_batch(out, sink, batch_id)
                    status = ("ok", "")
                except ValueError:                    # the batch's own data: go on with the next
                    status = ("failed", traceback.format_exc())
                    log.warning("batch %s failed: %s", batch_id, status[1])
                _write_batch(spark.createDataFrame([status], STATUS), status_sink, batch_id)
            finally:
                lines.unpersist()

    tag = hashlib.sha256(sink.rstrip("/").encode()).hexdigest()[:24]
    q = (raw.writeStream.foreachBatch(each).option("checkpointLocation", f"{checkpoint_root(spark)}/netsieve/streams/{tag}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if not exists(spark, status_sink):
        return spark.createDataFrame([], f"{STATUS}, batch_id int").select("batch_id", "status", "error")
    return spark.read.schema(f"{STATUS}, batch_id int").parquet(status_sink).select("batch_id", "status", "error")


def _results(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    """What the batches wrote (no rows if none did)."""
    if not exists(spark, sink):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(sink)


def stream_file_batches(spark: SparkSession, folder: str, batch_files: int = 3,
                        label_col: str = "label", sink: str | None = None) -> DataFrame:
    """Class distribution of every file batch: (batch_id, label, n)."""
    sink = sink or scratch_dir(spark, "stream-class-dist")
    run_batches(spark, folder, lambda df, bid: class_distribution(df, label_col), sink,
                batch_files=batch_files)
    return _results(spark, sink, f"`{label_col}` string, n long, batch_id int")


# ------------------------------------------------------------------ incremental NB statistics

def batch_moments(df: DataFrame, features, label_col: str = "label") -> DataFrame:
    """(label, feature, n, mean, m2) of one batch; n counts the values that are there (not
    null), m2 = n * population variance.  A feature without values gives no row."""
    aggs = []
    for f in features:
        aggs.append(F.struct(F.lit(f).alias("feature"), F.count(f).alias("n"), F.avg(f).alias("mean"),
                             (F.var_pop(f) * F.count(f)).alias("m2")))
    g = df.groupBy(F.col(label_col).alias("label")).agg(F.array(*aggs).alias("all"))
    return g.select("label", F.explode("all").alias("s")).select("label", "s.*").where("n > 0")


def merged_moments(parts: DataFrame) -> DataFrame:
    """Per (label, feature) totals over all batches: n, mean, population variance."""
    m = merge_moments(parts, ["label", "feature"])
    return m.select("label", "feature", "n", "mean", (F.col("m2") / F.col("n")).alias("var"))


def stream_nb_update(spark: SparkSession, folder: str, features, batch_files: int = 3,
                     label_col: str = "label", sink: str | None = None) -> DataFrame:
    """Gaussian-NB sufficient statistics that grow batch by batch: each micro-batch
    writes its (n, mean, M2) deltas keyed by batch id; the model state is their merge."""
    sink = sink or scratch_dir(spark, "stream-nb")
    run_batches(spark, folder, lambda df, bid: batch_moments(df, features, label_col), sink,
                batch_files=batch_files)
    return merged_moments(_results(spark, sink, "label string, feature string, n long, mean double, m2 double, batch_id int"))


# ------------------------------------------------------------------ per-batch model snapshots

def stream_fit_snapshots(spark: SparkSession, folder: str, model_configs: dict, categorical, numerical,
                         batch_files: int = 3, target: str = "label", models_dir: str | None = None,
                         sink: str | None = None) -> DataFrame:
    """Per batch: stratified split, preprocessor fitted on train, every model fitted and
    saved under <models_dir>/batch=<id>/<name> (overwrite: idempotent), test accuracy.  The
    frames a batch keeps are released with it.
    Returns (batch_id, model, n_train, n_test, accuracy)."""
    from ..operators import models as M
    from ..operators.prep import Preprocessor
    from ..operators.rank import track
    from ..operators.split import split_stratified
    from ..sources.sinks import save_model

    sink = sink or scratch_dir(spark, "stream-snapshots")
    models_dir = models_dir or scratch_dir(spark, "stream-models")

    def handle(df: DataFrame, batch_id: int):
        ids = "uid" if "uid" in df.columns else "row_id"
        if categorical is not None and numerical is not None:
            df = df.select(*[c for c in df.columns if c in {ids, target, *categorical, *numerical}])
        df = track(df)                               # the split reads its rows several times: parsed once
        parts = track(split_stratified(df, target, uid=ids))
        train = parts.where(F.col("split") == "train")
        prep = Preprocessor(target, categorical, numerical).fit(train)
        feats = prep.transform(parts, keep=[ids, "split"])
        tr = M.ready_for_fit(feats.where(F.col("split") == "train"))
        te = M.ready_for_fit(feats.where(F.col("split") == "test"))
        n_tr, n_te = tr.count(), te.count()
        rows = []
        for name, est in M.build_models(model_configs).items():
            model = est.fit(tr)
            save_model(spark, model, f"{models_dir}/batch={batch_id}/{name}")
            right = F.coalesce((F.col("prediction") == F.col("label_idx")).cast("double"), F.lit(0.0))
            acc = model.transform(te).agg(F.avg(right)).first()[0]
            rows.append((name, n_tr, n_te, float(acc) if acc is not None else None))
        return spark.createDataFrame(rows, "model string, n_train long, n_test long, accuracy double")

    run_batches(spark, folder, handle, sink, batch_files=batch_files)
    return _results(spark, sink, "model string, n_train long, n_test long, accuracy double, batch_id int")
