"""Catalog: file-arrival streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..session import scratch_dir
from ..sources.fixture_csv import write_csv_files
from ..streaming import (nb_model, online_predictions, stream_file_batches, stream_fit_snapshots, stream_logistic_online,
                         stream_nb_state, stream_nb_update)
from .catalog import register
from .q_features import NORM_SQL
from .q_models import _NB_SQL

SIG_COLS = ["uid", "ts", "proto", "conn_state", "orig_pkts", "resp_pkts", "resp_bytes", "duration",
            "orig_bytes", "label"]
SIG_NUM = ["orig_pkts", "resp_pkts", "resp_bytes", "duration", "orig_bytes"]


@register("stream_file_batches",
          f"select label, count(*) as n from (select {NORM_SQL} as label from flows) t group by label",
          ("flows",))
def q_stream_file_batches(spark, sf):
    """Files of two header layouts streamed four per micro-batch; per-batch class counts,
    summed over batches."""
    d = write_csv_files(spark, fixtures.flows(spark, sf), "stream-files", drop={"capture-3": ["service", "history"]})
    per_batch = stream_file_batches(spark, d, batch_files=4)
    return per_batch.groupBy("label").agg(F.sum("n").alias("n"))


_MOMENTS_SQL = ("select label, feature, count(v) as n, round(avg(v), 6) as mean, "
                "round(sqrt(var_pop(v)), 6) as std from (" + " union all ".join(
                    f"select {NORM_SQL} as label, '{c}' as feature, {c} as v from flows" for c in SIG_NUM)
                + ") t group by label, feature")


@register("stream_nb_update", _MOMENTS_SQL, ("flows",))
def q_stream_nb_update(spark, sf):
    """NB statistics of columns with nulls, merged across micro-batches (pairwise variance
    update) = one-shot.
    The spread is shown as a standard deviation: at the scale of byte-count variances six
    decimals exceed what two summation orders agree on."""
    d = write_csv_files(spark, fixtures.flows(spark, sf), "stream-nb")
    m = stream_nb_update(spark, d, SIG_NUM, batch_files=4)
    return m.select("label", "feature", "n", F.round("mean", 6).alias("mean"),
                    F.round(F.sqrt("var"), 6).alias("std"))


@register("stream_fit_snapshots")
def q_stream_fit_snapshots(spark, sf):
    """Per micro-batch (4 files): split, preprocess, fit, save, test accuracy."""
    d = write_csv_files(spark, fixtures.flows_signal(spark, sf), "stream-fit", columns=SIG_COLS)
    cfg = {"gaussian_nb": {}, "random_forest": {"n_estimators": 20, "max_depth": 8},
           "logistic_regression": {"max_iter": 100}}
    return stream_fit_snapshots(spark, d, cfg, ["proto", "conn_state"], SIG_NUM, batch_files=4)


@register("stream_nb_state", _MOMENTS_SQL, ("flows",))
def q_stream_nb_state(spark, sf):
    """The statistics of stream_nb_update kept in the state store by transformWithState."""
    d = write_csv_files(spark, fixtures.flows(spark, sf), "stream-state")
    m = stream_nb_state(spark, d, SIG_NUM, batch_files=4)
    return m.select("label", "feature", "n", F.round("mean", 6).alias("mean"),
                    F.round(F.sqrt(F.col("m2") / F.col("n")), 6).alias("std"))


@register("stream_nb_model", _NB_SQL, ("flows_signal",))
def q_stream_nb_model(spark, sf):
    """Gaussian naive Bayes learned from arriving files through the state store: the classes
    it gives to all rows are those of one fit on all of them."""
    sig = fixtures.flows_signal(spark, sf)
    d = write_csv_files(spark, sig, "stream-model", columns=SIG_COLS)
    model = nb_model(stream_nb_state(spark, d, SIG_NUM, batch_files=4, count=True), SIG_NUM)
    return model.transform(sig).select("uid", "label", F.col("prediction").alias("predicted"))


@register("stream_logistic_online")
def q_stream_logistic_online(spark, sf):
    """A logistic model learned from arriving files, four a batch, each read once; the classes that
    the last state gives to all rows."""
    sig = fixtures.flows_signal(spark, sf)
    d = write_csv_files(spark, sig, "stream-online", columns=SIG_COLS)
    state = scratch_dir(spark, "online-state")
    stream_logistic_online(spark, d, ["proto", "conn_state"], SIG_NUM, batch_files=4, state=state)
    return online_predictions(spark, state, sig, keep=["uid", "label"])
