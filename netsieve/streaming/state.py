"""Gaussian-NB statistics kept in the state store.

The moments of the file batches (``batches.batch_moments``, one row a label and feature, one
partition a batch) are themselves read as a stream.  A keyed processor holds (n, mean, M2) of a
label and feature and merges only what is new; a later run, or one after a failure, goes on from
the committed state and reads no older batch again.  The state is the model: it is read straight
from the store.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.models import GaussianNBModel
from ..session import checkpoint_root, exists, scratch_dir
from .batches import batch_moments, run_batches

MOMENTS = "label string, feature string, n long, mean double, m2 double, batch_id int"
STATE = "n long, mean double, m2 double, batch_id int"
MERGED = "label string, feature string, n long, mean double, m2 double"
ROWS = "_rows"                   # stands for a value in every row
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTINGS = ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")


def merged(state: tuple, new: tuple) -> tuple:
    """(n, mean, M2) of two disjoint sets of values together (pairwise update)."""
    (n1, mean1, m1), (n2, mean2, m2) = state, new
    n = n1 + n2
    if not n:
        return 0, 0.0, 0.0
    gap = mean2 - mean1
    return n, mean1 + gap * n2 / n, m1 + m2 + gap * gap * n1 * n2 / n


class MomentsProcessor(StatefulProcessor):
    """State of one (label, feature): n, mean, M2 and the last batch merged.  A batch id that
    was merged before adds nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.moments = handle.getValueState("moments", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        *state, last = self.moments.get() if self.moments.exists() else (0, 0.0, 0.0, -1)
        for r in sorted(rows, key=lambda r: r["batch_id"]):
            if r["batch_id"] > last:
                state, last = merged(state, (r["n"], r["mean"], r["m2"])), r["batch_id"]
        self.moments.update((*state, last))
        yield Row(label=key[0], feature=key[1], n=state[0], mean=state[1], m2=state[2])

    def close(self) -> None:
        pass


def merge_new_batches(spark: SparkSession, parts: str, state: str, partitions: int = 8) -> None:
    """Merge the batches of the folder ``parts`` (columns MOMENTS) that the state kept at
    ``state`` does not hold yet.

    There is one row a label, feature and batch, so a few partitions serve; their number stays
    as the first run set it."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        spark.conf.set(SETTINGS[0], str(partitions))
        spark.conf.set(SETTINGS[1], STORE)
        new = (spark.readStream.schema(MOMENTS).parquet(parts).groupBy("label", "feature")
               .transformWithState(statefulProcessor=MomentsProcessor(), outputStructType=MERGED,
                                   outputMode="Update", timeMode="None"))
        q = (new.writeStream.format("noop").outputMode("update").option("checkpointLocation", state)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def read_moments(spark: SparkSession, state: str) -> DataFrame:
    """(label, feature, n, mean, m2) as the state at ``state`` holds them."""
    if not exists(spark, f"{state}/state"):
        return spark.createDataFrame([], MERGED)
    rows = spark.read.format("statestore").option("path", state).option("stateVarName", "moments").load()
    return rows.select("key.label", "key.feature", "value.n", "value.mean", "value.m2")


def stream_nb_state(spark: SparkSession, folder: str, features, batch_files: int = 3, label_col: str = "label",
                    sink: str | None = None, count: bool = False) -> DataFrame:
    """(label, feature, n, mean, m2) over all files that have arrived in ``folder``.

    With the same ``sink`` a later call reads only files that are new and merges only their
    moments.  n counts values that are there; a feature without any in a class has no row, an
    empty folder gives none.  With ``count`` the feature ``_rows`` counts the rows of a class."""
    sink = (sink or scratch_dir(spark, "stream-nb-state")).rstrip("/")
    state = f"{checkpoint_root(spark)}/netsieve/streams/{hashlib.sha256(sink.encode()).hexdigest()[:24]}-state"
    features = list(features) + [ROWS] * count

    def handle(df: DataFrame, batch_id: int) -> DataFrame:
        return batch_moments(df.withColumn(ROWS, F.lit(0.0)) if count else df, features, label_col)

    run_batches(spark, folder, handle, sink, batch_files=batch_files)
    if exists(spark, sink):
        merge_new_batches(spark, sink, state)
    return read_moments(spark, state)


def nb_model(moments: DataFrame, features, var_smoothing: float = 1e-9) -> GaussianNBModel:
    """The Gaussian-NB model of the moments that ``stream_nb_state(..., count=True)`` returns:
    priors by rows, and per class the mean and variance of the values that are there, plus
    ``var_smoothing`` times the largest variance of a feature over all classes.  The moments
    (classes x features) are the model and go to the driver.  A class that lacks a feature, or
    a state without rows, is a ValueError."""
    got = {(r["label"], r["feature"]): r for r in moments.collect()}
    classes = sorted(label for label, feature in got if feature == ROWS)
    lacking = [(c, f) for c in classes for f in features if (c, f) not in got]
    if lacking or not classes:
        raise ValueError(f"no values of (class, feature) {lacking[:5]}" if classes else "no rows yet")
    n, mean, m2 = (np.array([[got[c, f][v] for f in features] for c in classes], float) for v in ("n", "mean", "m2"))
    rows = np.array([got[c, ROWS]["n"] for c in classes], float)
    centre = (n * mean).sum(axis=0) / n.sum(axis=0)
    overall = (m2 + n * (mean - centre) ** 2).sum(axis=0) / n.sum(axis=0)
    smoothing = var_smoothing * float(overall.max(initial=0.0))
    return GaussianNBModel(list(features), list(features), classes, mean, m2 / n + smoothing, rows / rows.sum())
