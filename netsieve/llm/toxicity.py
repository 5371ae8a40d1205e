"""Operator 5, toxicity by a classifier chain.

Categories are predicted one after the other; the linear model of each also gets the
probabilities of the earlier ones.  In training those are out-of-fold predictions, so a later
model learns from errors like those it will meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pieces, prepare
from .linear import best_threshold, bounded_sample, fit_logistic, logit, packed, select_features, sigmoid, take, unpacked, weighted

MAX_LABELLED = 8000              # bound of the training sample
FOLDS = 4


class Chain:
    """Feature lookup, and per category its linear model and threshold."""

    def __init__(self, names: list, lookup: np.ndarray, models: list, cuts: list):
        self.names, self.lookup, self.models, self.cuts = names, lookup, models, cuts

    def probabilities(self, arr: pa.Array) -> np.ndarray:
        """Texts x categories."""
        n = len(arr)
        x = weighted(arr, self.lookup)
        out = np.zeros((n, len(self.models)))
        for c, m in enumerate(self.models):
            out[:, c] = sigmoid(m.margin(x, logit(out[:, :c])))
        return out


def fit_chain(docs: DataFrame, labels: DataFrame, categories: list, at_most: int = MAX_LABELLED) -> Chain:
    """Learn a chain over the 0/1 columns ``categories`` of ``labels``, in their order.

    The sample is about ``at_most`` labelled documents by a hash of doc_id, one an id (of
    several labels the largest, of several texts the smallest); rows of labels with a null in
    a category teach nothing, a label without a document neither.  The features are those that tell
    any category best, each by its own ranking.  Without
    labels every probability is the prior 1/2 and nothing is flagged."""
    spark = docs.sparkSession
    # one row an id on both sides, so the bound holds however often an id repeats
    lab = (labels.where(" and ".join(f"`{c}` is not null" for c in ["doc_id", *categories])).groupBy("doc_id")
           .agg(*[F.max(F.col(c).cast("int")).alias(f"y{i}") for i, c in enumerate(categories)]))
    lab = bounded_sample(lab, at_most, "toxicity").withColumnRenamed("doc_id", "l_id")
    # at most about ``at_most`` rows of a few numbers
    sample = (docs.select("doc_id", "text").join(F.broadcast(lab), F.col("doc_id") == F.col("l_id"))
              .groupBy("doc_id", *[f"y{i}" for i in range(len(categories))]).agg(F.min("text").alias("text")))
    ys = [f"y{i}" for i in range(len(categories))]
    lookup = select_features(sample, ys)
    shared = spark.sparkContext.broadcast(lookup)

    def extract(batches):
        for b in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([*packed(weighted(b.column(0), shared.value), b.num_rows), *b.columns[1:]],
                                             names=["x", "v", "fold", *ys])

    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS))
    got = (sample.select(F.coalesce("text", F.lit("")).alias("text"), fold.alias("fold"), *ys)
           .mapInArrow(extract, "x binary, v binary, fold long, " + ", ".join(f"{y} int" for y in ys)).toArrow())
    n = got.num_rows
    x = unpacked(got["x"].to_pylist(), got["v"].to_pylist())
    width = max(1, int(lookup.max()) + 1)
    folds = np.asarray(got["fold"])
    models, cuts, earlier = [], [], np.zeros((n, 0))
    for y_name in ys:
        y = np.asarray(got[y_name]).astype(float)
        out = np.zeros(n)
        for f in range(FOLDS):
            inside, outside = folds == f, folds != f
            m = fit_logistic(take(x, outside), width, earlier[outside], y[outside])
            out[inside] = sigmoid(m.margin(take(x, inside), earlier[inside]))
        models.append(fit_logistic(x, width, earlier, y))
        cuts.append(best_threshold(out, y) if n and 0 < y.sum() < n else 1.1)
        earlier = np.column_stack([earlier, logit(out)])
    return Chain(categories, lookup, models, cuts)


def categories_of(labels: DataFrame) -> DataFrame:
    """Toxicity categories of the labels table: ``toxic``, and ``toxic_junk`` where the text
    is of low quality as well."""
    toxic = F.col("toxic") > 0
    return labels.select("doc_id", toxic.cast("int").alias("toxic"),
                         F.when(~toxic, 0).otherwise((F.col("quality") == 0).cast("int")).alias("toxic_junk"))


def toxicity(docs: DataFrame, labels: DataFrame, categories: list, at_most: int = MAX_LABELLED) -> DataFrame:
    """``doc_id``, ``p_<category>`` and the flag ``<category>`` of every whole text.

    A flag is set at the probability cut with the best out-of-fold F1.  Null texts are empty;
    repeated rows are each scored; other columns are not read; an empty table gives an empty
    result."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit_chain(docs, labels, categories, at_most))

    def run(batches):
        chain = shared.value
        for b in pieces(batches, "text"):
            p = chain.probabilities(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(p[:, c]) for c in range(len(categories))],
                                              *[pa.array(p[:, c] >= chain.cuts[c]) for c in range(len(categories))]],
                                             names=["doc_id", *[f"p_{c}" for c in categories], *categories])

    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"`p_{c}` double" for c in categories) + ", "
                          + ", ".join(f"`{c}` boolean" for c in categories))
