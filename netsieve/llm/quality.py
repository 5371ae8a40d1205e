"""Operator 9, quality by co-training of two views.

A text-content classifier (words and symbol runs) and a page-metadata classifier (source,
language, size and layout figures) start from the labelled documents.  In each round both score
every unlabelled document; of each class, a view hands the other the documents that it is surest
of: those above a threshold that comes from a quantile sketch of its scores over all of them.
The other view is fitted again with a bounded sample of what it was handed.  The views are
calibrated on out-of-fold predictions and combined to score all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import _U, code_points, mix, pieces, prepare, stored, text_bytes, word_hashes
from .linear import best_threshold, bounded_sample, fit_logistic, packed, select_features, sigmoid, unpacked, weighted

MAX_LABELLED = 6000              # bound of the sample of labelled documents
MAX_HANDED = 1500                # bound of the sample of pseudo-labelled documents a view and class is fitted with
ROUNDS = 3
HANDED = 0.05                    # share of the unlabelled documents each view hands over, per class, times the round
SKETCH = 10_000                  # accuracy of the quantiles: within 1 / SKETCH of the share asked for
CONFIDENT = 0.9
FOLDS = 4
META_SLOTS = 1024                # hashed source and language
_N_LAYOUT = 9
_BINS = 12


def _layout(arr: pa.Array) -> np.ndarray:
    """Layout figures per text, in bins: size, lines, symbols, digits, capitals, spaces,
    long lines, bars, other scripts."""
    buf, off = text_bytes(arr)
    n = code_points(buf, off).astype(float)

    def share(mask):
        c = np.concatenate([[0], np.cumsum(mask)])
        return c[off[1:]] - c[off[:-1]]

    digit = share((buf >= 0x30) & (buf <= 0x39))
    upper = share((buf >= 0x41) & (buf <= 0x5A))
    lower = share((buf >= 0x61) & (buf <= 0x7A))
    space = share(buf == 0x20)
    lines = share(buf == 0x0A)
    symbol = share((buf > 0x20) & (buf < 0x7F)) - digit - upper - lower
    size = np.maximum(n, 1)
    figures = [np.log2(size), np.log2(lines + 1) * 2] + [np.log2(x / size * 1000 + 1) * 1.2 for x in (symbol, digit, upper, space)]
    figures += [np.log2(n / (lines + 1) + 1), np.log2(share(buf == 0x7C) / size * 1000 + 1) * 1.2, np.log2(share(buf >= 0x80) / size * 1000 + 1)]
    return np.stack([np.clip(f, 0, _BINS - 1).astype(np.int64) for f in figures], axis=1)


def metadata(source: list, lang: list, arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, feature, 1) of the page-metadata view."""
    n = len(arr)
    cols = []
    for i, values in enumerate((source, lang)):
        a = pa.array(["\x00" if v is None else str(v) for v in values], pa.large_string())
        buf, off = text_bytes(a)
        h = mix(word_hashes(buf, off[:-1], off[1:]) + _U(i + 1))
        cols.append((h % _U(META_SLOTS)).astype(np.int64))
    lay = _layout(arr)
    for i in range(_N_LAYOUT):
        cols.append(META_SLOTS + i * _BINS + lay[:, i])
    key = np.unique(np.repeat(np.arange(n), len(cols)) * 4096 + np.stack(cols, axis=1).reshape(-1))
    return key // 4096, key % 4096, np.ones(len(key), np.float32)


META_WIDTH = META_SLOTS + _N_LAYOUT * _BINS


class Views:
    """Feature lookup, the two models, their calibrations (slope, constant) and the cut."""

    def __init__(self, lookup, text, meta, cal_text, cal_meta, cut):
        self.lookup, self.text, self.meta = lookup, text, meta
        self.cal_text, self.cal_meta, self.cut = cal_text, cal_meta, cut

    def scores(self, arr, source, lang):
        """(text view, metadata view, combined) probabilities of good quality."""
        n = len(arr)
        none = np.zeros((n, 0))
        a = self.text.margin(weighted(arr, self.lookup), none) * self.cal_text[0] + self.cal_text[1]
        b = self.meta.margin(metadata(source, lang, arr), none) * self.cal_meta[0] + self.cal_meta[1]
        return sigmoid(a), sigmoid(b), sigmoid((a + b) / 2)


def _calibrate(margin, y):
    """Platt scaling: slope and constant of a one-column logistic model."""
    if not len(y) or y.min() == y.max():
        return 1.0, 0.0
    none = np.zeros(0, np.int64)
    m = fit_logistic((none, none, np.zeros(0)), 1, margin[:, None], y, l2=0.1)
    return float(m.v[0]), m.b


def _fit(x, width, y):
    return fit_logistic(x, width, np.zeros((len(y), 0)), y)


class _Rows:
    """Features of both views of a bounded sample, and what each row is: its label, fold, and, per
    view, the class that the other view handed it over with (-1: not)."""

    def __init__(self, got: pa.Table):
        self.raw = [[got[c].to_pylist() for c in view] for view in (("a", "av"), ("b", "bv"))]
        self.y, self.fold = np.asarray(got["y"]).astype(float), np.asarray(got["fold"])
        self.handed = [np.asarray(got[c]) for c in ("to_text", "to_meta")] if "to_text" in got.column_names else []

    def pairs(self, view, rows):
        values = self.raw[view]
        return unpacked([values[0][i] for i in rows], [values[1][i] for i in rows])


def _joined(one, n, two):
    """Features (row, feature, value) of ``n`` rows and then of others."""
    return tuple(np.concatenate([np.asarray(x), np.asarray(y) + (n if i == 0 else 0)]) for i, (x, y) in enumerate(zip(one, two)))


def _models(lab: _Rows, rows, handed: _Rows | None, widths):
    """Both views' models of the labelled ``rows`` and the rows handed over."""
    out = []
    for v in (0, 1):
        x, y = lab.pairs(v, rows), lab.y[rows]
        if handed is not None:
            extra = np.flatnonzero(handed.handed[v] >= 0)
            x, y = _joined(x, len(rows), handed.pairs(v, extra)), np.concatenate([y, handed.handed[v][extra]])
        out.append(_fit(x, widths[v], y))
    return out


def fit_views(docs: DataFrame, labels: DataFrame, labelled: int = MAX_LABELLED, handed: int = MAX_HANDED) -> Views:
    """Co-train on about ``labelled`` documents with a non-null quality (1 good, 0 not), by a hash of
    doc_id, one an id, and all others without a label.

    Every unlabelled document is scored in each of ROUNDS rounds and counts in the thresholds; of
    those above one, about ``handed`` by a hash of the row are fitted with."""
    spark = docs.sparkSession
    # labels are taken by doc_id: of several, one
    lab = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    lab = bounded_sample(lab, labelled, "quality").select(F.col("doc_id").alias("l_id"), (F.col("quality") > 0).cast("int").alias("y"))
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("source").cast("string").alias("source"),
                       F.col("lang").cast("string").alias("lang"))
    # one row an id, so the bound holds however often an id repeats
    sample = (base.join(F.broadcast(lab), F.col("doc_id") == F.col("l_id")).groupBy("doc_id", "y")
              .agg(F.min(F.struct("text", "source", "lang")).alias("d"))
              .select("d.*", "y", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).alias("fold")))
    lookup = select_features(sample)
    shared = spark.sparkContext.broadcast(lookup)
    widths = [max(1, int(lookup.max()) + 1), META_WIDTH]

    def extract(batches):
        for b in pieces(batches, "text"):
            text = weighted(b.column(0), shared.value)
            meta = metadata(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(0))
            yield pa.RecordBatch.from_arrays([*packed(text, b.num_rows), *packed(meta, b.num_rows), *b.columns[3:]],
                                             names=["a", "av", "b", "bv", *b.schema.names[3:]])

    features = "a binary, av binary, b binary, bv binary"
    train = _Rows(sample.mapInArrow(extract, f"{features}, y int, fold long").toArrow())
    every = np.arange(len(train.y))
    free = base.join(F.broadcast(lab.select("l_id")), F.col("doc_id") == F.col("l_id"), "left_anti")
    key = F.xxhash64("doc_id", "source", "lang", "text")
    pseudo = None
    models = _models(train, every, None, widths)
    one_class = not len(every) or train.y.min() == train.y.max()
    for r in range(0 if one_class else ROUNDS):
        now = spark.sparkContext.broadcast(models)

        def score(batches, now=now):
            text, meta = now.value
            for b in pieces(batches, "text"):
                none = np.zeros((b.num_rows, 0))
                p = [sigmoid(text.margin(weighted(b.column(0), shared.value), none)),
                     sigmoid(meta.margin(metadata(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(0)), none))]
                yield pa.RecordBatch.from_arrays([b.column(3), *[pa.array(x.astype(np.float32)) for x in p]], names=["k", "p0", "p1"])

        scored = stored(free.select("text", "source", "lang", key.alias("k")).mapInArrow(score, "k long, p0 float, p1 float"), "quality-scores")
        share = min(0.5, HANDED * (r + 1))
        cuts = scored.agg(*[F.percentile_approx(f"p{v}", [share, 1 - share], SKETCH).alias(f"q{v}") for v in (0, 1)], F.count(F.lit(1)).alias("n")).first()
        if not cuts["n"]:
            break
        # what view v is sure of goes to the other view
        sure = [F.when(F.col(f"p{v}") >= F.lit(float(max(CONFIDENT, cuts[f"q{v}"][1]))), 1)
                .when(F.col(f"p{v}") <= F.lit(float(min(1 - CONFIDENT, cuts[f"q{v}"][0]))), 0).otherwise(-1) for v in (0, 1)]
        given = scored.select("k", sure[1].alias("to_text"), sure[0].alias("to_meta"))
        counts = given.agg(*[F.count_if(F.col(c) == cls).alias(f"{c}{cls}") for c in ("to_text", "to_meta") for cls in (0, 1)]).first()
        place = F.pmod(F.xxhash64("k", F.lit(f"handed {r}")), F.lit(1 << 30)) / F.lit(float(1 << 30))
        for c in ("to_text", "to_meta"):
            rate = F.when(F.col(c) == 1, F.lit(handed / max(1, counts[f"{c}1"]))).otherwise(F.lit(handed / max(1, counts[f"{c}0"])))
            given = given.withColumn(c, F.when((F.col(c) >= 0) & (place < rate), F.col(c)).otherwise(-1))
        # one row a key: rows that repeat are one here
        given = given.where("to_text >= 0 or to_meta >= 0").dropDuplicates(["k"])
        picked = (free.withColumn("k", key).join(F.broadcast(given.withColumnRenamed("k", "g")), F.col("k") == F.col("g"))
                  .groupBy("k", "to_text", "to_meta").agg(F.min(F.struct("text", "source", "lang")).alias("d"))
                  .select("d.*", F.lit(-1).alias("y"), F.lit(0).cast("long").alias("fold"), "to_text", "to_meta"))
        pseudo = _Rows(picked.mapInArrow(extract, f"{features}, y int, fold long, to_text int, to_meta int").toArrow())
        models = _models(train, every, pseudo, widths)
    out = np.zeros((2, len(every)))
    for f in range(FOLDS):                                               # out-of-fold margins
        test = np.flatnonzero(train.fold == f)
        part = _models(train, np.flatnonzero(train.fold != f), pseudo, widths)
        for v in (0, 1):
            out[v, test] = part[v].margin(train.pairs(v, test), np.zeros((len(test), 0)))
    cal = [_calibrate(out[v], train.y) for v in (0, 1)]
    both = sigmoid(sum(out[v] * cal[v][0] + cal[v][1] for v in (0, 1)) / 2)
    cut = 0.5 if one_class else 1 - best_threshold(1 - both, 1 - train.y)
    return Views(lookup, models[0], models[1], cal[0], cal[1], cut)


def quality(docs: DataFrame, labels: DataFrame, labelled: int = MAX_LABELLED, handed: int = MAX_HANDED) -> DataFrame:
    """``doc_id, p_text, p_meta, score, good`` of every whole text: the calibrated views, their
    combination, and whether the score reaches the cut with the best out-of-fold F1 for
    finding poor documents.

    Null texts are empty, null metadata is a value of its own; repeated rows are each scored;
    without usable labels every score is near 1/2; an empty table gives an empty result; other
    columns are not read."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit_views(docs, labels, labelled, handed))

    def run(batches):
        views = shared.value
        for b in pieces(batches, "text"):
            t, m, s = views.scores(b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(t), pa.array(m), pa.array(s), pa.array(s >= views.cut)],
                                             names=["doc_id", "p_text", "p_meta", "score", "good"])

    src = docs.select("doc_id", "text", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, p_text double, p_meta double, score double, good boolean")
