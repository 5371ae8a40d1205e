"""Operators 5 and 9: held-out accuracy, the chain's feeding, calibration, edge cases."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SF01, awkward, docs, word_text
from netsieve.llm import linear, quality, queries, toxicity
from netsieve.llm.common import load

HELD = "pmod(xxhash64(doc_id, 'held out'), 4) = 0"
SF1 = "/root/testdata/sf0.1"


def test_toxic_held_out(spark):
    d, lab = load(spark, SF1, "documents"), load(spark, SF1, "labels")
    out = toxicity.toxicity(d, toxicity.categories_of(lab.where(f"not {HELD}")), ["toxic", "toxic_junk"])
    got = {(r["y"], r["toxic"]): r["count"] for r in out.join(lab.where(HELD).selectExpr("doc_id", "toxic y"), "doc_id")
           .groupBy("y", "toxic").count().collect()}
    hit, missed, false = got.get((1, True), 0), got.get((1, False), 0), got.get((0, True), 0)
    assert hit / (hit + missed) > 0.9 and false <= 0.02 * sum(got.values())


def test_quality_held_out(spark):
    d, lab = load(spark, SF1, "documents"), load(spark, SF1, "labels")
    out = quality.quality(d, lab.where(f"not {HELD}")).join(lab.where(HELD).select("doc_id", "quality"), "doc_id")
    got = {(r["quality"], r["good"]): r["count"] for r in out.groupBy("quality", "good").count().collect()}
    assert got[0, False] / (got[0, False] + got.get((0, True), 0)) > 0.85
    assert got.get((1, False), 0) <= 0.03 * (got[1, True] + got.get((1, False), 0))
    # calibrated: the mean score is near the share of good documents
    m = out.agg(F.avg("score"), F.avg("quality")).first()
    assert m[0] == pytest.approx(m[1], abs=0.05)


def test_queries_cover_the_table(spark):
    n = load(spark, SF01, "documents").count()
    for key in ("op5_toxicity", "op9_quality"):
        out = queries.QUERIES[key](spark, SF01)
        assert out.count() == n == out.select("doc_id").distinct().count()
        for c, t in out.dtypes:
            if t == "double":
                assert out.where(~F.col(c).between(0, 1) | F.col(c).isNull()).count() == 0


def test_later_categories_use_earlier_ones(spark):
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(400):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        texts.append(word_text(rng, 20) + (" alpha" if a else "") + (" beta" if b else ""))
        labels.append((i, int(a), int(a and b), int(not a)))
    lab = spark.createDataFrame(labels, "doc_id long, first int, second int, third int")
    chain = toxicity.fit_chain(docs(spark, texts), lab, ["first", "second", "third"])
    assert [len(m.v) for m in chain.models] == [0, 1, 2]
    assert chain.models[1].v[0] > 0.05 and chain.models[2].v[0] < -0.05
    out = toxicity.toxicity(docs(spark, texts), lab, ["first", "second", "third"]).join(lab.toDF("doc_id", "a", "b", "c"), "doc_id")
    assert out.where("first = (a = 1) and second = (b = 1) and third = (c = 1)").count() >= 390


def test_features_tell_every_category(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        a, b = rng.random() < 0.5, rng.random() < 0.1
        rows.append((("beta " if b else "") + word_text(rng, 20) + (" alpha" if a else ""), int(a), int(b)))
    sample = spark.createDataFrame(rows, "text string, y0 int, y1 int")
    has = lambda word, lookup: len(linear.weighted(pa.array([word]), lookup)[0]) > 0
    one, both = linear.select_features(sample, ["y0"], 1), linear.select_features(sample, ["y0", "y1"], 2)
    assert has("alpha", one) and not has("beta", one)
    assert has("alpha", both) and has("beta", both)
    assert (linear.select_features(sample, ["y0", "y0"], 50) == linear.select_features(sample, ["y0"], 50)).all()
    assert (linear.select_features(sample.where("false"), ["y0", "y1"]) == -1).all()


def test_co_training_learns_from_the_other_view(spark, monkeypatch):
    """Metadata of the labelled documents tells nothing; that of the others follows their class, and
    only the text view's labels can teach it."""
    rng = random.Random(0)
    rows, labels = [], []
    for i in range(1200):
        good = rng.random() < 0.5
        words = [rng.choice([f"good{k}" if good else f"poor{k}" for k in range(10)]) for _ in range(6)]
        known = i < 80
        rows.append((i, " ".join(words), "same" if known else ("wiki" if good else "spam"), "en"))
        if known:
            labels.append((i, int(good)))
    truth = {r[0]: "good" in r[1] for r in rows}
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int")

    def errors(rounds):
        monkeypatch.setattr(quality, "ROUNDS", rounds)
        views = quality.fit_views(d, lab)                 # before calibration, which the labelled rows could not give
        rest = rows[80:]
        x = quality.metadata([r[2] for r in rest], [r[3] for r in rest], pa.array([r[1] for r in rest]))
        p = linear.sigmoid(views.meta.margin(x, np.zeros((len(rest), 0))))
        return sum((q > 0.5) != truth[r[0]] for q, r in zip(p, rest))
    assert errors(0) > 0.3 * 1120 and errors(3) < 0.02 * 1120


def test_every_unlabelled_document_counts_in_the_thresholds(spark, monkeypatch):
    """What is scored in a round is the whole table without the labelled sample, whatever its size."""
    seen = []
    keep = quality.stored

    def watch(df, tag):
        out = keep(df, tag)
        if tag == "quality-scores":
            seen.append(out.count())
        return out
    monkeypatch.setattr(quality, "stored", watch)
    d, lab = load(spark, SF1, "documents"), load(spark, SF1, "labels").where("quality is not null")
    quality.fit_views(d, lab, handed=200)
    free = d.join(lab.select("doc_id").distinct(), "doc_id", "left_anti").count()
    assert len(seen) == quality.ROUNDS and all(n == free for n in seen)


def test_logistic_and_threshold():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 500).astype(float)
    x = (np.arange(500), y.astype(np.int64), np.ones(500))
    m = linear.fit_logistic(x, 2, np.zeros((500, 0)), y)
    p = linear.sigmoid(m.margin(x, np.zeros((500, 0))))
    assert ((p > 0.5) == (y == 1)).all()
    assert ((p >= linear.best_threshold(p, y)) == (y == 1)).all()
    assert linear.best_threshold(np.zeros(0), np.zeros(0)) == 0.5


def test_edges(spark):
    d = docs(spark, awkward())
    lab = spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(6)] + [(None, 1, 1), (3, None, 1), (3, 1, None), (999, 0, 0), (2, 1, 1)],
                                "doc_id long, quality int, toxic int")
    none = lab.where("false")
    for labels in (lab, none):
        a = toxicity.toxicity(d, toxicity.categories_of(labels), ["toxic", "toxic_junk"])
        b = quality.quality(d, labels)
        assert a.count() == b.count() == len(awkward())
        assert toxicity.toxicity(d.where("false"), toxicity.categories_of(labels), ["toxic"]).count() == 0
        assert quality.quality(d.where("false"), labels).count() == 0
    assert not any(r["toxic"] for r in toxicity.toxicity(d, toxicity.categories_of(none), ["toxic"]).collect())
