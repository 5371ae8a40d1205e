"""Threshold keys: positions against plain sorting, and plans that move no wide column."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from netsieve.operators import rank, sampling, split, threshold, tuning


def frame(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = [(f"u{i}", rng.choice([None, 1.0, 1.0, 2.5, float(rng.randrange(50))]), rng.choice("aaaaabc"), f"f{i % 3}", "wide" * 5) for i in range(n)]
    return spark.createDataFrame(rows, "uid string, ts double, label string, source_file string, wide string").repartition(7)


def h(u, seed=42):
    return (hashlib.md5(f"{u}|{seed}".encode()).hexdigest(), u)


@pytest.mark.parametrize("digits_rows", [4096, 5])
def test_hash_cuts_match_sorting(spark, monkeypatch, digits_rows):
    monkeypatch.setattr(threshold, "PREFIX_ROWS", digits_rows)
    df = frame(spark)
    rows = df.collect()
    quotas = {"a": [0, 10, 150], "b": [5, 5, 10_000], "c": [1, 2, 3]}
    out = threshold.hash_cuts(df, ["label"], sampling.class_quotas(df, "label", quotas), len(rows))
    got = {r["uid"]: r["_cut"] for r in out.collect()}
    for lab, q in quotas.items():
        order = sorted((r["uid"] for r in rows if r["label"] == lab), key=h)
        for pos, u in enumerate(order, 1):
            assert got[u] == sum(pos > k for k in q)
    assert out.columns == [*df.columns, "_cut"]


@pytest.mark.parametrize("bracket", [threshold.BRACKET, 0.0])
def test_time_split_with_ties_and_nulls(spark, monkeypatch, bracket):
    monkeypatch.setattr(threshold, "BRACKET", bracket)
    df = frame(spark)
    order = sorted(df.collect(), key=lambda r: (r["ts"] is None, r["ts"] or 0.0, r["uid"]))
    v, t = split.time_split_sizes(len(order))
    got = {r["uid"]: r["split"] for r in split.split_time(df, "ts").collect()}
    for i, r in enumerate(order, 1):
        assert got[r["uid"]] == ("train" if i <= v else "val" if i <= t else "test")
    allnull = df.withColumn("ts", F.lit(None).cast("double"))
    assert split.split_time(allnull, "ts").where("split = 'train'").count() == v
    assert split.split_time(df.where("false"), "ts").count() == 0


def test_folds_differ_by_one_row(spark):
    df = frame(spark)
    per = tuning.stratified_folds(df, "label", 5).groupBy("label", "fold").count().collect()
    by = {}
    for r in per:
        by.setdefault(r["label"], {})[r["fold"]] = r["count"]
    assert all(set(x) == set(range(5)) and max(x.values()) - min(x.values()) <= 1 for x in by.values())


def test_samplers_without_labels_and_global_policy(spark):
    df = frame(spark)
    none = df.withColumn("label", F.lit(None).cast("string"))
    assert sampling.sample_balanced(none).count() == df.count()
    m = min(r["count"] for r in df.groupBy("label").count().collect())
    got = {r["label"]: r["count"] for r in sampling.sample_balanced(df, policy="global").groupBy("label").count().collect()}
    assert got == {"a": m, "b": m, "c": m}
    with pytest.raises(ValueError):
        sampling.sample_balanced(df, policy="other")


def test_several_id_columns(spark):
    df = spark.createDataFrame([(f"f{i % 2}", i // 2, "x") for i in range(100)] + [(None, 0, "x")], "file string, row long, label string")
    assert sampling.sample_exact_n(df, 30, uid=["file", "row"]).count() == 30


def test_no_wide_column_is_moved(spark):
    rank.release()
    df = frame(spark)
    for out in (split.split_time(df, "ts"), split.split_stratified(df, "label"), sampling.sample_stratified_cap(df, 100),
                sampling.sample_exact_n(df, 50), sampling.sample_balanced(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        for line in plan.splitlines():
            if "Exchange" in line and "Broadcast" not in line:
                assert "REPARTITION" in line, line          # the test's own repartition(7)
        assert "InMemoryTableScan" not in plan
        assert "wide" in out.columns
    for kept in rank._PERSISTED:
        assert "wide" not in kept.columns
