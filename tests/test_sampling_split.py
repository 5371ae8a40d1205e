"""Sizes equal the formulas; parts are disjoint and cover; results ignore partitioning."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from netsieve import fixtures
from netsieve.functions import label_normalize
from netsieve.operators import sampling, split


def nflows(spark):
    return fixtures.flows(spark, SF01).withColumn("label", label_normalize("label"))


def test_time_split_sizes(spark):
    parts = split.split_time(nflows(spark), "ts")
    c = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    assert c == {"train": 7225, "val": 1275, "test": 1500}
    assert parts.select("uid").distinct().count() == 10000
    # train strictly precedes val, val precedes test (time order)
    mx = {r["split"]: (r["lo"], r["hi"]) for r in
          parts.groupBy("split").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect()}
    assert mx["train"][1] <= mx["val"][0] and mx["val"][1] <= mx["test"][0]


def test_stratified_split(spark):
    df = nflows(spark)
    parts = split.split_stratified(df, "label")
    c = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    assert c["test"] == math.ceil(0.15 * 10000)
    assert sum(c.values()) == 10000 and parts.select("uid").distinct().count() == 10000
    a = {(r["label"], r["split"]): r["count"] for r in parts.groupBy("label", "split").count().collect()}
    b = {(r["label"], r["split"]): r["count"] for r in
         split.split_stratified(df.repartition(17), "label").groupBy("label", "split").count().collect()}
    assert a == b
    for lab in ("benign", "malicious"):
        tot = sum(v for (l, _), v in a.items() if l == lab)
        assert abs(a[(lab, "test")] / tot - 0.15) < 0.01


def test_samplers(spark):
    df = nflows(spark)
    assert sampling.sample_exact_n(df, 777).count() == 777
    s1 = {r["uid"] for r in sampling.sample_stratified_cap(df, 1000).collect()}
    s2 = {r["uid"] for r in sampling.sample_stratified_cap(df.repartition(1), 1000).collect()}
    assert len(s1) == 1000 and s1 == s2
    bal = sampling.sample_balanced(df)
    per = {(r["source_file"], r["label"]): r["count"] for r in bal.groupBy("source_file", "label").count().collect()}
    q = 1000 // 4 + 1                                    # smallest class 1,000 rows, 4 files
    assert all(v <= q for v in per.values()) and max(per.values()) == q
    assert sampling.sample_fraction(df, 0.25).count() == 2500


def test_quota_rule():
    assert split.approximate_mode({"a": 5, "b": 5}, 5) == {"a": 3, "b": 2}       # tie: by name
    assert sampling.balanced_quota({"a": 10, "b": 40}, 3, max_rows_total=8) == 2


def test_ids_that_repeat_raise_or_count_exactly(spark):
    from netsieve.operators.sampling import sample_balanced, sample_exact_n
    from netsieve.operators.split import split_time
    df = spark.range(1000).select((F.col("id") % 10).cast("string").alias("uid"), F.col("id"), (F.col("id") % 2).alias("label"),
                                  F.lit("f").alias("source_file"), F.lit(1.0).alias("ts"))
    with pytest.raises(ValueError, match="share the id"):
        sample_exact_n(df, 250).count()
    assert sample_exact_n(df, 300).count() == 300                     # whole ids: no row shares the edge
    with pytest.raises(ValueError, match="share the id"):
        sample_exact_n(df.withColumn("uid", F.lit(None).cast("string")), 25).count()
    with pytest.raises(ValueError, match="share the id"):
        sample_balanced(df, max_rows_total=150).count()
    with pytest.raises(ValueError, match="share the id"):
        split_time(df.withColumn("uid", F.lit("x")), "ts", tiebreak="uid").count()
    with pytest.raises(ValueError, match="share the id"):
        split_time(df.withColumn("ts", F.lit(None).cast("double")).withColumn("uid", F.lit("x")), "ts", tiebreak="uid").count()
    assert sample_exact_n(df, 250, uid=["uid", "id"]).count() == 250
    assert sample_balanced(df, max_rows_total=150, uid=["uid", "id"]).count() == 2 * 76
