"""Naive-Bayes statistics in the state store: merging, restarts, the model read from the state."""

import os

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from netsieve.operators.models import GaussianNB
from netsieve.session import scratch_dir
from netsieve.streaming import nb_model, stream_nb_state
from netsieve.streaming import state as S


def write(d, name, rows):
    with open(os.path.join(d, name), "w") as f:
        f.write("uid,label,a,b\n" + "".join(f"{name}{i},{y},{'' if a is None else a},{b}\n" for i, (y, a, b) in enumerate(rows)))


def moments(values):
    v = np.array(values, float)
    return (len(v), v.mean(), ((v - v.mean()) ** 2).sum()) if len(v) else (0, 0.0, 0.0)


def expected(rows):
    out = {}
    for i, f in ((1, "a"), (2, "b")):
        for y in {r[0] for r in rows}:
            v = [r[i] for r in rows if r[0] == y and r[i] is not None]
            if v:
                out[y, f] = moments(v)
    return out


def check(got, rows):
    got = {(r["label"], r["feature"]): (r["n"], r["mean"], r["m2"]) for r in got.collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-9)


@given(st.lists(st.integers(-1000, 1000), max_size=8), st.lists(st.integers(-1000, 1000), max_size=8))
@settings(max_examples=100, deadline=None)
def test_two_sets_merge(x, y):
    assert S.merged(moments(x), moments(y)) == pytest.approx(moments(x + y), rel=1e-9, abs=1e-6)


def some_rows(seed, n=40):
    rng = np.random.default_rng(seed)
    return [("ddos" if rng.random() < 0.4 else "benign", None if rng.random() < 0.2 else int(rng.integers(0, 100)),
             int(rng.integers(-9, 9))) for _ in range(n)]


def test_state_goes_on_where_it_stopped(spark, tmpdir_path, monkeypatch):
    sink = scratch_dir(spark, "state-test")
    assert stream_nb_state(spark, tmpdir_path, ["a", "b"], sink=sink).count() == 0
    rows = []
    for i in range(3):
        rows += (r := some_rows(i))
        write(tmpdir_path, f"f{i}.csv", r)
    check(stream_nb_state(spark, tmpdir_path, ["a", "b"], batch_files=2, sink=sink), rows)
    check(stream_nb_state(spark, tmpdir_path, ["a", "b"], batch_files=2, sink=sink), rows)     # nothing new

    # the run stops after the batches are written, before they reach the state
    rows += (r := some_rows(7) + [("mirai", 5, 6)])
    write(tmpdir_path, "f8.csv", r)
    with monkeypatch.context() as m:
        m.setattr(S, "merge_new_batches", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            stream_nb_state(spark, tmpdir_path, ["a", "b"], batch_files=2, sink=sink)
    rows += (r := some_rows(9))
    write(tmpdir_path, "f9.csv", r)
    check(stream_nb_state(spark, tmpdir_path, ["a", "b"], batch_files=1, sink=sink), rows)


def test_a_batch_read_again_adds_nothing(spark):
    parts, state = scratch_dir(spark, "parts"), scratch_dir(spark, "state")
    df = spark.createDataFrame([("x", "a", 2, 3.0, 1.0), ("x", "b", 1, 1.0, 0.0)], S.MERGED)
    for _ in range(2):
        df.withColumn("batch_id", F.lit(0)).write.mode("append").partitionBy("batch_id").parquet(parts)
        S.merge_new_batches(spark, parts, state)
    assert {(r["feature"], r["n"], r["mean"], r["m2"]) for r in S.read_moments(spark, state).collect()} == {
        ("a", 2, 3.0, 1.0), ("b", 1, 1.0, 0.0)}


def test_model_of_the_state_equals_one_fit(spark, tmpdir_path):
    rows = []
    for i in range(3):
        rows += (r := [(y, 0 if a is None else a, b) for y, a, b in some_rows(20 + i)])
        write(tmpdir_path, f"f{i}.csv", r)
    got = nb_model(stream_nb_state(spark, tmpdir_path, ["a", "b"], batch_files=1, count=True), ["a", "b"])
    want = GaussianNB().fit(spark.createDataFrame(rows, "label string, a int, b int"), ["a", "b"], "label")
    assert got.classes == want.classes
    for v in ("theta", "var", "prior"):
        assert np.allclose(getattr(got, v), getattr(want, v), rtol=1e-9)
    with pytest.raises(ValueError):
        nb_model(spark.createDataFrame([], S.MERGED), ["a"])
