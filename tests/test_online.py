"""The logistic model learned batch by batch against one fit on all rows."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from netsieve import fixtures
from netsieve.operators.models import ready_for_fit
from netsieve.operators.logistic import fit_multinomial
from netsieve.operators.prep import Preprocessor
from netsieve.plans.q_stream import SIG_COLS, SIG_NUM
from netsieve.session import scratch_dir
from netsieve.sources.fixture_csv import write_csv_files
from netsieve.streaming import OnlineLogistic, online_predictions, read_online, stream_logistic_online


def sample(n, seed, classes=3):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, classes, n)
    x = rng.normal(size=(n, 3)) + np.array([[0, 0, 0], [1.5, 0, 1], [0, 2, -1]])[y]
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(list(map(float, a)), float(b)) for a, b in zip(x, y)], "x array<double>, y double")


def test_one_batch_is_the_plain_fit(spark):
    df = frame(spark, *sample(300, 1))
    m = OnlineLogistic(np.zeros(3), np.array([1.0, 2.0, 0.5]), 0.7)
    m.add_classes("abc")
    assert m.learn(df) > 0
    _, w, b, _ = fit_multinomial(df, "x", "y", 0.7, tol=1e-10)
    assert np.allclose(m.model().coefficients, w, atol=1e-5) and np.allclose(m.model().intercepts, b, atol=1e-5)


def test_batches_and_merges_come_near_one_fit(spark):
    x, y = sample(3000, 2)
    parts = [frame(spark, x[i:i + 500], y[i:i + 500]) for i in range(0, 3000, 500)]
    _, w, b, _ = fit_multinomial(frame(spark, x, y), "x", "y", 1.0)

    def learned(frames):
        m = OnlineLogistic(np.zeros(3), np.ones(3))
        m.add_classes("abc")
        for f in frames:
            m.learn(f)
        return m

    one, left, right = learned(parts), learned(parts[:3]), learned(parts[3:])
    both = left.merged(right)
    for m in (one, both):
        assert m.n == 3000
        assert np.allclose(m.model().coefficients, w, atol=0.1) and np.allclose(m.model().intercepts, b, atol=0.1)
    with pytest.raises(ValueError):
        one.merged(OnlineLogistic(np.ones(3), np.ones(3)))


def test_classes_that_come_late(spark):
    x, y = sample(2000, 3)
    early = y < 2
    m = OnlineLogistic(np.zeros(3), np.ones(3))
    m.add_classes("ab")
    m.learn(frame(spark, x[early][:900], y[early][:900]))
    m.add_classes("c")
    m.learn(frame(spark, x[1000:], y[1000:]))
    back = OnlineLogistic.from_row(*m.row())
    assert back.classes == ["a", "b", "c"] and back.n == m.n and np.array_equal(back.h, m.h)
    seen_x, seen_y = np.concatenate([x[early][:900], x[1000:]]), np.concatenate([y[early][:900], y[1000:]])
    _, w, b, _ = fit_multinomial(frame(spark, seen_x, seen_y), "x", "y", 1.0)
    right = lambda w, b: ((x @ w.T + b).argmax(axis=1) == y).mean()
    got, want = right(m.model().coefficients, m.model().intercepts), right(w, b)
    print("late class: online", got, "one fit of the same rows", want)
    assert got >= want - 0.03
    with pytest.raises(ValueError, match="not kept"):
        OnlineLogistic(np.zeros(800), np.ones(800)).add_classes("ab")


def write(d, name, x, y):
    with open(os.path.join(d, name), "w") as f:
        f.write("uid,label,a,b,c\n" + "".join(f"{name}{i},k{b},{a[0]},{a[1]},{a[2]}\n" for i, (a, b) in enumerate(zip(x, y))))


def test_a_stream_goes_on_from_its_state(spark, tmpdir_path):
    sink, state = scratch_dir(spark, "online"), scratch_dir(spark, "online-state")
    x, y = sample(900, 4)
    run = lambda: stream_logistic_online(spark, tmpdir_path, [], ["a", "b", "c"], batch_files=1, state=state, sink=sink)
    write(tmpdir_path, "f0.csv", x[:300], y[:300])
    first = run().collect()
    assert [(r["batch_id"], r["n"], r["accuracy_before"]) for r in first] == [(0, 300, None)]
    write(tmpdir_path, "f1.csv", x[300:600], y[300:600])
    write(tmpdir_path, "f2.csv", x[600:], y[600:])
    rows = sorted(run().collect(), key=lambda r: r["batch_id"])
    assert [r["n"] for r in rows] == [300] * 3
    for i in (1, 2):                        # as one fit of all earlier rows scores the batch
        _, w, b, _ = fit_multinomial(frame(spark, x[:300 * i], y[:300 * i]), "x", "y", 1.0)
        at = slice(300 * i, 300 * (i + 1))
        assert rows[i]["accuracy_before"] == pytest.approx(((x[at] @ w.T + b).argmax(axis=1) == y[at]).mean(), abs=0.02)
    model, _ = read_online(spark, state)
    assert model.n == 900 and model.classes == ["k0", "k1", "k2"]
    assert read_online(spark, state, before=1)[0].n == 300 and read_online(spark, state, before=0) is None


def test_flows_within_a_hundredth_of_one_fit(spark):
    sig = fixtures.flows_signal(spark, SF01)
    d = write_csv_files(spark, sig, "online-flows", columns=SIG_COLS)
    state = scratch_dir(spark, "online-flows-state")
    cat = ["proto", "conn_state"]
    stream_logistic_online(spark, d, cat, SIG_NUM, batch_files=4, state=state)
    right = F.avg((F.col("label") == F.col("predicted")).cast("double"))
    got = online_predictions(spark, state, sig, keep=["uid", "label"]).agg(right).first()[0]
    from netsieve.operators.models import REGISTRY
    feats = ready_for_fit(Preprocessor("label", cat, SIG_NUM).fit(sig).transform(sig, keep=["uid"]))
    whole = REGISTRY["logistic_regression"]().fit(feats).transform(feats)
    want = whole.agg(F.avg((F.col("label_idx") == F.col("prediction")).cast("double"))).first()[0]
    print("online", got, "one fit", want)
    assert got >= want - 0.01
