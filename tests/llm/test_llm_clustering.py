"""Exact clustering against plain rounds in Python integers; the bounds themselves."""

import hashlib
import math

import numpy as np
import pytest

from llm_fixtures import SF001
from netsieve.llm import clustering as cl


def plain(rows, dim=64, k=40, rounds=5):
    """Rounds without bounds, in Python integers."""
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    h = lambda r: ((1, "") if r[0] is None else (0, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest()),
                   np.array(r[1], np.int32).tobytes())
    cents = [v for _, v in sorted(kept, key=h)[:k]]
    x = np.array([v for _, v in kept], object).reshape(len(kept), dim)

    def assign():
        d = np.stack([((x - np.array(c, object)) ** 2).sum(axis=1) for c in cents], axis=1)
        best = [min(range(len(cents)), key=lambda j: (row[j], j)) for row in d]
        return best, [int(row[b]) for row, b in zip(d, best)]

    if not kept:
        return []
    for _ in range(rounds):
        best, _ = assign()
        for j in range(len(cents)):
            m = [v for v, b in zip(x.tolist(), best) if b == j]
            if m:
                cents[j] = [sum(col) // len(m) for col in zip(*m)]
    best, d = assign()
    inertia = {j: sum(y for y, b in zip(d, best) if b == j) for j in set(best)}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(i, b, y, inertia[b], sum(d), sha[b]) for (i, _), b, y in zip(kept, best, d)]


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows],
                                 "vec_id long, embedding array<float>, cluster int, v string, d2 long, label int").repartition(parts)


def same(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def f32(m):
    return [[float(np.float32(x)) for x in r] for r in m]


def test_awkward_vectors(spark):
    rng = np.random.default_rng(4)
    good = f32(rng.normal(0, 0.3, (120, 8)))
    rows = [(i, v) for i, v in enumerate(good)] + [(200 + i, good[3]) for i in range(60)]          # a group of copies
    rows += [(5, good[5]), (5, good[5]), (None, good[9]), (None, good[10])]                         # repeated rows, null ids
    rows += [(300, None), (301, []), (302, good[1][:7]), (303, good[1] + [1.0]), (304, [None] + good[1][1:]),
             (305, [float("nan")] + good[1][1:]), (306, [float("inf")] + good[1][1:]), (307, [-float("inf")] + good[1][1:])]
    rows += [(400, [0.0] * 8), (401, [0.5] * 4 + [-0.5] * 4), (402, [0.5] * 4 + [-0.5] * 4)]
    for k in (1, 7, 20, 500):                                                                       # 500: more than rows
        same(cl.cluster_report(frame(spark, rows), dim=8, k=k).collect(), plain(rows, 8, k))
    assert cl.cluster_report(frame(spark, [(1, None)]), dim=8).count() == 0
    assert cl.cluster_report(frame(spark, rows).limit(0), dim=8).count() == 0


def test_large_components(spark):
    rng = np.random.default_rng(6)
    rows = [(i, v) for i, v in enumerate(f32(rng.normal(0, 30_000, (90, 4))))]
    same(cl.cluster_report(frame(spark, rows), dim=4, k=9).collect(), plain(rows, 4, 9))
    with pytest.raises(Exception, match="do not fit a long"):
        cl.cluster_report(frame(spark, [(1, [1e30, 0.0, 0.0, 0.0])]), dim=4).collect()


def test_bounds_hold_and_spare_work(spark):
    """Stored bounds, loosened by the total displacement, stay on the right side of the true
    distances; that displacement is never above the sum of the drifts."""
    rng = np.random.default_rng(8)
    x = np.floor(np.concatenate([rng.normal(c, 20, (300, 16)) for c in rng.normal(0, 90, (9, 16))])).astype(np.int32)
    history = [x[rng.choice(len(x), 12, replace=False)].astype(np.int64)]
    state = cl.first_bounds(x, history[0])
    shares = []
    for _ in range(8):
        c = state[0]
        history.append(np.array([x[c == j].sum(axis=0) // max(1, (c == j).sum()) if (c == j).any() else history[-1][j] for j in range(12)], np.int64))
        state = cl.next_bounds(x, state, history)
        true = np.stack([cl.squared(x, h) for h in history[-1]], axis=1)
        assert (state[0] == true.argmin(axis=1)).all()
        moved = cl.displacements(history)
        rows = np.arange(len(x))
        down = state[3].astype(np.float64) - moved[state[4], np.arange(12)]
        other = np.ones_like(true, bool)
        other[rows, state[0]] = False
        assert (down[other] <= np.sqrt(true[other]) + 1e-9).all()
        assert (np.sqrt(state[1]) + moved[state[2], state[0]] >= np.sqrt(true[rows, state[0]]) - 1e-6).all()
        drift = sum(np.sqrt(((b - a) ** 2).sum(axis=1)) for a, b in zip(history, history[1:]))
        assert (moved[0] <= drift * (1 + 1e-6) + 1e-6).all()
        shares.append(state[5].sum() / true.size)
    assert shares[-1] < 0.3


def test_half_floats_round_down():
    d = np.concatenate([np.random.default_rng(1).uniform(0, 3000, 10_000), [0.0, 65504.0, 65505.0, 1e9]])
    assert (cl.lower_half(d).astype(np.float64) <= d).all()


def test_query_equals_plain_rounds(spark):
    from netsieve.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()]
    same(QUERIES["op11_centroid_clusters"](spark, SF001).collect(), plain(rows))
