"""kNN units: exact inside a unit, and a row is sent a bounded number of times at any size."""

import numpy as np
import pandas as pd
import pytest

from netsieve.operators import knn


@pytest.mark.parametrize("seed,shift", [(0, 0.0), (1, 1e4)])
def test_unit_is_exact(seed, shift):
    rng = np.random.default_rng(seed)
    T = np.round(rng.normal(size=(400, 3)), 1) + shift                # ties, and digits that a product cancels
    pivots = T[:7].copy()
    cell = ((T[:, None] - pivots[None]) ** 2).sum(axis=2).argmin(axis=1)
    o = np.argsort(cell, kind="stable")
    T, cell, rank = T[o], cell[o], rng.permutation(400)
    radius = np.array([np.sqrt(((T[cell == c] - pivots[c]) ** 2).sum(axis=1)).max(initial=0) for c in range(7)])
    own = np.arange(400)
    a, b, d2 = knn.nearest_in_unit(T, np.full(400, np.inf), own, T, cell, rank, pivots, radius, 5)
    for i in range(400):
        d = knn._fold(np.repeat(T[i:i + 1], 400, axis=0), T)
        d[i] = np.inf
        want = np.lexsort((rank, d))[:5]
        on = a == i
        assert b[on].tolist() == want.tolist() and np.array_equal(d2[on], d[want])


@pytest.mark.parametrize("n", [100_000, 800_000, 3_000_000])
def test_copies_of_a_row_do_not_grow(n):
    model = knn.KNNModel.__new__(knn.KNNModel)
    model.pivots = np.random.default_rng(2).normal(size=(500, 64))
    model.size = np.full(500, n // 500)
    model.size[3] += n                                           # one cell of half the rows
    first, rows, place = model._layout()
    assert place.shape[1] <= max(knn.GROUPS, -(-int(model.size.sum()) * 512 // knn.UNIT_BYTES))
    assert rows * 512 <= knn.UNIT_BYTES * 1.01 and place.sum(axis=1).min() >= 1
    ends = (first + model.size - 1) // rows
    assert ends.max() < place.shape[1]


def test_a_unit_compares_few_pairs(monkeypatch):
    """In clustered rows a query meets the leaves near it, not the whole of the cells that a sphere reaches."""
    rng = np.random.default_rng(4)
    T = rng.normal(size=(6000, 4)) + np.repeat(rng.normal(size=(60, 4)) * 20, 100, axis=0)
    compared = []
    monkeypatch.setattr(knn, "_fold", lambda q, t, f=knn._fold: compared.append(len(q)) or f(q, t))
    tiles = []
    monkeypatch.setattr(knn.np, "partition", lambda d, *a, f=np.partition, **k: tiles.append(d.size) or f(d, *a, **k))
    cell = np.repeat(np.arange(3), 2000)                             # cells that tell nothing
    a, b, d2 = knn.nearest_in_unit(T, np.full(6000, np.inf), np.arange(6000), T, cell, np.arange(6000), T[[0, 2000, 4000]], np.full(3, 1e3), 5)
    assert len(a) == 30_000 and sum(compared) < 60 * 6000 and sum(tiles) < 1000 * 6000
    for i in range(0, 6000, 997):
        d = knn._fold(np.repeat(T[i:i + 1], 6000, axis=0), T)
        d[i] = np.inf
        assert b[a == i].tolist() == np.argsort(d, kind="stable")[:5].tolist()


@pytest.mark.parametrize("need", [1, 6, 40, 500])
def test_bound_of_the_cells_that_hold_enough(need):
    rng = np.random.default_rng(9)
    ub, size = np.round(rng.random((50, 90)), 2), rng.integers(0, 9, (50, 90))
    order = np.argsort(ub, axis=1, kind="stable")
    cum = np.cumsum(np.take_along_axis(size, order, axis=1), axis=1)
    want = np.take_along_axis(ub, order, axis=1)[np.arange(50), np.minimum((cum < need).sum(axis=1), 89)]
    assert np.array_equal(knn._covered(ub, size, need), want)


def test_boxes_leave_out_cells_that_spheres_reach():
    """Long thin cells: a query goes only to the group whose rows can be within its bound."""
    pivots = np.array([[0.0, 0.0], [0.0, 10.0], [0.0, 20.0]])
    radius, sizes, place = np.full(3, 50.0), np.ones((1, 3), np.int64), np.eye(3, dtype=np.float32)
    box = np.array([[[-50.0, -1.0], [-50.0, 9.0], [-50.0, 19.0]], [[50.0, 1.0], [50.0, 11.0], [50.0, 21.0]]])
    q = [pd.Series([np.array([5.0, 0.5]), np.array([5.0, 8.0])]), pd.Series([0, 0]), pd.Series([0, 1]), pd.Series([2.0, 8.0])]
    each = lambda box: [x.tolist() for x in knn._other_groups_udf(pivots, radius, sizes, place, box).func(*q)]
    assert each(None) == [[1, 2], [0, 2]]
    assert each(box) == [[], [0]]
