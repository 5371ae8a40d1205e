"""Exact k-nearest-neighbour classification without an all-pairs join.

Pivot pruning (metric-space indexing) over bounded units:

1. m pivots = training rows drawn by a salted hash threshold (m grows with the data);
2. every training row gets its nearest pivot (its *cell*) and the distance to it; per
   cell the radius r_c (largest such distance) and size n_c -- a table of m rows;
3. per query q, with D_c = d(q, pivot_c): every point of cell c lies within D_c + r_c,
   so walking cells by D_c + r_c until k (+1 when the query is itself a training row)
   points are covered bounds the k-th neighbour distance by U(q);
4. a point in cell c is at least D_c - r_c away, and (up to BOX_DIMS dimensions) at least as far
   as the box around the cell's points, so only cells where neither is beyond U(q) can hold a
   neighbour;
5. cells are laid out so that near ones stand together and cut into GROUPS groups of equal
   size (more where a group would exceed UNIT_BYTES); a query goes first to the group of its
   nearest cell, where k points are found whose k-th distance replaces U(q) if it is smaller
   (U(q) counts whole cells, so it is loose), then once to every other group that still holds a
   candidate cell; the queries of a group go into SPLITS splits at most, so a row is sent a
   fixed number of times however large the data are;
6. a unit is a group and a split of its queries, held by one task: its rows are cut into small
   leaves along the widest dimensions, its queries into tiles likewise; a tile walks the leaves
   from the nearest box, skipping those beyond the k-th distances found so far; a matrix product
   with an error bound picks the pairs whose distance is then summed left to right, the same
   arithmetic as a SQL fold; a rank filter keeps the global k by (distance, id); majority vote,
   vote ties to the smallest class.

What pruning can do depends on the data.  In clustered data most cells are skipped; for
vectors without structure in many dimensions all distances are alike, no exact method skips
much, and the work is that of all pairs (``share_of_cells`` tells).

Duplicates.  Before all this, each distinct training vector keeps only its k + 1
smallest ids.  A further copy is never a neighbour: its k + 1 twins lie at the same
distance from any query with smaller ids, so even with the query itself excluded k rows
rank before it.  The answer is unchanged, and a vector repeated across a third of the
data costs k + 1 rows instead of a quadratic pair count in its cell.  The rank
filter is limited map-side, so the hot vector never meets on one task in full.

Folds.  ``group_col`` (the fold of cross-validation) keeps the training rows of a query's own
group out of its neighbours: one search over all rows then serves every fold, and, as the
nearest k hold the nearest of any smaller k, every ``n_neighbors`` (grid_scores).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from .rank import hash_order, track

MAX_PIVOTS = 2048
GROUPS = 24                  # groups of training rows, and
SPLITS = 8                   # splits of a group's queries (in their first group HOME_SPLITS on average), as long
HOME_SPLITS = 4              # as a side stays under
UNIT_BYTES = 96 << 20        # bytes of vectors on one side of a unit
UNIT_ROWS = 2048             # aimed rows of a side at least
TILE = 128                   # queries of a distance matrix at most,
LEAF = 32                    # rows of a leaf at most,
TILE_ROWS = 4096             # and rows of a distance matrix
BOX_DIMS = 32                # dimensions up to which a query is compared with the boxes of cells and leaves
MIN_CELL = 128               # aimed rows of a cell at least
SLICE = 1024                 # rows of a distance matrix against the pivots at once


def _as_double_array(df: DataFrame, col: str):
    """DOUBLE array from an array column or an ML vector column."""
    if isinstance(df.schema[col].dataType, ArrayType):
        return F.col(col).cast(ArrayType(DoubleType()))
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(col)


def choose_pivots(train: DataFrame, vec: str, id_col: str, m: int | None, seed: int) -> np.ndarray:
    n = train.count()
    if m is None:
        m = int(min(MAX_PIVOTS, max(1, min(round(np.sqrt(n)), n // MIN_CELL))))
    # rows whose hash falls under a threshold: about 2m rows reach the driver, with no
    # global sort (a top-m sort would merge m rows from every partition on one task)
    # The salt keeps this draw independent of the samplers' and splits' hash order (a
    # split may already have sent the smallest md5(uid|seed) values elsewhere).
    frac = min(1.0, 2.0 * m / max(n, 1))
    key = hash_order(id_col, f"{seed}|pivots")
    h = F.conv(F.substring(key, 1, 12), 16, 10).cast("double") / float(16 ** 12)
    rows = (train.select(_as_double_array(train, vec).alias("v"), key.alias("_h"), id_col)
                 .where(h < F.lit(frac)).collect())
    if not rows:                                   # tiny inputs: any m rows will do
        rows = train.select(_as_double_array(train, vec).alias("v"), key.alias("_h"), id_col).limit(m).collect()
    rows.sort(key=lambda r: (r["_h"], r[id_col]))
    return np.array([r["v"] for r in rows[:m]], dtype=np.float64)


def _pivot_distances(x: np.ndarray, pivots: np.ndarray, p2: np.ndarray) -> np.ndarray:
    d2 = (x ** 2).sum(axis=1)[:, None] - 2.0 * x @ pivots.T + p2[None, :]
    return np.sqrt(np.maximum(d2, 0.0))


def _least_distances(x: np.ndarray, pivots: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """Lower bounds of the distances, below them by no more than the product form may err."""
    x2 = (x ** 2).sum(axis=1)[:, None]
    error = 16 * (x.shape[1] + 8) * np.finfo(float).eps * (x2 + p2[None, :])
    return np.sqrt(np.maximum(x2 - 2.0 * x @ pivots.T + p2[None, :] - error, 0.0))


def _slices(v: pd.Series):
    """A batch of vectors in slices, so that no matrix holds more than SLICE rows."""
    for i in range(0, len(v), SLICE):
        yield np.stack(v.iloc[i:i + SLICE].to_numpy()).astype(np.float64)


def _nearest_pivot_udf(pivots: np.ndarray):
    schema = StructType([StructField("cell", IntegerType()), StructField("dist", DoubleType())])
    p2 = (pivots ** 2).sum(axis=1)

    @F.pandas_udf(schema)
    def nearest(v: pd.Series) -> pd.DataFrame:
        cells, dists = [], []
        for x in _slices(v):
            c = _pivot_distances(x, pivots, p2).argmin(axis=1)
            cells.append(c.astype(np.int32))
            # exact distance to the chosen pivot (the matrix form may lose digits)
            dists.append(np.sqrt(((x - pivots[c]) ** 2).sum(axis=1)))
        return pd.DataFrame({"cell": np.concatenate(cells), "dist": np.concatenate(dists)})
    return nearest


def _bound_udf(pivots: np.ndarray, radius: np.ndarray, sizes: np.ndarray, home: np.ndarray, need: int):
    """(number of cells that can hold a neighbour, group of the nearest cell, bound of the k-th distance) of
    each query.  ``home`` is the group of each cell; ``sizes`` has a row of cell sizes for each fold, without the rows of the fold; the second column
    tells the row that counts for a query."""
    p2 = (pivots ** 2).sum(axis=1)
    schema = StructType([StructField("n_cells", IntegerType()), StructField("home", IntegerType()), StructField("bound", DoubleType())])

    @F.pandas_udf(schema)
    def cands(v: pd.Series, fold: pd.Series) -> pd.DataFrame:
        count, at, bound = [], [], []
        for i, x in enumerate(_slices(v)):
            size = sizes[fold.iloc[i * SLICE:(i + 1) * SLICE].to_numpy()]
            D = _pivot_distances(x, pivots, p2)
            ub = D + radius[None, :]
            U = _covered(ub, size, need)
            U[size.sum(axis=1) < need] = np.inf
            U = U + 1e-9 * (U + D.max(axis=1)) + 1e-12   # only widens the candidate set
            keep = ((D - radius[None, :]) <= U[:, None]) & (size > 0)
            count.append(keep.sum(axis=1).astype(np.int32))
            at.append(home[np.where(size > 0, D, np.inf).argmin(axis=1)].astype(np.int32))
            bound.append(U)
        return pd.DataFrame({"n_cells": np.concatenate(count), "home": np.concatenate(at), "bound": np.concatenate(bound)})
    return cands


def _box_gaps(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every box."""
    total = np.zeros((len(x), len(low)))
    for v, lower, upper in zip(x.T, low.T, high.T):
        gap = np.maximum(np.maximum(lower[None] - v[:, None], v[:, None] - upper[None]), 0.0)
        total += gap * gap
    return total


def _covered(ub: np.ndarray, size: np.ndarray, need: int) -> np.ndarray:
    """The bound within which the cells of the smallest bounds hold ``need`` rows (the largest where all of
    them hold fewer); a few of the smallest nearly always suffice."""
    out, rows, few = np.empty(len(ub)), np.arange(len(ub)), 16
    while len(rows):
        few = min(few, ub.shape[1])
        b, n = ub[rows], size[rows]
        at = np.argpartition(b, few - 1, axis=1)[:, :few]
        b, n = np.take_along_axis(b, at, axis=1), np.take_along_axis(n, at, axis=1)
        order = np.argsort(b, axis=1, kind="stable")
        b, cum = np.take_along_axis(b, order, axis=1), np.cumsum(np.take_along_axis(n, order, axis=1), axis=1)
        first = np.minimum((cum < need).sum(axis=1), few - 1)
        out[rows] = b[np.arange(len(rows)), first]
        rows = rows[(cum[:, -1] < need) & (few < ub.shape[1])]
        few *= 16
    return out


def _other_groups_udf(pivots: np.ndarray, radius: np.ndarray, sizes: np.ndarray, place: np.ndarray, box: np.ndarray | None = None):
    """Groups other than the first one of a query with a cell that can hold a row within its bound."""
    p2 = (pivots ** 2).sum(axis=1)
    sides = None if box is None else (np.ascontiguousarray(box[0].T), np.ascontiguousarray(box[1].T))

    @F.pandas_udf(ArrayType(IntegerType()))
    def others(v: pd.Series, fold: pd.Series, home: pd.Series, bound: pd.Series) -> pd.Series:
        lists = []
        for i, x in enumerate(_slices(v)):
            part = slice(i * SLICE, (i + 1) * SLICE)
            U, size = bound.iloc[part].to_numpy(), sizes[fold.iloc[part].to_numpy()]
            low = _least_distances(x, pivots, p2) - radius[None, :]
            U = U * (1 + 1e-9) + 1e-12
            keep = (low <= U[:, None]) & (size > 0)
            if sides is not None:
                q, c = np.nonzero(keep)
                columns = np.ascontiguousarray(x.T)
                for at in range(0, len(q), 1 << 15):
                    a, b = q[at:at + (1 << 15)], c[at:at + (1 << 15)]
                    total = np.zeros(len(a))
                    for v, lower, upper in zip(columns, *sides):
                        v = v[a]
                        gap = np.maximum(np.maximum(lower[b] - v, v - upper[b]), 0.0)
                        total += gap * gap
                    keep[a, b] = np.sqrt(total) <= U[a]
            hit = keep.astype(np.float32) @ place > 0
            hit[np.arange(len(x)), home.iloc[part].to_numpy()] = False
            lists += [np.flatnonzero(g).astype(np.int32) for g in hit]
        return pd.Series(lists)
    return others


def _near_order(pivots: np.ndarray, rows: np.ndarray) -> list[int]:
    """Pivots in an order that keeps near ones together: halves along the widest dimension."""
    if len(rows) < 2:
        return rows.tolist()
    x = pivots[rows]
    rows = rows[np.argsort(x[:, int(np.ptp(x, axis=0).argmax())], kind="stable")]
    half = len(rows) // 2
    return _near_order(pivots, rows[:half]) + _near_order(pivots, rows[half:])


def _fold(Q: np.ndarray, T: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows, summed left to right like a SQL fold."""
    d2 = np.zeros(len(Q))
    for j in range(Q.shape[1]):
        diff = Q[:, j] - T[:, j]
        d2 += diff * diff
    return d2


def _leaves(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows in an order that keeps near ones together, start of each run of at most ``most``): halves along
    the widest dimension, all runs of a size at once."""
    order, starts = np.arange(len(x)), np.zeros(1, np.int64)
    while True:
        size = np.diff(starts, append=len(x))
        if size.max() <= most:
            return order, starts
        y, run = x[order], np.repeat(np.arange(len(starts)), size)
        wide = (np.maximum.reduceat(y, starts) - np.minimum.reduceat(y, starts)).argmax(axis=1)
        order = order[np.lexsort((y[np.arange(len(y)), wide[run]], run))]
        starts = np.sort(np.concatenate([starts, (starts + (size + 1) // 2)[size > most]]))


def nearest_in_unit(Q, bound, own, T, cell, rank, pivots, radius, k: int, folds=None):
    """(query, training row, squared distance) of the k nearest of ``T`` to each of ``Q`` within ``bound``, ties
    to the smaller ``rank``; ``own`` is the row that a query must not meet (-1: none), ``folds`` the folds
    of queries and rows, those of one fold not meeting.  The leaves and tiles are made of the rows
    themselves, whatever their cells."""
    order, starts = _leaves(T, LEAF)
    size, t = np.diff(starts, append=len(T)), T[order]
    low, high = np.minimum.reduceat(t, starts), np.maximum.reduceat(t, starts)
    q_order, q_starts = _leaves(Q, TILE)
    out = []
    for rows in np.split(q_order, q_starts[1:]):
        x, limit = Q[rows], np.minimum(bound[rows] ** 2, np.inf)
        centre, near, far = x.mean(axis=0), x.min(axis=0), x.max(axis=0)
        # squared distances of the boxes around tile and leaf; a hair less, as limits are sums of rounded squares
        gaps = (np.maximum(np.maximum(low - far, near - high), 0.0) ** 2).sum(axis=1) * (1 - 1e-9)
        walk = np.argsort(gaps, kind="stable")
        a, b, v = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        at, some = 0, -(-4 * (k + 1) // LEAF) + 4
        while at < len(walk):
            leaves, at, some = walk[at:at + some], at + some, TILE_ROWS // LEAF
            leaves = leaves[gaps[leaves] <= limit.max()]
            if not len(leaves):
                break                                # the others are further away
            on = np.arange(len(rows))
            if Q.shape[1] <= BOX_DIMS:
                may = _box_gaps(x, low[leaves], high[leaves]) * (1 - 1e-9) <= limit[:, None]
                leaves, on = leaves[may.any(axis=0)], np.flatnonzero(may.any(axis=1))
                if not len(on):
                    continue
            n = size[leaves]
            js = np.repeat(starts[leaves] - np.cumsum(n) + n, n) + np.arange(n.sum())
            y, z = t[js] - centre, x[on] - centre
            js = order[js]
            y2, z2 = (y ** 2).sum(axis=1), (z ** 2).sum(axis=1)
            D = z2[:, None] + y2[None, :]
            error = 16 * (Q.shape[1] + 8) * np.finfo(float).eps * (z2 + y2.max() + (centre ** 2).max())
            D -= 2.0 * (z @ y.T)
            if folds is not None:
                D[folds[0][rows[on]][:, None] == folds[1][js][None, :]] = np.inf
            most = limit[on] * (1 + 1e-9) + error
            many = np.flatnonzero((D <= most[:, None]).sum(axis=1) > 4 * (k + 1))
            if len(many):                            # the k-th of these rows alone bounds too
                most[many] = np.minimum(most[many], np.partition(D[many], k, axis=1)[:, k] + 2 * error[many])
            i, j = np.nonzero(D <= most[:, None])
            i, j = on[i], js[j]
            other = own[rows[i]] != j
            if folds is not None:
                other &= folds[0][rows[i]] != folds[1][j]
            i, j = i[other], j[other]
            if not len(i):
                continue
            d2 = _fold(x[i], T[j])
            fine = np.isfinite(d2) & (d2 <= limit[i])
            a, b, v = np.concatenate([a, i[fine]]), np.concatenate([b, j[fine]]), np.concatenate([v, d2[fine]])
            o = np.lexsort((rank[b], v, a))
            a, b, v = a[o], b[o], v[o]
            place = np.arange(len(a)) - np.searchsorted(a, a)
            full = place == k - 1
            limit[a[full]] = np.minimum(limit[a[full]], v[full])
            a, b, v = a[place < k], b[place < k], v[place < k]
        out.append((rows[a], b, v))
    return tuple(np.concatenate(x) for x in zip(*out))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def _unit_topk(pivots: np.ndarray, radius: np.ndarray, k: int, exclude_self: bool, out: pa.Schema, grouped: bool = False):
    def topk(q: pa.Table, t: pa.Table) -> pa.Table:
        if not q.num_rows or not t.num_rows:
            return out.empty_table()
        t = t.take(pc.sort_indices(t, [("cell", "ascending"), ("id", "ascending")]))
        rank = np.empty(t.num_rows, np.int64)
        rank[pc.sort_indices(t["id"].combine_chunks()).to_numpy()] = np.arange(t.num_rows)
        own = np.full(q.num_rows, -1)
        if exclude_self:
            own = pc.fill_null(pc.index_in(q["id"].combine_chunks(), t["id"].combine_chunks()), -1).to_numpy(zero_copy_only=False)
        folds = (q["fold"].to_numpy(), t["fold"].to_numpy()) if grouped else None
        a, b, d2 = nearest_in_unit(_matrix(q["v"]), q["bound"].to_numpy(), own, _matrix(t["v"]), t["cell"].to_numpy(), rank, pivots, radius, k, folds)
        return pa.table([q["id"].take(pa.array(a)), t["id"].take(pa.array(b)), t["label"].take(pa.array(b)), pa.array(d2)], schema=out)
    return topk


class KNNClassifier:
    """k nearest neighbours, Euclidean; votes are equal, or by inverse distance."""

    def __init__(self, n_neighbors: int = 5, pivots: int | None = None, seed: int = 42, weights: str = "uniform"):
        self.weights = weights
        self.k = int(n_neighbors)
        self.m = pivots
        self.seed = seed

    def fit(self, train: DataFrame, vec: str = "features", label_col: str = "label_idx",
            id_col: str = "uid", group_col: str | None = None) -> "KNNModel":
        return KNNModel(self, train, vec, label_col, id_col, group_col)


class KNNModel:
    def __init__(self, est: KNNClassifier, train: DataFrame, vec: str, label_col: str, id_col: str, group_col: str | None = None):
        self.k, self.vec, self.label_col, self.id_col = est.k, vec, label_col, id_col
        self.weights, self.group_col = est.weights, group_col
        t = train.select(F.col(id_col).alias("_t_id"), _as_double_array(train, vec).alias("_t_v"),
                         F.col(label_col).alias("_t_label"), self._fold().alias("_t_fold"))
        twins = Window.partitionBy("_t_v", "_t_fold").orderBy("_t_id")
        # read four times below: kept once
        t = track(t.withColumn("_twin", F.row_number().over(twins)).where(F.col("_twin") <= self.k + 1).drop("_twin"))
        self.classes = sorted(r[0] for r in t.select("_t_label").distinct().collect() if r[0] is not None)
        self.pivots = choose_pivots(t, "_t_v", "_t_id", est.m, est.seed)
        cell = _nearest_pivot_udf(self.pivots)
        cells = track(t.withColumn("_tc", cell("_t_v")).select(
            "_t_id", "_t_v", "_t_label", "_t_fold", F.col("_tc.cell").alias("_cell"), F.col("_tc.dist").alias("_pdist")))
        m, d = self.pivots.shape
        sides = [f(F.col("_t_v")[j]) for f in (F.min, F.max) for j in range(d)] if d <= BOX_DIMS else []
        stats = cells.groupBy("_t_fold", "_cell").agg(F.max("_pdist").alias("r"), F.count(F.lit(1)).alias("n"),
                                                      F.array(*sides).alias("box")).collect()
        self.radius = np.zeros(m)
        each = np.zeros((1 + max((r["_t_fold"] for r in stats), default=0), m), dtype=np.int64)
        for r in stats:
            self.radius[r["_cell"]] = max(self.radius[r["_cell"]], r["r"])
            each[r["_t_fold"], r["_cell"]] = r["n"]
        self.size = each.sum(axis=0)
        self.box = None                                          # least and largest value in each dimension, by cell
        if sides:
            self.box = np.stack([np.full((m, d), np.inf), np.full((m, d), -np.inf)])
            for r in stats:
                low, high = np.array(r["box"], float).reshape(2, d)
                self.box[:, r["_cell"]] = np.minimum(self.box[0, r["_cell"]], low), np.maximum(self.box[1, r["_cell"]], high)
        # rows of a cell that a query may meet, by its fold
        self.others = self.size[None, :] - (each if group_col else 0 * each)
        self.train = cells.drop("_pdist")

    def _fold(self):
        return F.col(self.group_col).cast("int") if self.group_col else F.lit(0)

    def _layout(self) -> tuple[np.ndarray, int, np.ndarray]:
        """(first place of each cell, rows of a group, cells x groups: which groups hold rows of a cell)."""
        n, width = int(self.size.sum()), self.pivots.shape[1] * 8
        groups = max(min(GROUPS, -(-n // UNIT_ROWS)), -(-n * width // UNIT_BYTES), 1)
        rows = max(1, -(-n // groups))
        order = np.array(_near_order(self.pivots, np.arange(len(self.pivots))))
        first = np.zeros(len(order), np.int64)
        first[order] = np.cumsum(self.size[order]) - self.size[order]
        at = np.arange(groups)[None, :]
        place = (at >= (first // rows)[:, None]) & (at <= ((first + self.size - 1) // rows)[:, None]) & (self.size > 0)[:, None]
        return first, rows, place.astype(np.float32)

    def _queries(self, queries: DataFrame, need: int, home: np.ndarray) -> DataFrame:
        q = queries.select(F.col(self.id_col).alias("id"), _as_double_array(queries, self.vec).alias("v"), self._fold().alias("fold"))
        bounds = _bound_udf(self.pivots, self.radius, self.others, home, need)
        return q.withColumn("_c", bounds("v", "fold")).select("id", "v", "fold", "_c.n_cells", "_c.home", "_c.bound")

    def share_of_cells(self, queries: DataFrame, exclude_self: bool = False) -> float:
        """Mean share of the (non-empty) cells that a query cannot rule out before any search."""
        q = self._queries(queries, self.k + (1 if exclude_self else 0), np.zeros(len(self.pivots), np.int32))
        return (q.agg(F.avg("n_cells")).first()[0] or 0.0) / max(1, int((self.size > 0).sum()))

    def _searched(self, sent: DataFrame, most: int, layout, exclude_self: bool) -> DataFrame:
        """The k nearest rows of group ``g`` to each row of ``sent``; the queries of a group are cut into
        splits of about ``most``."""
        from pyspark.sql.pandas.types import to_arrow_schema
        first, rows, place = layout
        groups = place.shape[1]
        met = {r["g"]: r["n"] for r in sent.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
        most = max(1, min(max(UNIT_ROWS, most), UNIT_BYTES // (8 * self.pivots.shape[1])))
        splits = [-(-met.get(g, 0) // most) for g in range(groups)]
        before = F.array(*[F.lit(sum(splits[:g])) for g in range(groups)])
        each = F.array(*[F.lit(max(1, n)) for n in splits])
        units = max(1, 2 * sum(splits))
        of = lambda x, g: F.element_at(x, F.col(g) + 1)
        sent = sent.withColumn("u", of(before, "g") + F.pmod(F.xxhash64("id"), of(each, "g")).cast("int")).select("u", "id", "v", "fold", "bound")
        at = F.array(*[F.lit(int(x)) for x in first]), F.array(*[F.lit(max(1, int(x))) for x in self.size])
        where = of(at[0], "_cell") + F.pmod(F.xxhash64("_t_id"), of(at[1], "_cell"))
        kept = (self.train.withColumn("g", F.floor(where / F.lit(rows)).cast("int")).where(of(F.array(*[F.lit(n) for n in splits]), "g") > 0)
                .withColumn("u", F.explode(F.sequence(of(before, "g"), of(before, "g") + of(each, "g") - 1)))
                .select("u", F.col("_t_id").alias("id"), F.col("_t_label").alias("label"), F.col("_t_v").alias("v"), F.col("_t_fold").alias("fold"),
                        F.col("_cell").alias("cell")))
        found = StructType([StructField("_q_id", sent.schema["id"].dataType), StructField("_t_id", kept.schema["id"].dataType),
                            StructField("_t_label", kept.schema["label"].dataType), StructField("d2", DoubleType())])
        topk = _unit_topk(self.pivots, self.radius, self.k, exclude_self, to_arrow_schema(found), self.group_col is not None)
        return (sent.repartition(units, "u").groupBy("u").cogroup(kept.repartition(units, "u").groupBy("u"))
                .applyInArrow(topk, found))

    def neighbours(self, queries: DataFrame, exclude_self: bool = False) -> DataFrame:
        """(query id, train id, label, squared distance, rank) for the k nearest."""
        layout = self._layout()
        first, rows, place = layout
        q = track(self._queries(queries, self.k + (1 if exclude_self else 0), (first // rows).clip(0, place.shape[1] - 1)))
        n = q.count()
        found = self._searched(q.withColumnRenamed("home", "g"), -(-n // (HOME_SPLITS * GROUPS)), layout, exclude_self)
        if place.shape[1] > 1:
            found = track(found)
            kth = (found.groupBy(F.col("_q_id").alias("id")).agg(F.count(F.lit(1)).alias("_n"), F.sqrt(F.max("d2")).alias("_d"))
                   .where(F.col("_n") >= self.k).select("id", (F.col("_d") * (1 + 1e-9) + 1e-12).alias("_d")))
            # least() passes over the null of a query that met fewer than k rows
            q = q.join(kth, "id", "left").withColumn("bound", F.least("bound", "_d"))
            others = _other_groups_udf(self.pivots, self.radius, self.others, place, self.box)
            sent = track(q.select("id", "v", "fold", "bound", others("v", "fold", "home", "bound").alias("groups")))
            rest = self._searched(sent.select("id", "v", "fold", "bound", F.explode("groups").alias("g")), -(-n // SPLITS), layout, exclude_self)
            found = found.unionByName(rest)
        w = Window.partitionBy("_q_id").orderBy("d2", "_t_id")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= self.k)

    def transform(self, queries: DataFrame, exclude_self: bool = False, keep=None) -> DataFrame:
        pred = self._predicted(self.neighbours(queries, exclude_self), self.weights)
        keep = keep if keep is not None else queries.columns
        out = queries.select(*keep).join(pred.withColumnRenamed("_q_id", self.id_col), self.id_col, "left")
        total = F.aggregate(F.map_values("votes"), F.lit(0.0), lambda a, b: a + b)
        share = [F.coalesce(F.try_element_at("votes", F.lit(c)) / total, F.lit(0.0)) for c in self.classes]
        return out.withColumn("scores", F.array(*share)).drop("votes")

    @staticmethod
    def _predicted(nb: DataFrame, weights: str) -> DataFrame:
        """(_q_id, prediction, votes by label) from the neighbours of each query."""
        vote = F.lit(1.0)
        if weights == "distance":               # training rows at distance 0 outvote all others
            zero = F.max((F.col("d2") == 0).cast("int")).over(Window.partitionBy("_q_id"))
            nb = nb.withColumn("_zero", zero)
            vote = F.when(F.col("_zero") == 1, (F.col("d2") == 0).cast("double")).otherwise(1 / F.sqrt("d2"))
        votes = nb.groupBy("_q_id", "_t_label").agg(F.sum(vote).alias("votes"))
        return votes.groupBy("_q_id").agg(
            F.min_by("_t_label", F.struct((-F.col("votes")).alias("v"), F.col("_t_label").alias("l"))).alias("prediction"),
            F.map_from_entries(F.collect_list(F.struct(F.col("_t_label"), F.col("votes")))).alias("votes"))

    def fold_scores(self, rows: DataFrame, settings) -> list[dict]:
        """{fold: share of its rows predicted right from the other folds} for each (k, weights) of
        ``settings`` (k up to the model's); the model is fitted on all of ``rows``."""
        nb = track(self.neighbours(rows).select("_q_id", "_t_label", "d2", "rank"))
        right = F.coalesce((F.col("prediction") == F.col(self.label_col)).cast("double"), F.lit(0.0))
        out = []
        for k, weights in settings:
            pred = self._predicted(nb.where(F.col("rank") <= k), weights).withColumnRenamed("_q_id", self.id_col)
            got = (rows.select(self.id_col, self.label_col, self._fold().alias("_f"))
                   .join(pred.drop("votes"), self.id_col, "left").groupBy("_f").agg(F.avg(right).alias("a")))
            out.append({r["_f"]: r["a"] for r in got.collect()})
        return out
