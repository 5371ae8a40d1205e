"""Operator 11, exact centroid clustering with ns-bounds.

Every vector keeps a lower bound of its distance to each centroid together with the round in
which it was measured, and the same for its own centroid from above.  All earlier centroids
are kept (rounds x k vectors, held by the driver), so a bound is loosened by the *norm of the
centroid's total displacement* since that round, which is never more than the sum of its
drifts round by round.  Centroids that the loosened bounds do not rule out are measured again,
exactly, in integers; no vector is ever assigned by a bound alone.

Vectors and bounds are written after each round, so a lost executor repeats one round at
most; sums leave a task as one row a centroid and component.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import prepare, stored, trim

DIM = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
START = "2:"                     # vec_id behind it is hashed to choose the first centroids
LARGEST = 1 << 27                # of a component: beyond it a squared distance needs more than a long
EXACT = 1 << 22                  # components up to which float64 products of vectors are exact
BLOCK_ROWS = 8192
# bounds are compared with this much to spare, far above the rounding of float64
_SLACK = 1e-9


class Clustering(NamedTuple):
    """``assigned``: ``vec_id, cluster, distance`` of every kept vector (written); ``history``:
    the centroids (k x dim) that each round started from, the final ones last; ``evaluated``: the
    share of vector-centroid distances that was measured in each assignment."""

    assigned: DataFrame
    history: list
    evaluated: list


def _blocks(batches):
    """Record batches put together to about BLOCK_ROWS rows."""
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= BLOCK_ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
    held = None
    trim()


def _column(table: pa.Table, name: str) -> pa.Array:
    c = table.column(name)
    return c.chunk(0) if c.num_chunks == 1 else pa.concat_arrays(c.chunks)


def _matrix(table: pa.Table, name: str, dtype, width: int) -> np.ndarray:
    """A binary column of equal-sized rows as a matrix (no copy)."""
    arr = _column(table, name)
    off = np.frombuffer(arr.buffers()[1], np.int32)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(arr.buffers()[2], np.uint8)[off[0]:off[-1]]
    return raw.view(dtype).reshape(len(arr), width)


def _binary(m: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    m = np.ascontiguousarray(m)
    size = m.shape[1] * m.itemsize
    off = np.arange(len(m) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(off), pa.py_buffer(m.tobytes())])


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
              dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: the kept vectors (exactly ``dim`` components, none null, NaN or infinite)
    with integer components floor(scale * x), as int32 bytes.  Raises where a component is too
    large for squared distances to fit a long."""
    def run(batches):
        for t in _blocks(batches):
            arr = _column(t, "embedding")
            n = np.asarray(arr.value_lengths().fill_null(-1))
            rows = np.flatnonzero(n == dim)
            m = arr.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            good = np.isfinite(m).all(axis=1)
            q = np.floor(m[good] * scale)
            if len(q) and np.abs(q).max() > LARGEST:
                raise ValueError(f"a component above {LARGEST} in size: its squared distances do not fit a long")
            yield pa.RecordBatch.from_arrays([_column(t, "vec_id").take(pa.array(rows[good])), _binary(q.astype(np.int32))],
                                             names=["vec_id", "v"])

    src = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    kind = src.schema["vec_id"].dataType.simpleString()
    return src.mapInArrow(run, f"vec_id {kind}, v binary")


def first_centroids(kept: DataFrame, k: int, dim: int, start: str = START) -> np.ndarray:
    """The ``k`` kept vectors with the smallest SHA-256 of ``start`` and vec_id (ties by
    components; a null vec_id comes last), fewer where there are fewer."""
    h = F.sha2(F.concat(F.lit(start), F.col("vec_id").cast("string")).cast("binary"), 256)
    top = kept.select(h.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([np.frombuffer(r["v"], np.int32) for r in top], np.int64).reshape(len(top), dim)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows ``x`` to one centroid."""
    if len(x) and max(np.abs(x).max(), np.abs(c).max()) > EXACT:
        return ((x.astype(np.int64) - c) ** 2).sum(axis=1)
    d = x.astype(np.float64) - c
    return np.einsum("ij,ij->i", d, d).astype(np.int64)


def lower_half(d: np.ndarray) -> np.ndarray:
    """float16 values not above ``d``."""
    with np.errstate(over="ignore"):
        h = d.astype(np.float16)
    return np.where(h.astype(np.float64) > d, np.nextafter(h, np.float16(0)), h)


def displacements(history: list) -> np.ndarray:
    """rounds x k norms of the way from each earlier centroid to the present one."""
    now = history[-1].astype(np.float64)
    return np.stack([np.sqrt(((now - h) ** 2).sum(axis=1)) * (1 + _SLACK) for h in history])


def first_bounds(x: np.ndarray, centroids: np.ndarray):
    """Assignment without bounds: (cluster, squared distance, its round, bounds, their rounds,
    distances measured)."""
    n, k = len(x), len(centroids)
    d2 = np.stack([squared(x, c) for c in centroids], axis=1) if n else np.zeros((0, k), np.int64)
    cluster = d2.argmin(axis=1).astype(np.int32)
    return (cluster, d2[np.arange(n), cluster], np.zeros(n, np.uint8),
            lower_half(np.sqrt(d2) * (1 - _SLACK)), np.zeros((n, k), np.uint8), np.full(n, k, np.int32))


def next_bounds(x: np.ndarray, state, history: list, every: bool = False):
    """The state after an assignment to the last centroids of ``history``.  A vector whose
    loosened bounds rule out all other centroids keeps its own unmeasured (measured with
    ``every``); else its own centroid is measured and then those still not ruled out."""
    cluster, d2, at, low, seen, _ = (a.copy() for a in state)
    now, t = history[-1], len(history) - 1
    k = len(now)
    moved = displacements(history)
    n = len(x)
    rows, every_k = np.arange(n), np.arange(k)
    evals = np.zeros(n, np.int32)
    up = np.sqrt(d2) * (1 + _SLACK) + moved[at, cluster]
    down = low.astype(np.float64) - moved[seen, every_k]
    down[rows, cluster] = np.inf
    near = down.min(axis=1)
    open_ = near <= up * (1 + _SLACK) + _SLACK
    own = rows if every else np.flatnonzero(open_)
    for j in np.unique(cluster[own]).tolist():
        r = own[cluster[own] == j]
        d2[r], at[r] = squared(x[r], now[j]), t
    evals[own] += 1
    up = np.sqrt(d2) * (1 + _SLACK)
    r0 = np.flatnonzero(open_)
    fails = down[r0] <= up[r0, None] * (1 + _SLACK) + _SLACK
    best, best_d = cluster[r0].copy(), d2[r0].copy()
    for j in np.flatnonzero(fails.any(axis=0)).tolist():
        i = np.flatnonzero(fails[:, j])
        d = squared(x[r0[i]], now[j])
        low[r0[i], j] = lower_half(np.sqrt(d) * (1 - _SLACK))
        seen[r0[i], j] = t
        evals[r0[i]] += 1
        nearer = (d < best_d[i]) | ((d == best_d[i]) & (j < best[i]))
        best[i[nearer]], best_d[i[nearer]] = j, d[nearer]
    i = np.flatnonzero(best != cluster[r0])
    r, old = r0[i], cluster[r0[i]]
    low[r, old], seen[r, old] = lower_half(np.sqrt(d2[r]) * (1 - _SLACK)), t
    cluster[r], d2[r] = best[i], best_d[i]
    return cluster, d2, at, low, seen, evals


def _assign(rows: DataFrame, history: list, dim: int, final: bool) -> DataFrame:
    """One assignment of all vectors to the last centroids of ``history``, with new bounds
    (without them and the vectors after the last round)."""
    k = len(history[-1])
    fresh = len(history) == 1

    def run(batches):
        for t in _blocks(batches):
            x = _matrix(t, "v", np.int32, dim)
            if fresh:
                state = first_bounds(x, history[-1])
            else:
                old = (np.asarray(_column(t, "cluster")), np.asarray(_column(t, "d2")), np.asarray(_column(t, "at")).astype(np.uint8),
                       _matrix(t, "low", np.float16, k), _matrix(t, "seen", np.uint8, k), np.zeros(0, np.int32))
                state = next_bounds(x, old, history, every=final)
            cluster, d2, at, low, seen, evals = state
            cols = [_column(t, "vec_id"), pa.array(cluster), pa.array(d2), pa.array(evals)]
            if not final:
                cols += [_column(t, "v"), pa.array(at.astype(np.int32)), _binary(low), _binary(seen)]
            yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "cluster", "d2", "evals", "v", "at", "low", "seen"][:len(cols)])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, cluster int, d2 long, evals int" + ("" if final else ", v binary, at int, low binary, seen binary"))


def _sums(state: DataFrame, k: int, dim: int) -> tuple[np.ndarray, list, int, int]:
    """Rows per centroid, sums of their components (Python integers), rows in all and distances
    measured.  A task sends one row a centroid and component it has met."""
    def run(batches):
        total, count, evals = np.zeros((k, dim), np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
        for t in _blocks(batches):
            x, c = _matrix(t, "v", np.int32, dim), np.asarray(_column(t, "cluster"))
            o = np.argsort(c, kind="stable")
            cut = np.flatnonzero(np.diff(c[o], prepend=-1))
            total[c[o][cut]] += np.add.reduceat(x[o].astype(np.int64), cut, axis=0)
            count += np.bincount(c, minlength=k)
            evals += np.bincount(c, np.asarray(_column(t, "evals")), minlength=k).astype(np.int64)
        some = np.flatnonzero(count)
        # components 0 .. dim - 1, then the count and the distances measured
        both = np.concatenate([total[some], count[some, None], evals[some, None]], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some, dim + 2).astype(np.int32)),
                                          pa.array(np.tile(np.arange(dim + 2, dtype=np.int32), len(some))), pa.array(both.ravel())],
                                         names=["cluster", "i", "total"])

    parts = state.select("cluster", "v", "evals").mapInArrow(run, "cluster int, i int, total long")
    # at most k * (dim + 2) rows; decimal sums cannot overflow
    found = parts.groupBy("cluster", "i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total = [[0] * (dim + 2) for _ in range(k)]
    for r in found:
        total[r["cluster"]][r["i"]] = int(r["total"])
    count = np.array([x[dim] for x in total], object)
    return count, [x[:dim] for x in total], int(count.sum()), sum(x[dim + 1] for x in total)


def clustered(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dim: int = DIM,
              k: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, start: str = START) -> Clustering:
    """Lloyd rounds over all kept vectors, exact, with ns-bounds.

    Each round assigns every vector to its nearest centroid (ties: the smaller number), then
    moves every centroid that has vectors to their componentwise floor(sum / count); a last
    assignment follows.  Rows with a null, short, long or non-finite vector are left out; repeated
    rows and a null vec_id are rows like others; fewer than ``k`` kept vectors give as many
    centroids; an empty table gives an empty result; other columns are not read.
    """
    if not 1 <= rounds < 256:
        raise ValueError("rounds of 1 to 255: the round of a bound is kept in a byte")
    spark = vectors.sparkSession
    prepare(spark)
    kept = _kept_table(quantised(vectors, vec_id, embedding, dim, scale), "cluster-vectors")
    history = [first_centroids(kept, k, dim, start)]
    evaluated = []
    if not len(history[0]):
        kind = kept.schema["vec_id"].dataType.simpleString()
        return Clustering(spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), history, evaluated)
    k = len(history[0])
    state = kept
    for _ in range(rounds):
        state = _kept_table(_assign(state, history, dim, final=False), "cluster-state")
        count, total, n, evals = _sums(state, k, dim)
        evaluated.append(evals / (n * k))
        history = history + [np.array([[s // int(c) for s in row] if c else old.tolist()
                                       for c, row, old in zip(count, total, history[-1])], np.int64).reshape(k, dim)]
    last = stored(_assign(state, history, dim, final=True), "cluster-assigned")
    n, evals = last.agg(F.count(F.lit(1)), F.sum("evals")).first()
    evaluated.append(evals / (n * k))
    return Clustering(last.select("vec_id", "cluster", F.col("d2").alias("distance")), history, evaluated)


def _kept_table(df: DataFrame, tag: str) -> DataFrame:
    """A table written for the next round, in the smaller of the usual compressions."""
    from ..session import scratch_dir
    spark: SparkSession = df.sparkSession
    path = scratch_dir(spark, f"llm-{tag}")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cluster_report(vectors: DataFrame, **options) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept
    vector (see :func:`clustered`); the table per centroid has at most k rows."""
    found = clustered(vectors, **options)
    spark = vectors.sparkSession
    per = found.assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()
    inertia = sum(r["s"] for r in per)
    rows = [(r["cluster"], r["s"], inertia, hashlib.sha256(",".join(map(str, found.history[-1][r["cluster"]].tolist())).encode()).hexdigest())
            for r in per]
    side = spark.createDataFrame(rows, "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (found.assigned.join(F.broadcast(side), F.col("cluster") == F.col("c"))
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
