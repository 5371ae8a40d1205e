"""Sparse logistic regression in numpy over bounded samples, and hashed text features."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import _U, mix, pieces, text_bytes, word_hashes, word_spans, WORD_BYTE

SLOT_BITS = 18
MAX_FEATURES = 4096
PREFIXES = (5, 7)
_SYMBOL = ~WORD_BYTE & (np.arange(256) > 0x20) & (np.arange(256) < 0x7F)


def slots_of(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, slot) of every word, the first PREFIXES bytes of every longer word, and
    every run of symbols of the texts."""
    buf, off = text_bytes(arr)
    docs, slots = [], []
    a, b = word_spans(buf, off)
    heads = [(a[b - a > k], a[b - a > k] + k) for k in PREFIXES]
    for i, (start, end) in enumerate([(a, b), word_spans(buf, off, _SYMBOL), *heads]):
        h = mix(word_hashes(buf, start, end) + _U(i))
        docs.append(np.searchsorted(off, start, side="right") - 1)
        slots.append((h >> _U(64 - SLOT_BITS)).astype(np.int64))
    return np.concatenate(docs), np.concatenate(slots)


def bounded_sample(df: DataFrame, at_most: int, salt: str) -> DataFrame:
    """About ``at_most`` rows of ``df`` (all, if it has fewer), by a hash of ``doc_id``."""
    n = df.count()
    share = min(1.0, at_most / max(1, n))
    return df.where(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 30)) < int(share * (1 << 30)))


def select_features(sample: DataFrame, ys=("y",), most: int = MAX_FEATURES) -> np.ndarray:
    """Feature number per slot (-1: not used): the ``most`` slots that best tell 1 from 0 in any of
    the 0/1 columns ``ys`` of ``sample`` (columns ``text`` and ``ys``), among those in at least two
    texts.  Every column ranks the slots by its own gain; a slot counts by its best rank, so each
    column has its share.  One pass; the driver gets one row a slot, 2^SLOT_BITS at most."""
    ys = list(ys)
    names = ["n", *[f"n{i}" for i in range(len(ys))]]

    def count(batches):
        total = np.zeros((len(names), 1 << SLOT_BITS), np.int64)
        size = np.zeros(len(names), np.int64)
        for b in pieces(batches, "text"):
            doc, slot = slots_of(b.column(0))
            key = np.unique(doc << SLOT_BITS | slot)
            doc, slot = key >> SLOT_BITS, key & ((1 << SLOT_BITS) - 1)
            total[0] += np.bincount(slot, minlength=1 << SLOT_BITS)
            size[0] += b.num_rows
            for i in range(len(ys)):
                y = np.asarray(b.column(1 + i)) == 1
                total[1 + i] += np.bincount(slot[y[doc]], minlength=1 << SLOT_BITS)
                size[1 + i] += y.sum()
        at = np.append(np.flatnonzero(total[0]), -1)    # slot -1: texts in all and of each column
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(np.where(at < 0, size[i], total[i][at])) for i in range(len(names))]],
                                         names=["slot", *names])

    got = (sample.select(F.coalesce("text", F.lit("")).alias("text"), *[F.col(y).cast("int").alias(f"y{i}") for i, y in enumerate(ys)])
           .mapInArrow(count, "slot long, " + ", ".join(f"{c} long" for c in names))
           .groupBy("slot").agg(*[F.sum(c).alias(c) for c in names]).toArrow())
    slot, n = np.asarray(got["slot"]), np.asarray(got["n"])
    lookup = np.full(1 << SLOT_BITS, -1, np.int32)
    if not len(slot):
        return lookup
    keep = (slot >= 0) & (n >= 2)
    texts = float(n[slot < 0].sum())
    p = (n[keep] + 1) / (texts + 2)
    rank = np.full(keep.sum(), keep.sum())
    for i in range(len(ys)):
        n1 = np.asarray(got[f"n{i}"])
        ones = float(n1[slot < 0].sum())
        p1, p0 = (n1[keep] + 0.5) / (ones + 1), (n[keep] - n1[keep] + 0.5) / (texts - ones + 1)
        gain = np.abs(p1 - p0) / np.sqrt(p * (1 - p) + 1e-9)
        mine = np.empty(len(rank), np.int64)
        mine[np.lexsort((slot[keep], -gain))] = np.arange(len(rank))
        rank = np.minimum(rank, mine)
    best = np.lexsort((slot[keep], rank))[:most]
    lookup[np.sort(slot[keep][best])] = np.arange(len(best))
    return lookup


def weighted(arr: pa.Array, lookup: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, feature, log2(1 + occurrences)) of the selected features of each text."""
    doc, slot = slots_of(arr)
    f = lookup[slot].astype(np.int64)
    on = f >= 0
    width = max(1, int(lookup.max()) + 1)
    key, n = np.unique(doc[on] * width + f[on], return_counts=True)
    return key // width, key % width, np.log2(1 + n).astype(np.float32)


def packed(x, n: int) -> list:
    """Features of ``n`` texts as two binary arrays (features, values), a row a text."""
    rows, cols, vals = x
    cut = np.searchsorted(rows, np.arange(n + 1))
    return [pa.array([v[i:j].astype(t).tobytes() for i, j in zip(cut[:-1], cut[1:])], pa.binary())
            for v, t in ((cols, np.int32), (vals, np.float32))]


def unpacked(cols: list, vals: list):
    """Features of the texts of two lists of binaries, as of :func:`weighted`."""
    c = [np.frombuffer(v, np.int32) for v in cols]
    rows = np.repeat(np.arange(len(c)), [len(v) for v in c]).astype(np.int64)
    none = [np.zeros(0, np.int32)]
    return rows, np.concatenate(c or none).astype(np.int64), np.frombuffer(b"".join(vals), np.float32)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


class Linear:
    """Logistic model: weights of sparse features, of dense columns, and a constant."""

    def __init__(self, w, v, b):
        self.w, self.v, self.b = w, v, b

    def margin(self, x, dense):
        rows, cols, vals = x
        n = len(dense)
        return np.bincount(rows, weights=vals * self.w[cols], minlength=n)[:n] + dense @ self.v + self.b


def fit_logistic(x, n_cols: int, dense, y, l2: float = 1.0, steps: int = 120) -> Linear:
    """Penalised logistic regression by Adam on the whole (bounded) sample.  ``x`` lists the
    features (row, feature, value); a sample of one class gives a constant model."""
    rows, cols, vals = x
    n = len(y)
    y = np.asarray(y, float)
    prior = (y.sum() + 0.5) / (n + 1)
    w, v = np.zeros(n_cols), np.zeros(dense.shape[1])
    b = np.array([np.log(prior / (1 - prior))])
    if n == 0 or y.min() == y.max():
        return Linear(w, v, float(b[0]))
    state = [[p, np.zeros_like(p), np.zeros_like(p)] for p in (w, v, b)]
    for t in range(1, steps + 1):
        g = y - sigmoid(np.bincount(rows, weights=vals * w[cols], minlength=n)[:n] + dense @ v + b[0])
        grads = (np.bincount(cols, weights=vals * g[rows], minlength=n_cols)[:n_cols] - l2 * w, dense.T @ g - l2 * v, np.array([g.sum()]))
        for (p, m, s), d in zip(state, grads):
            d = d / n
            m += 0.1 * (d - m)
            s += 0.01 * (d * d - s)
            p += 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-9)
    return Linear(w, v, float(b[0]))


def take(x, keep):
    """The features of the kept rows (a mask), renumbered."""
    rows, cols, vals = x
    number = np.cumsum(keep) - 1
    on = keep[rows]
    return number[rows[on]], cols[on], vals[on]


def best_threshold(p, y) -> float:
    """Probability cut with the best F1 on (out-of-fold) probabilities; 0.5 if undefined."""
    o = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[o])
    if not len(y) or hit[-1] == 0:
        return 0.5
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + hit[-1])
    k = int(f1.argmax())
    lower = p[o][k + 1] if k + 1 < len(p) else 0.0
    return float((p[o][k] + lower) / 2)


