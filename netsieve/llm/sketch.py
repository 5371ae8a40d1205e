"""Operator 1, document fingerprints: threshold-scaled sketches.

A sketch keeps every 5-word shingle hash below a fixed fraction of the hash space (so its
size follows the document), which makes it mergeable by set union, and lets containment be
estimated between documents of very different lengths.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import partitions, pieces, prepare, shingles, words_of

SHINGLE_WORDS = 5
SCALE = 4                       # one shingle hash in SCALE is kept
HASH_BITS = 48
_U = np.uint64
# 64 digits in code-point order, so hashes sort alike as numbers and as text
DIGITS = np.frombuffer(b"-0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz", np.uint8)
WIDTH = HASH_BITS // 6


def sketch_keys(arr: pa.Array, k: int = SHINGLE_WORDS, scale: int = SCALE) -> np.ndarray:
    """Sorted distinct (text number << 48 | kept 48-bit shingle hash) of a string array of
    fewer than 2^16 texts."""
    words, first = words_of(arr)
    sh, sh_first = shingles(words, first, k)
    sh >>= _U(64 - HASH_BITS)
    keep = np.flatnonzero(sh < _U((1 << HASH_BITS) // scale))
    doc = np.searchsorted(sh_first, keep, side="right") - 1
    return np.unique((doc.astype(np.uint64) << _U(HASH_BITS)) | sh[keep])


def _render(keys: np.ndarray, n: int) -> list[str]:
    """Fingerprint text per document: its hashes, ascending, WIDTH digits of six bits each."""
    out = np.empty((len(keys), WIDTH), np.uint8)
    for i in range(WIDTH):
        out[:, i] = DIGITS[((keys >> _U(HASH_BITS - 6 - 6 * i)) & _U(63)).astype(np.int64)]
    cut = np.searchsorted(keys, np.arange(n + 1).astype(np.uint64) << _U(HASH_BITS))
    flat = out.tobytes().decode("ascii")
    return [flat[WIDTH * a:WIDTH * b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


def _overlap(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(common, |a|, |b|) per document of two key arrays."""
    both = np.intersect1d(a, b, assume_unique=True)
    count = lambda x: np.bincount((x >> _U(HASH_BITS)).astype(np.int64), minlength=n)[:n]
    return count(both), count(a), count(b)


def likeness(common: np.ndarray, na: np.ndarray, nb: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Jaccard estimate of two sketches; two empty sketches: 1 for equal texts, else 0."""
    union = na + nb - common
    return np.where(union > 0, common / np.maximum(union, 1), same.astype(float))


def containment(common: np.ndarray, na: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Share of the first sketch that the second holds; an empty one: 1 for equal texts."""
    return np.where(na > 0, common / np.maximum(na, 1), same.astype(float))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 scale: int = SCALE, k: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fingerprint`` (ascending hashes, WIDTH characters each) of every whole text; no
    shuffle.  A null or wordless text has the empty fingerprint; repeated rows are kept;
    other columns are not read.  Union of two fingerprints' hashes is the fingerprint of
    the two texts' shingles together (:func:`merge_fingerprints`)."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in pieces(batches, "text"):
            keys = sketch_keys(b.column(1), k, scale)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_render(keys, b.num_rows), pa.string())],
                                             names=["doc_id", "fingerprint"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, fingerprint string")


def _hashes(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f".{{{WIDTH}}}"), F.lit(0))


def merge_fingerprints(a: Column, b: Column) -> Column:
    """Fingerprint of two texts' shingles together."""
    return F.array_join(F.array_sort(F.array_union(_hashes(a), _hashes(b))), "")


def containment_of(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` holds (null when ``a``'s sketch is empty)."""
    return F.try_divide(F.size(F.array_intersect(_hashes(a), _hashes(b))).cast("double"), F.size(_hashes(a)))


def _bucketed(src: DataFrame, n_parts: int) -> DataFrame:
    """Split (doc_id, text) into ``n_parts`` consecutive runs of the order (doc_id
    descending, nulls last, text hash), one run a partition, sorted; the first row of each
    run is also put, as a ``ghost``, behind the run before it (and that of the first run
    behind the last), so every row meets its successor in its own partition.

    The cuts come from a range partitioning of the ids alone; the driver gets one key a
    partition.  The text is shuffled once.
    """
    keyed = (src.withColumn("_n", F.col("doc_id").isNull())
             .withColumn("_k", F.coalesce(F.bitwise_not(F.col("doc_id")), F.lit(0)).cast("long"))
             .withColumn("_h", F.xxhash64("text")))
    order = ["_n", "_k", "_h"]
    heads = (keyed.select(*order).repartitionByRange(n_parts, *order)
             .groupBy(F.spark_partition_id().alias("_p")).agg(F.min(F.struct(*order)).alias("key")).collect())
    cuts = sorted({tuple(r["key"]) for r in heads})     # one per non-empty range: at most n_parts
    n_runs = max(1, len(cuts))
    cut = np.array([(int(n), k, h) for n, k, h in cuts], dtype=np.int64).reshape(-1, 3)

    @F.arrow_udf("int")
    def place(n: pa.Array, k: pa.Array, h: pa.Array) -> pa.Array:
        rows = np.stack([np.asarray(n.cast(pa.int8())).astype(np.int64), np.asarray(k), np.asarray(h)], axis=1)
        both = np.concatenate([cut, rows])
        rank = np.lexsort((np.arange(len(both)), both[:, 2], both[:, 1], both[:, 0]))  # cuts before equal rows
        seen = np.cumsum(rank < len(cut))
        at = np.empty(len(both), np.int64)
        at[rank] = seen
        run = at[len(cut):] - 1
        head = (cut[run] == rows).all(axis=1)
        return pa.array((run * 2 + head).astype(np.int32))

    at = F.col("_at")
    run, head = F.shiftright(at, 1), at.bitwiseAND(F.lit(1)) == 1
    own = F.struct(run.alias("run"), F.lit(False).alias("ghost"))
    copy = F.struct(F.pmod(run - 1, F.lit(n_runs)).alias("run"), F.lit(True).alias("ghost"))
    spread = (keyed.withColumn("_at", place(*order))
              .select("doc_id", "text", *order, F.explode(F.when(head, F.array(own, copy)).otherwise(F.array(own))).alias("_r"))
              .select("doc_id", "text", *order, F.col("_r.run").alias("run"), F.col("_r.ghost").alias("ghost")))
    return (spread.repartitionById(n_runs, "run").sortWithinPartitions("run", "ghost", *order)
            .select("doc_id", "text", "run", "ghost"))


def edit_report(docs: DataFrame, scale: int = SCALE, k: int = SHINGLE_WORDS) -> DataFrame:
    """Fingerprint of every text and of its edited text, whose last floor(n_chars / 3) code
    points are the first as many (or all) of the next document's, by descending doc_id
    (null ids last, equal ids by a hash of the text; after the last comes the first).

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next`` and ``kept_in_edited`` (containment).  Null texts are empty; likeness of two
    empty sketches is 1 for equal texts and else 0; a lone document is its own next; an
    empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = _bucketed(src, partitions(spark))

    def report(ids, texts):
        """Rows for all but the last of ``texts``, each against the one after it."""
        n = len(texts) - 1
        cut = [len(t) // 3 for t in texts[:-1]]
        edited = [t[:len(t) - c] + x[:c] for t, x, c in zip(texts, texts[1:], cut)]
        own_arr, edited_arr = pa.array(texts, pa.large_string()), pa.array(edited, pa.large_string())
        own, ed = sketch_keys(own_arr, k, scale), sketch_keys(edited_arr, k, scale)
        own_fp, ed_fp = _render(own, n), _render(ed, n)
        nxt = own[own >= _U(1 << HASH_BITS)] - _U(1 << HASH_BITS)
        mine = own[own < _U(n << HASH_BITS)]
        same_ed = np.fromiter((t == e for t, e in zip(texts, edited)), bool, n)
        same_nx = np.fromiter((t == e for t, e in zip(texts, texts[1:])), bool, n)
        c_ed, n_own, n_ed = _overlap(mine, ed, n)
        c_nx, _, n_nx = _overlap(mine, nxt, n)
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
            pa.array(own_fp, pa.string()), pa.array(ed_fp, pa.string()),
            pa.array(likeness(c_ed, n_own, n_ed, same_ed)), pa.array(likeness(c_nx, n_own, n_nx, same_nx)),
            pa.array(containment(c_ed, n_own, same_ed))], names=names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next", "kept_in_edited"]

    def run(batches):
        last = None                                   # (id, text) that waits for its next
        for b in pieces(batches, "text"):
            ids, texts, ghosts = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()
            if last is not None:
                ids, texts, ghosts = [last[0], *ids], [last[1], *texts], [False, *ghosts]
                last = None
            i = 0
            while i < len(texts):                     # up to and with a run's first ghost
                stop = next((j for j in range(i, len(texts)) if ghosts[j]), None)
                end = len(texts) - 1 if stop is None else stop
                if end > i:
                    yield report(ids[i:end], texts[i:end + 1])
                if stop is None:
                    last = (ids[end], texts[end])
                    break
                i = stop + 1
    return parts.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double, kept_in_edited double")
