"""Exact positions under an order, without pulling a group onto one task.

``row_number() over (partition by g order by k)`` sorts a whole group in one task; a class
holding a third of 100 TB would sit on one executor.  Instead:

1. range-partition on (g, k) -- the partitioner samples key bounds, and since k ends with
   a unique tie-break, even one hot group spreads over many partitions;
2. sort within partitions and tag each row with ``monotonically_increasing_id`` (its
   documented layout: partition id in the upper bits, row number below);
3. aggregate (g, partition) -> (first id, count): at most partitions + groups rows;
4. running sum of the counts over the partitions of each group gives the offset;
5. position = offset + (id - first id) + 1.

The range partitioner samples its bounds with a seed tied to the RDD, so two plans over
the same input may cut different ranges.  The tagged frame is therefore persisted once
(memory, spilling to disk); the statistics are computed from that copy and written with a
reliable ``checkpoint()`` (a small table in ``spark.checkpoint.dir``), which cuts their
lineage, and the final join reads the persisted frame.  If an executor is lost, its
blocks are recomputed from lineage: same bounds (same RDD), and a unique sort key makes
the ids come out identical.  The small statistics side is broadcast only when its row
bound (partitions + groups) is known to be small; otherwise it is a shuffle join.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpoint_root

# statistics rows are ~40 bytes; 1e6 rows stay well under a broadcast budget of 64 MB
BROADCAST_ROWS = 1_000_000

_PERSISTED: list = []
_LOCAL = threading.local()


def release() -> None:
    """Unpersist the frames kept by this package (positional-index tags, fit frames);
    call after the results that use them have been computed."""
    while _PERSISTED:
        _PERSISTED.pop().unpersist()


def track(df: DataFrame) -> DataFrame:
    """Persist ``df`` (memory, spilling to disk) and remember it for ``release``."""
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    _PERSISTED.append(out)
    if getattr(_LOCAL, "frames", None) is not None:
        _LOCAL.frames.append(out)
    return out


@contextmanager
def released():
    """Unpersist on exit the frames that this thread tracked inside the block."""
    mine: list = []
    outer = getattr(_LOCAL, "frames", None)
    _LOCAL.frames = mine
    try:
        yield
    finally:
        _LOCAL.frames = outer
        for df in mine:
            df.unpersist()
            _PERSISTED[:] = [x for x in _PERSISTED if x is not df]


def hash_order(uid_col: str, seed: int = 42) -> Column:
    """Deterministic pseudo-random order key: md5(uid | seed).  Same value in DuckDB."""
    return F.md5(F.concat(F.col(uid_col).cast("string"), F.lit("|"), F.lit(str(seed))))


def _parts(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _range(df: DataFrame, keys, num_partitions: int | None) -> DataFrame:
    """Range partitioning on ``keys``.  Without an explicit count, AQE may merge adjacent
    ranges into fewer partitions: merged ranges stay contiguous and in key order, and
    the partition id and row id below come from the same task, so positions hold."""
    if num_partitions:
        return df.repartitionByRange(int(num_partitions), *keys)
    return df.repartitionByRange(*keys)


def positional_index(df: DataFrame, order_cols, group_cols=(), *, n_groups: int | None = None,
                     num_partitions: int | None = None, pos_col: str = "_pos",
                     count_col: str | None = None) -> DataFrame:
    """Add ``pos_col``: 1-based position of each row within its group under ``order_cols``.

    ``order_cols`` must make a total order (end with a unique column); ``group_cols`` may
    be empty (one global order).  ``count_col`` optionally adds the group's row count.
    """
    group_cols = list(group_cols)
    order_cols = list(order_cols)
    keys = [F.col(c) if isinstance(c, str) else c for c in group_cols + order_cols]
    n = _parts(df, num_partitions)          # upper bound on partitions (AQE only merges)
    srt = (_range(df, keys, num_partitions).sortWithinPartitions(*keys)
             .withColumn("_rk_pid", F.spark_partition_id())
             .withColumn("_rk_id", F.monotonically_increasing_id()))
    srt = track(srt)
    stats = (srt.groupBy(*group_cols, "_rk_pid")
             .agg(F.min("_rk_id").alias("_rk_first"), F.count(F.lit(1)).alias("_rk_cnt")))
    before = Window.partitionBy(*group_cols).orderBy("_rk_pid").rowsBetween(Window.unboundedPreceding, -1)
    sel = [F.col(g).alias(f"_rk_g{i}") for i, g in enumerate(group_cols)]
    sel += [F.col("_rk_pid").alias("_rk_spid"), "_rk_first",
            F.coalesce(F.sum("_rk_cnt").over(before), F.lit(0)).alias("_rk_off")]
    if count_col:
        sel.append(F.sum("_rk_cnt").over(Window.partitionBy(*group_cols)).alias(count_col))
    checkpoint_root(df.sparkSession)
    stats = stats.select(*sel).checkpoint(eager=True)
    if n_groups is not None and n + n_groups <= BROADCAST_ROWS:
        stats = F.broadcast(stats)
    cond = F.col("_rk_pid") == F.col("_rk_spid")
    for i, g in enumerate(group_cols):
        cond = cond & F.col(g).eqNullSafe(F.col(f"_rk_g{i}"))
    joined = srt.join(stats, cond, "inner")
    out_cols = [F.col(c) for c in df.columns]
    out_cols.append((F.col("_rk_off") + F.col("_rk_id") - F.col("_rk_first") + F.lit(1)).alias(pos_col))
    if count_col:
        out_cols.append(F.col(count_col))
    return joined.select(*out_cols)


def limit_per_group(df: DataFrame, order_cols, group_cols, quota: Column, **kw) -> DataFrame:
    """Rows whose position within their group is <= ``quota`` (a column expression)."""
    ranked = positional_index(df, order_cols, group_cols, pos_col="_lpg_pos", **kw)
    return ranked.where(F.col("_lpg_pos") <= quota).drop("_lpg_pos")


def _local_sums(srt: DataFrame, group_cols, sum_cols) -> DataFrame:
    """Add ``_rs_l_<c>``: inclusive running sums of ``sum_cols`` inside each partition of
    ``srt``, restarting at each group.  ``srt`` is sorted within its partitions by (group,
    order), so one pass over each partition's Arrow batches, carrying the running totals
    across batches, is enough: no second shuffle (a window over (group, partition id)
    would re-distribute the rows, since a range partitioning does not satisfy it)."""
    import numpy as np
    import pandas as pd
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType
    from pyspark.sql.types import ByteType, IntegerType, ShortType

    integral = (ByteType, ShortType, IntegerType, LongType)
    types = {c: LongType() if isinstance(srt.schema[c].dataType, integral) else DoubleType() for c in sum_cols}
    schema = StructType(list(srt.schema.fields) + [StructField(f"_rs_l_{c}", types[c]) for c in sum_cols])
    groups, sums = list(group_cols), list(sum_cols)

    def same_as(pdf, key):
        m = np.ones(len(pdf), dtype=bool)
        for g, v in zip(groups, key):
            col = pdf[g]
            m &= (col.isna() if pd.isna(v) else (col == v).fillna(False)).to_numpy(dtype=bool)
        return m

    def run(batches):
        carry_key, carry = None, None
        for pdf in batches:
            if pdf.empty:
                continue
            vals = pdf[sums].astype({c: "int64" if isinstance(types[c], LongType) else "float64" for c in sums})
            if groups:
                cs = vals.groupby([pdf[g] for g in groups], sort=False, dropna=False).cumsum()
            else:
                cs = vals.cumsum()
            first = tuple(pdf[g].iloc[0] for g in groups)
            if carry is not None and all((pd.isna(a) and pd.isna(b)) or a == b for a, b in zip(first, carry_key)):
                head = same_as(pdf, first)
                # groups are contiguous: only the leading run continues the carried group
                stop = len(head) if head.all() else int(np.argmin(head))
                cs.iloc[:stop] = cs.iloc[:stop].to_numpy() + carry
            carry_key = tuple(pdf[g].iloc[-1] for g in groups)
            carry = cs.iloc[-1].to_numpy()
            yield pdf.assign(**{f"_rs_l_{c}": cs[c].to_numpy() for c in sums})

    return srt.mapInPandas(run, schema)


def _local_next(srt: DataFrame, group_cols, cols) -> DataFrame:
    """Add ``_rs_n_<c>``: the value of ``cols`` in the next row of the same group and partition
    of ``srt`` (null in the last one).  One pass over the Arrow batches, a row held back."""
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql.types import StructField, StructType

    schema = StructType(list(srt.schema.fields) + [StructField(f"_rs_n_{c}", srt.schema[c].dataType) for c in cols])
    groups, names = list(group_cols), list(cols)

    def with_next(rows: pa.RecordBatch, after: pa.RecordBatch) -> pa.RecordBatch:
        same = pa.array([True] * rows.num_rows)
        for g in groups:
            a, b = rows.column(g), after.column(g)
            both_null = pc.and_(pc.is_null(a), pc.is_null(b))
            same = pc.and_(same, pc.or_(pc.fill_null(pc.equal(a, b), False), both_null))
        new = [pc.if_else(same, after.column(c), pa.scalar(None, after.column(c).type)) for c in names]
        return pa.RecordBatch.from_arrays(rows.columns + new, names=schema.names)

    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                yield with_next(held, b.slice(0, 1))
            if b.num_rows > 1:
                yield with_next(b.slice(0, b.num_rows - 1), b.slice(1))
            held = b.slice(b.num_rows - 1)
        if held is not None:
            none = [pa.nulls(1, held.column(c).type) for c in names]
            yield pa.RecordBatch.from_arrays(held.columns + none, names=schema.names)

    return srt.mapInArrow(run, schema)


def running_sums(df: DataFrame, order_cols, sum_cols, group_cols=(), *, n_groups: int | None = None,
                 num_partitions: int | None = None, prefix: str = "cum_",
                 total_prefix: str | None = None, next_cols=(), next_prefix: str = "next_") -> DataFrame:
    """Inclusive running sums of ``sum_cols`` within each group under ``order_cols`` (a
    total order).  Same device as :func:`positional_index`: range partitions, a sum per
    (group, partition), offsets from the small statistics, local sums inside each range.
    With ``total_prefix``, each row also gets its group's totals (from the statistics).  With
    ``next_cols`` (columns without nulls) it gets their values in the group's next row: inside a
    range by looking one row ahead, over its edge from the first rows of the ranges, which are
    part of the statistics."""
    next_cols = list(next_cols)
    group_cols = list(group_cols)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    keys = [F.col(c) for c in group_cols] + order
    n = _parts(df, num_partitions)
    srt = track(_range(df, keys, num_partitions).sortWithinPartitions(*keys)
                .withColumn("_rs_pid", F.spark_partition_id()))
    if next_cols:
        srt = srt.withColumn("_rs_id", F.monotonically_increasing_id())
    stats = srt.groupBy(*group_cols, "_rs_pid").agg(
        *[F.sum(c).alias(f"_rs_t_{c}") for c in sum_cols],
        *([F.min_by(F.struct(*next_cols), F.col("_rs_id")).alias("_rs_first")] if next_cols else []))
    before = Window.partitionBy(*group_cols).orderBy("_rs_pid").rowsBetween(Window.unboundedPreceding, -1)
    sel = [F.col(g).alias(f"_rs_g{i}") for i, g in enumerate(group_cols)] + [F.col("_rs_pid").alias("_rs_spid")]
    sel += [F.coalesce(F.sum(f"_rs_t_{c}").over(before), F.lit(0)).alias(f"_rs_o_{c}") for c in sum_cols]
    if total_prefix:
        whole = Window.partitionBy(*group_cols)
        sel += [F.sum(f"_rs_t_{c}").over(whole).alias(f"_rs_T_{c}") for c in sum_cols]
    if next_cols:
        sel.append(F.lead("_rs_first").over(Window.partitionBy(*group_cols).orderBy("_rs_pid")).alias("_rs_edge"))
    checkpoint_root(df.sparkSession)
    stats = stats.select(*sel).checkpoint(eager=True)
    if n_groups is not None and n + n_groups <= BROADCAST_ROWS:
        stats = F.broadcast(stats)
    local = _local_sums(_local_next(srt, group_cols, next_cols) if next_cols else srt, group_cols, sum_cols)
    cond = F.col("_rs_pid") == F.col("_rs_spid")
    for i, g in enumerate(group_cols):
        cond = cond & F.col(g).eqNullSafe(F.col(f"_rs_g{i}"))
    j = local.join(stats, cond, "inner")
    totals = [F.col(f"_rs_T_{c}").alias(f"{total_prefix}{c}") for c in sum_cols] if total_prefix else []
    return j.select(*[F.col(c) for c in df.columns],
                    *[(F.col(f"_rs_o_{c}") + F.col(f"_rs_l_{c}")).alias(f"{prefix}{c}") for c in sum_cols],
                    *totals,
                    *[F.coalesce(F.col(f"_rs_n_{c}"), F.col(f"_rs_edge.{c}")).alias(f"{next_prefix}{c}") for c in next_cols])
