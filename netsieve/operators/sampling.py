"""Exact-count samplers.  The draw is a hash order (md5(uid|seed), uid): stable under
repartitioning and reproducible in SQL.  Quotas come from one small aggregate, and rows are
picked by comparing their own hash with a few threshold keys (see threshold.py): a sampled
frame is a filtered scan, and no row is moved to choose it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .threshold import hash_cuts


def sample_exact_n(df: DataFrame, n: int, seed: int = 42, uid="uid") -> DataFrame:
    """Exactly min(n, rows) rows, uniform under the hash order."""
    quotas = df.sparkSession.createDataFrame([([int(n)],)], "_q array<long>")
    cut = hash_cuts(df, [], quotas, df.count(), uid, seed, n_groups=1)
    return cut.where(F.col("_cut") == 0).drop("_cut")


def class_counts(df: DataFrame, label_col: str) -> dict:
    return {r[0]: int(r[1]) for r in df.groupBy(label_col).count().collect()}


def balanced_quota(counts: dict, n_files: int, max_rows_total: int | None = None) -> int:
    """Rows to take per (file, class): m // n_files + 1, m = smallest class (capped)."""
    counts = {k: v for k, v in counts.items() if k is not None}
    m = min(counts.values())
    if max_rows_total:
        m = min(m, max_rows_total // len(counts))
    return m // n_files + 1


def sample_balanced(df: DataFrame, label_col: str = "label", file_col: str = "source_file",
                    max_rows_total: int | None = None, n_files: int | None = None,
                    seed: int = 42, uid="uid", policy: str = "per_file") -> DataFrame:
    """Balance classes; rows with a null label are left out, but when no row has a label all
    rows are returned, as the reference falls back.

    ``policy='per_file'``: min(available, m // n_files + 1) rows from each (file, class), m
    the smallest class; ``'global'``: m rows of each class, whatever the file.
    """
    if policy not in ("per_file", "global"):
        raise ValueError(f"policy must be 'per_file' or 'global', not {policy!r}")
    totals = {k: v for k, v in class_counts(df, label_col).items() if k is not None}
    if not totals:
        return df
    labelled = df.where(F.col(label_col).isNotNull())
    n = sum(totals.values())
    if policy == "global":
        m = min(totals.values())
        m = min(m, max_rows_total // len(totals)) if max_rows_total else m
        groups, q = [label_col], m
    else:
        nf = n_files if n_files is not None else df.select(file_col).distinct().count()
        groups, q = [file_col, label_col], balanced_quota(totals, nf, max_rows_total)
    quotas = labelled.select(*groups).distinct().withColumn("_q", F.array(F.lit(q).cast("long")))
    return hash_cuts(labelled, groups, quotas, n, uid, seed).where(F.col("_cut") == 0).drop("_cut")


def stratified_quota_sizes(counts: dict, size: int) -> dict:
    n = sum(counts.values())            # null-label rows count in n but form no class
    return {k: max(1, int(size * c / n)) for k, c in counts.items() if k is not None}


def sample_stratified_cap(df: DataFrame, cap: int, label_col: str = "label", seed: int = 42,
                          uid="uid") -> DataFrame:
    """If rows > cap: per class max(1, int(cap * n_c / n)) rows; if that still exceeds
    cap, an exact draw of cap from them."""
    counts = class_counts(df, label_col)
    n = sum(counts.values())
    if n <= cap:
        return df
    return _per_class_then_cap(df, counts, cap, label_col, seed, uid)


def class_quotas(df: DataFrame, label_col: str, quotas: dict) -> DataFrame:
    """Quota table (label, _q) of a dict class -> ascending positions."""
    kind = df.schema[label_col].dataType.simpleString()
    return df.sparkSession.createDataFrame([(k, [int(x) for x in v]) for k, v in quotas.items()],
                                           f"`{label_col}` {kind}, _q array<long>")


def _per_class_then_cap(df, counts, size, label_col, seed, uid):
    quotas = stratified_quota_sizes(counts, size)
    table = class_quotas(df, label_col, {k: [q] for k, q in quotas.items()})
    picked = hash_cuts(df, [label_col], table, sum(counts.values()), uid, seed, n_groups=len(quotas)).where(F.col("_cut") == 0).drop("_cut")
    if sum(quotas.values()) > size:
        return sample_exact_n(picked, size, seed, uid)
    return picked


def sample_fraction(df: DataFrame, fraction: float, label_col: str = "label", seed: int = 42,
                    uid="uid") -> DataFrame:
    """size = int(n * fraction), 0 < fraction < 1, same per-class rule as the cap."""
    if not (0 < fraction < 1):
        return df
    counts = class_counts(df, label_col)
    size = int(sum(counts.values()) * fraction)
    return _per_class_then_cap(df, counts, size, label_col, seed, uid)
