"""Train / validation / test splits with exact sizes.

Both splits need only small driver-side arithmetic (sizes from one count or one
class-count aggregate); rows are assigned by comparing keys with thresholds (threshold.py).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from .sampling import class_quotas
from .threshold import beyond, hash_cuts, value_thresholds


def time_split_sizes(n: int, val_size: float = 0.15, test_size: float = 0.15):
    """(val_start, test_start): train = positions [1, val_start], val = (val_start, test_start]."""
    test_start = int(n * (1 - test_size))
    val_start = int(test_start * (1 - val_size))
    return val_start, test_start


def _time_key(df: DataFrame, ts_col: str):
    dt = df.schema[ts_col].dataType
    if isinstance(dt, StringType):      # text times are parsed; unparseable ones sort last
        return F.coalesce(F.col(ts_col).try_cast("double"),
                          F.unix_micros(F.try_to_timestamp(F.col(ts_col))) / F.lit(1e6))
    if isinstance(dt, NumericType):
        return F.col(ts_col).cast("double")
    return F.col(ts_col)


def split_time(df: DataFrame, ts_col: str, val_size: float = 0.15, test_size: float = 0.15,
               tiebreak="uid", split_col: str = "split") -> DataFrame:
    """Sort by (time, tiebreak), nulls last; first rows train, then val, last test.  The two
    threshold keys are found first; rows are labelled by comparison, without moving."""
    key = _time_key(df, ts_col)
    n = df.count()
    val_start, test_start = time_split_sizes(n, val_size, test_size)
    _, at = value_thresholds(df, key, [val_start, test_start], tiebreak)
    dtype = df.select(key.alias("k")).schema["k"].dataType

    def after(k):
        return F.lit(n > 0) if k < 1 else beyond(key, tiebreak, at.get(k), dtype)

    label = (F.when(after(test_start), F.lit("test")).when(after(val_start), F.lit("val"))
             .otherwise(F.lit("train")))
    return df.withColumn(split_col, label)


# ---------------------------------------------------------------- stratified

def approximate_mode(counts: dict, n_draws: int) -> dict:
    """Per-class draws summing to n_draws: floor of the proportional share, then one more
    for the largest remainders (ties by class name)."""
    total = sum(counts.values())
    cont = {k: (v * n_draws) / total for k, v in counts.items()}
    floored = {k: math.floor(v) for k, v in cont.items()}
    need = n_draws - sum(floored.values())
    order = sorted(counts, key=lambda k: (-(cont[k] - floored[k]), k))
    for k in order[:max(need, 0)]:
        floored[k] += 1
    return floored


def stratified_sizes(counts: dict, test_size: float):
    """(train, test) per class, as a stratified shuffle split allocates them: train first
    (approximate mode of the class counts), test from what is left."""
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    if n_train < len(counts) or n_test < len(counts):
        raise ValueError("each part must hold at least one row per class")
    if min(counts.values()) < 2:
        raise ValueError("the least populated class has fewer than 2 members")
    tr = approximate_mode(counts, n_train)
    te = approximate_mode({k: counts[k] - tr[k] for k in counts}, n_test)
    return tr, te


def stratified_quotas(counts: dict, val_size: float = 0.15, test_size: float = 0.15) -> dict:
    """class -> (n_test, n_val): test from the whole, val as val/(1-test) of the rest."""
    _, te = stratified_sizes(counts, test_size)
    rest = {k: counts[k] - te[k] for k in counts}
    _, va = stratified_sizes(rest, val_size / (1 - test_size))
    return {k: (te[k], va[k]) for k in counts}


def split_stratified(df: DataFrame, target: str, val_size: float = 0.15, test_size: float = 0.15,
                     seed: int = 42, uid="uid", split_col: str = "split") -> DataFrame:
    """Per class, in hash order md5(uid|seed): first n_test rows test, next n_val val, rest
    train; two threshold keys a class decide, so no row is moved."""
    counts = {r[0]: int(r[1]) for r in df.groupBy(target).count().collect()}
    if None in counts:
        raise ValueError("stratify target has nulls")
    quotas = stratified_quotas(counts, val_size, test_size)
    table = class_quotas(df, target, {k: [t, t + v] for k, (t, v) in quotas.items()})
    cut = hash_cuts(df, [target], table, sum(counts.values()), uid, seed, n_groups=len(counts))
    names = F.array(F.lit("test"), F.lit("val"), F.lit("train"))
    return cut.withColumn(split_col, F.element_at(names, F.col("_cut") + 1)).drop("_cut")
