"""Exact quotas and splits from a few threshold keys, without moving rows.

A sampler or split compares each row's position in an order with one or a few quotas.  It is
enough to know the *keys* at those positions; every row is then labelled by comparing its own
key, a plain expression over the scan.  Keys at positions come from one narrow aggregate and
one narrow ordered pass:

* hash order (md5(uid | seed), uid), per group: rows are counted per (group, hash prefix);
  running sums over that small table name the prefix that holds a position, and only the
  rows of those prefixes are ordered;
* value order (value, uid): approximate percentiles bracket the position, rows below the
  bracket are counted, and only (value, uid) of the rows inside it are ordered.

No wide column is shuffled or persisted, and no group is ordered in one task.  The unique
tie-break ``uid`` may be several columns.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from ..session import checkpoint_root
from .rank import BROADCAST_ROWS, positional_index

PREFIX_ROWS = 4096          # aimed rows per (group, hash prefix)
MAX_PREFIX_DIGITS = 5       # hex digits: at most 2^20 prefixes a group
BRACKET = 5e-4              # half width of a percentile bracket, as a share of the rows
ACCURACY = 10_000           # percentile_approx: rank error 1e-4, inside the bracket


def id_columns(uid) -> list[str]:
    return [uid] if isinstance(uid, str) else list(uid)


def id_text(uid) -> F.Column:
    """One text of the id columns (a null differs from every text)."""
    cols = id_columns(uid)
    if len(cols) == 1:
        return F.coalesce(F.col(cols[0]).cast("string"), F.lit("\u0000"))
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols])


def hash_key(uid, seed: int) -> F.Column:
    """md5(uid | seed); the same text in DuckDB for a single id column."""
    return F.md5(F.concat(id_text(uid), F.lit(f"|{seed}")))


def _not_unique(uid, text) -> ValueError:
    return ValueError(f"rows on both sides of a quota share the id {text!r} of {id_columns(uid)}: exact counts "
                      "need ids that differ (row_id of a scan, or more columns)")


def _sized(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def _on(groups, left="", right="_g"):
    cond = F.lit(True)
    for i, g in enumerate(groups):
        cond = cond & F.col(g).eqNullSafe(F.col(f"{right}{i}"))
    return cond


def hash_cuts(df: DataFrame, groups, quotas: DataFrame, n_rows: int, uid="uid", seed: int = 42,
              cut_col: str = "_cut", n_groups: int | None = None) -> DataFrame:
    """Add ``cut_col``: how many of its group's quotas a row's position exceeds.

    ``quotas`` has the group columns and ``_q``, an ascending array of positions (rows of a
    group without quotas get null).  Positions are by (md5(uid | seed), uid) inside a group;
    Rows that share an id are not told apart: where a quota falls between them ValueError is raised.
    ``n_rows`` (the rows of ``df``) only sets how finely hashes are counted; ``n_groups`` is
    the rows of ``quotas``, where the caller has them at hand.
    """
    groups = list(groups)
    gs = [F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]
    names = [f"_g{i}" for i in range(len(groups))]
    digits = min(MAX_PREFIX_DIGITS, max(0, math.ceil(math.log(max(1, n_rows / PREFIX_ROWS), 16))))
    keyed = df.select(*gs, hash_key(uid, seed).alias("_h"), id_text(uid).alias("_u"))
    keyed = keyed.withColumn("_b", F.substring("_h", 1, digits) if digits else F.lit(""))
    checkpoint_root(df.sparkSession)
    q = quotas.select(*gs, "_q")
    if n_groups is None:
        q = q.checkpoint(eager=True)
        n_groups = q.count()
    count = keyed.groupBy(*names, "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*names).orderBy("_b"))
    count = count.withColumn("_to", upto).withColumn("_from", F.col("_to") - F.col("_n"))
    want = q.select(*[F.col(n).alias(f"w{n}") for n in names], F.posexplode("_q").alias("_i", "_k"))
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"w{n}"))
    # one row per (group, quota) at most
    held = (count.join(_sized(want, n_groups), same & (F.col("_from") < F.col("_k")) & (F.col("_k") <= F.col("_to")))
            .select(*[F.col(n).alias(f"w{n}") for n in names], F.col("_b").alias("w_b"), "_i", (F.col("_k") - F.col("_from")).alias("_r"))
            .checkpoint(eager=True))
    inside = keyed.join(_sized(held, n_groups), same & (F.col("_b") == F.col("w_b")))
    order = Window.partitionBy(*names, "_b", "_i").orderBy("_h", "_u")
    shared = F.lead(F.struct("_h", "_u")).over(order) == F.struct("_h", "_u")
    found = (inside.withColumn("_rn", F.row_number().over(order)).withColumn("_s", F.coalesce(shared, F.lit(False)))
             .where(F.col("_rn") == F.col("_r"))
             .groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct("_i", F.struct("_h", "_u").alias("key")))).alias("_t"),
                                  F.max(F.when(F.col("_s"), F.col("_u"))).alias("_tie")))
    same_q = F.lit(True)
    for n in names:
        same_q = same_q & F.col(n).eqNullSafe(F.col(f"w{n}"))
    table = (q.select(*[F.col(n).alias(f"w{n}") for n in names], "_q").join(found, same_q, "left")
             .select(*[F.col(f"w{n}").alias(n) for n in names], "_q", "_t", "_tie").checkpoint(eager=True))
    tie = table.where("_tie is not null").first()
    if tie is not None:
        raise _not_unique(uid, tie["_tie"])
    table = table.drop("_tie")
    mine = F.struct(hash_key(uid, seed).alias("_h"), id_text(uid).alias("_u"))
    past = F.aggregate(F.transform("_q", lambda k, i: F.when(k <= 0, F.lit(1)).when(
        mine > F.try_element_at(F.col("_t"), i.cast("int")), F.lit(1)).otherwise(F.lit(0))), F.lit(0), lambda a, b: a + b)
    cond = _on(groups) if groups else F.lit(True)
    if not groups:                                   # one group: its thresholds are literals
        row = table.first()
        if row is None:
            return df.withColumn(cut_col, F.lit(None).cast("int"))
        t = row["_t"] or {}
        cut = F.lit(0)
        for i, k in enumerate(row["_q"]):
            if k <= 0:
                cut = cut + F.lit(1)
            elif i in t:
                cut = cut + (mine > F.struct(F.lit(t[i]["_h"]).alias("_h"), F.lit(t[i]["_u"]).alias("_u"))).cast("int")
        return df.withColumn(cut_col, cut)
    return (df.join(_sized(table, n_groups), cond, "left").withColumn(cut_col, past).drop(*names, "_q", "_t"))


def _literal(value, dtype) -> F.Column:
    return F.lit(value).cast(dtype)


def value_thresholds(df: DataFrame, value: F.Column, positions, uid="uid"):
    """Keys ``(is null, value, uid)`` at the 1-based ``positions`` of the order (value
    ascending, nulls last, uid).  A position below 1 or beyond the rows gives None.  ValueError where
    the row at a position and the next one share value and uid."""
    d = df.select(value.alias("_v"), id_text(uid).alias("_u"))
    n, n_known = d.agg(F.count(F.lit(1)), F.count("_v")).first()
    asked = sorted({k for k in positions if 1 <= k <= n})
    out: dict = {}
    known = [k for k in asked if k <= n_known]
    if known:
        shares = [(max(0.0, k / n_known - BRACKET), min(1.0, k / n_known + BRACKET)) for k in known]
        flat = [p for s in shares for p in s]
        at = d.agg(F.percentile_approx("_v", flat, ACCURACY).alias("p")).first()["p"]
        lo, hi = at[0::2], at[1::2]
        dtype = d.schema["_v"].dataType
        below = d.agg(*[F.count_if(F.col("_v") < _literal(v, dtype)).alias(f"c{i}") for i, v in enumerate(lo)]).first()
        # the brackets are ordered side by side; a row may lie in several
        member = F.array_compact(F.array(*[F.when(F.col("_v").between(_literal(lo[i], dtype), _literal(hi[i], dtype)), F.lit(i))
                                           for i in range(len(known))]))
        inside = d.select("_v", "_u", F.explode(member).alias("_i"))
        ranked = positional_index(inside, ["_v", "_u"], ["_i"], n_groups=len(known), pos_col="_p")
        hit = F.lit(False)
        for i, k in enumerate(known):
            hit = hit | ((F.col("_i") == i) & F.col("_p").between(k - below[i], k - below[i] + 1))
        found = {(r["_i"], r["_p"]): r for r in ranked.where(hit).collect()}
        for i, k in enumerate(known):
            row, after = (found.get((i, k - below[i] + j)) for j in (0, 1))
            if row is None:                          # outside its bracket: order all values
                every = positional_index(d.where("_v is not null"), ["_v", "_u"], pos_col="_p")
                at = {r["_p"]: r for r in every.where(F.col("_p").between(k, k + 1)).collect()}
                row, after = at[k], at.get(k + 1)
            if after is not None and (after["_v"], after["_u"]) == (row["_v"], row["_u"]):
                raise _not_unique(uid, row["_u"])
            out[k] = (False, row["_v"], row["_u"])
    nulls = [k for k in asked if k > n_known]
    if nulls:
        ranked = positional_index(d.where("_v is null").select("_u"), ["_u"], pos_col="_p")
        at = {r["_p"]: r["_u"] for r in ranked.where(F.col("_p").isin(sorted({k - n_known + j for k in nulls for j in (0, 1)}))).collect()}
        for k in nulls:
            if at.get(k - n_known + 1) == at[k - n_known]:
                raise _not_unique(uid, at[k - n_known])
            out[k] = (True, None, at[k - n_known])
    return n, out


def beyond(value: F.Column, uid, key, dtype) -> F.Column:
    """Whether a row comes after ``key`` in the order of :func:`value_thresholds`."""
    if key is None:
        return F.lit(False)
    is_null, v, u = key
    t = id_text(uid)
    if is_null:
        return value.isNull() & (t > F.lit(u))
    c = _literal(v, dtype)
    return value.isNull() | (value > c) | ((value == c) & (t > F.lit(u)))
