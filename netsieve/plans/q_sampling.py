"""Catalog: samplers and splits."""

from __future__ import annotations

from .. import fixtures
from ..functions import label_normalize
from ..operators import sampling, split
from .catalog import register
from .q_features import NORM_SQL

F1 = ("flows",)
H = "md5(uid || '|42')"
NF = f"(select uid, source_file, ts, {NORM_SQL} as label from flows)"


def _nflows(spark, sf):
    return fixtures.flows(spark, sf).select("uid", "source_file", "ts",
                                            label_normalize("label").alias("label"))


@register("sample_balanced", f"""
with f as {NF},
c as (select label, count(*) as cnt from f group by label),
q as (select min(cnt) // (select count(distinct source_file) from f) + 1 as quota from c)
select uid, source_file, label from (
  select uid, source_file, label,
         row_number() over (partition by source_file, label order by {H}, uid) as pos from f) r
where pos <= (select quota from q)""", F1)
def q_sample_balanced(spark, sf):
    """Per (file, class): min(available, smallest class total // files + 1) rows."""
    return sampling.sample_balanced(_nflows(spark, sf)).select("uid", "source_file", "label")


def _cap_sql(size_expr):
    return f"""
with f as {NF},
c as (select label, count(*) as cnt from f group by label),
s as (select {size_expr} as size from (select sum(cnt) as n from c) t),
q as (select label, greatest(1, cast(floor(cast((select size from s) * cnt as double)
          / (select sum(cnt) from c)) as bigint)) as quota from c),
picked as (select uid, label from (
  select uid, label, row_number() over (partition by label order by {H}, uid) as pos from f) r
  join q using (label) where pos <= quota)
select uid, label from picked
where (select sum(quota) from q) <= (select size from s)
   or uid in (select uid from picked order by {H}, uid limit (select size from s))"""


@register("sample_stratified_cap", _cap_sql("1000"), F1)
def q_sample_stratified_cap(spark, sf):
    """Cap at 1,000 rows keeping class proportions: max(1, int(cap * n_c / n)) per class."""
    return sampling.sample_stratified_cap(_nflows(spark, sf), 1000).select("uid", "label")


@register("sample_fraction", _cap_sql("cast(floor(n * cast(0.25 as double)) as bigint)"), F1)
def q_sample_fraction(spark, sf):
    """25% of the rows, class proportions kept (same per-class rule as the cap)."""
    return sampling.sample_fraction(_nflows(spark, sf), 0.25).select("uid", "label")


@register("sample_exact_n", f"select uid, label from {NF} f order by {H}, uid limit 500", F1)
def q_sample_exact_n(spark, sf):
    """A uniform draw of exactly 500 rows under the hash order."""
    return sampling.sample_exact_n(_nflows(spark, sf), 500).select("uid", "label")


@register("split_time", """
with r as (select uid, row_number() over (order by ts asc nulls last, uid) as pos,
                  count(*) over () as n from flows),
s as (select *, cast(floor(cast(n as double) * (1 - cast(0.15 as double))) as bigint) as test_start from r)
select uid, case when pos <= cast(floor(cast(test_start as double) * (1 - cast(0.15 as double))) as bigint)
                 then 'train' when pos <= test_start then 'val' else 'test' end as split
from s""", F1)
def q_split_time(spark, sf):
    """Time order: 72.25% train, 12.75% val, last 15% test (global positions, skew-safe)."""
    return split.split_time(fixtures.flows(spark, sf), "ts").select("uid", "split")


_P = "cast(0.15 as double)"


@register("split_stratified", f"""
with f as {NF},
c as (select label, count(*) as cnt from f group by label),
a as (select label, cnt, sum(cnt) over () as n from c),
b as (select *, n - cast(ceil({_P} * n) as bigint) as n_tr from a),
d as (select *, floor(cast(cnt * n_tr as double) / n) as fl,
             cast(cnt * n_tr as double) / n - floor(cast(cnt * n_tr as double) / n) as rem from b),
e as (select *, n_tr - sum(fl) over () as need, row_number() over (order by rem desc, label) as rr from d),
g as (select label, cnt, cast(fl + case when rr <= need then 1 else 0 end as bigint) as tv from e),
h as (select label, cnt, tv, sum(tv) over () as n2 from g),
i as (select *, n2 - cast(ceil(({_P} / (1 - {_P})) * n2) as bigint) as n_tr2 from h),
j as (select *, floor(cast(tv * n_tr2 as double) / n2) as fl2,
             cast(tv * n_tr2 as double) / n2 - floor(cast(tv * n_tr2 as double) / n2) as rem2 from i),
k as (select *, n_tr2 - sum(fl2) over () as need2, row_number() over (order by rem2 desc, label) as rr2 from j),
q as (select label, cnt - tv as n_test,
             tv - cast(fl2 + case when rr2 <= need2 then 1 else 0 end as bigint) as n_val from k),
r as (select uid, label, row_number() over (partition by label order by {H}, uid) as pos from f)
select r.uid, r.label, case when pos <= n_test then 'test' when pos <= n_test + n_val then 'val'
                            else 'train' end as split
from r join q on r.label = q.label""", F1)
def q_split_stratified(spark, sf):
    """Stratified 70/15/15: per-class sizes by largest remainder, rows by hash order."""
    return split.split_stratified(_nflows(spark, sf), "label").select("uid", "label", "split")
