"""Catalog: class counts and null counts."""

from __future__ import annotations

from .. import fixtures
from ..functions import label_normalize
from ..operators.aggregates import class_counts_by_file, class_distribution
from ..operators.prep import null_counts
from .catalog import register
from .q_features import NORM_SQL

F1 = ("flows",)


def _norm_flows(spark, sf):
    f = fixtures.flows(spark, sf)
    return f.withColumn("label", label_normalize("label"))


@register("agg_class_distribution",
          f"select label, count(*) as n from (select {NORM_SQL} as label from flows) t group by label", F1)
def q_agg_class_distribution(spark, sf):
    """Rows per (normalised) class."""
    return class_distribution(_norm_flows(spark, sf))


@register("agg_class_counts_by_file", f"""
select source_file, label, n, sum(n) over (partition by label) as label_total,
       min(label_total) over () as min_class_total
from (select source_file, label, n, sum(n) over (partition by label) as label_total
      from (select source_file, {NORM_SQL} as label, count(*) as n from flows group by 1, 2) a) b
""", F1)
def q_agg_class_counts_by_file(spark, sf):
    """Counts per (file, class), class totals and the minority-class total."""
    return class_counts_by_file(_norm_flows(spark, sf))


_NULL_COLS = ["uid", "source_file", "ts", "id_orig_h", "id_orig_p", "id_resp_h", "id_resp_p", "proto",
              "service", "duration", "orig_bytes", "resp_bytes", "conn_state", "local_orig",
              "local_resp", "missed_bytes", "history", "orig_pkts", "orig_ip_bytes", "resp_pkts",
              "resp_ip_bytes", "label"]


@register("agg_null_counts", "select column_name, n_null from (" + " union all ".join(
    f"select '{c}' as column_name, count(*) - count({c}) as n_null from flows" for c in _NULL_COLS)
    + ") t where n_null > 0", F1)
def q_agg_null_counts(spark, sf):
    """Nulls per column, only columns that have any (one aggregate pass)."""
    return null_counts(fixtures.flows(spark, sf))
