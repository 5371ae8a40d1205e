"""The minimum end-to-end slice used as ``entry()``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixtures
from ..functions import NetworkTrafficFeatures, label_normalize

FLAGSHIP_SQL = """
select label, count(*) as n, round(avg(bytes_per_sec), 6) as avg_bytes_per_sec
from (
  select case when label is null then 'unknown'
              when lower(label) = 'normal' then 'benign'
              when lower(label) in ('anomaly', 'attack') then 'malicious'
              else lower(label) end as label,
         coalesce(case when duration = 0 then null
                       else (orig_bytes + resp_bytes) / duration end, 0) as bytes_per_sec
  from flows) t
group by label
"""


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """flows -> label_normalize -> traffic features -> per-class count and mean bytes/sec."""
    f = fixtures.flows(spark, sf_dir).withColumn("label", label_normalize("label"))
    feats = NetworkTrafficFeatures(proto_vocabulary=[]).extract_features(f)
    return (feats.groupBy("label")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.round(F.avg("bytes_per_sec"), 6).alias("avg_bytes_per_sec")))
