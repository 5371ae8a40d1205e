"""Per-file feature cache: a Parquet table partitioned by (extractor, file_key).

The key covers path, length, modification time and row cap, and the extractor part covers
the extractor's name and settings, so an edited file, a same-named file elsewhere, a new cap
or another setting never returns stale rows.  What depends on all files together (protocol
dummies) is not cached: it is derived after the read.  Only files missing from the manifest
are scanned and featurised; their partitions are written with dynamic partition overwrite (a
retried write replaces, never duplicates), then the manifest is appended.  Reads prune to the
wanted partitions.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.rank import BROADCAST_ROWS
from ..session import exists
from .files import _declared, infer, listed_path, plain_path, scan_flows


def file_keys(files: DataFrame, cap: int | None = None) -> DataFrame:
    """(path, file_key) for a discover_files() listing."""
    key = F.substring(F.sha2(F.concat_ws("|", F.col("path"), F.col("length").cast("string"),
                                         F.col("modificationTime").cast("string"),
                                         F.lit("" if cap is None else str(cap))), 256), 1, 24)
    return files.select("path", key.alias("file_key"))


def _sized(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def cached_features(spark: SparkSession, files: DataFrame, extractor, cache_root: str,
                    cap: int | None = None) -> DataFrame:
    """Features of ``files`` through ``extractor``, computing only cache misses.  Every scanned
    row must find its file's key; otherwise nothing is recorded and the run fails."""
    per_file = extractor.per_file()
    name = f"{extractor.name}-{hashlib.sha256(per_file.settings().encode()).hexdigest()[:12]}"
    manifest_path = f"{cache_root}/_manifest"
    data_path = f"{cache_root}/data"
    keys = file_keys(files, cap)
    missing = keys
    if exists(spark, manifest_path):
        have = spark.read.parquet(manifest_path).where(F.col("extractor") == name).select("file_key")
        missing = keys.join(have, "file_key", "left_anti")
    todo = [r["path"] for r in missing.select("path").collect()]       # the paths a scan is given
    if todo:
        # columns without a declared type are kept as text: files of later runs may hold other values
        raw = scan_flows(spark, todo, infer=False, cap=cap)
        feats = per_file.extract_features(raw.drop("_block"))
        by_path = missing.select(listed_path("path").alias("_kp"), "file_key")
        out = feats.join(_sized(by_path, len(todo)), plain_path("file_path") == F.col("_kp"), "left").drop("_kp")
        lost = F.raise_error(F.concat(F.lit("no cache key for "), F.col("file_path")))
        out = out.withColumn("file_key", F.when(F.col("file_key").isNotNull(), F.col("file_key")).otherwise(lost)) \
                 .withColumn("extractor", F.lit(name))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("extractor", "file_key").parquet(data_path))
        (missing.select(F.lit(name).alias("extractor"), "file_key", "path").write.mode("append").parquet(manifest_path))
    wanted = keys.select("file_key").distinct()
    got = spark.read.option("mergeSchema", "true").parquet(data_path).where(F.col("extractor") == name)
    got = got.join(_sized(wanted, keys.count()), "file_key", "left_semi")
    own = {"label", "file_path", "file_name", "row_id", "extractor", "file_key"}
    got = infer(got, [c for c in got.columns if c not in own and _declared(c) is None])
    return extractor.across_files(got)
