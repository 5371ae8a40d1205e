"""Writes the flows fixture as connection-log CSV files (SHARDS files per capture, by a hash
of uid), the stand-in input of the scan queries.  Files go to a fresh folder under the shared
checkpoint folder; each file is sorted by uid, so file order is reproducible in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_dir

# canonical column -> source header name
SOURCE_NAMES = {"id_orig_h": "id.orig_h", "id_orig_p": "id.orig_p",
                "id_resp_h": "id.resp_h", "id_resp_p": "id.resp_p"}
CSV_COLUMNS = ["uid", "ts", "id_orig_h", "id_orig_p", "id_resp_h", "id_resp_p", "proto", "service",
               "duration", "orig_bytes", "resp_bytes", "conn_state", "local_orig", "local_resp",
               "missed_bytes", "history", "orig_pkts", "orig_ip_bytes", "resp_pkts", "resp_ip_bytes", "label"]


SHARDS = 2                       # files per capture; raise it with the data
FILE_RE = r"_\d+\.csv$"          # what a file name adds to its capture's name


def shard(uid="uid") -> F.Column:
    """File number of a row inside its capture."""
    return F.pmod(F.conv(F.substring(F.md5(F.col(uid)), 1, 6), 16, 10).cast("long"), F.lit(SHARDS))


def _fs(spark, path):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def write_csv_files(spark: SparkSession, flows: DataFrame, tag: str, header: bool = True,
                    drop: dict | None = None, columns=None) -> str:
    """flows -> <dir>/<source_file>_<shard>.csv; ``drop`` maps a source file to columns it lacks."""
    columns = list(columns or CSV_COLUMNS)
    out_dir = scratch_dir(spark, tag)
    stage = f"{out_dir}/_stage"
    drop = drop or {}
    groups = [(None, [])] + [(k, v) for k, v in drop.items()]
    keys = ["source_file", "_shard"]
    for i, (src, missing) in enumerate(groups):
        part = flows.where(~F.col("source_file").isin(list(drop))) if src is None \
            else flows.where(F.col("source_file") == src)
        cols = [F.col(c).alias(SOURCE_NAMES.get(c, c)) for c in columns if c not in missing]
        (part.withColumn("_shard", shard()).select(*keys, *cols).repartition(*keys)
             .sortWithinPartitions(*keys, "uid")
             .write.option("header", str(header).lower()).option("escape", '"').partitionBy(*keys).csv(f"{stage}/g{i}"))
    _, fs = _fs(spark, stage)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for st in fs.globStatus(path(f"{stage}/g*/source_file=*/_shard=*/part-*.csv")):
        at = st.getPath()
        name = f"{at.getParent().getParent().getName().split('=', 1)[1]}_{at.getParent().getName().split('=', 1)[1]}.csv"
        if not fs.rename(at, path(f"{out_dir}/{name}")):
            raise OSError(f"cannot rename {at} to {name}: a second part file of one shard?")
    return out_dir
