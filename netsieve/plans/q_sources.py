"""Catalog: file discovery, inventory, CSV scans, row caps, union, cache, peek.

Each query first writes the flows fixture as CSV files (Spark job, shared folder) and then
runs the source operator over them; the oracle reads the same rows from the parquet."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..functions import CompositeFeatures, NetworkTrafficFeatures, TimeBasedFeatures
from ..session import scratch_dir
from ..sources import cache, files
from ..sources.fixture_csv import CSV_COLUMNS, FILE_RE, SHARDS, SOURCE_NAMES, write_csv_files
from .catalog import register
from .q_features import NORM_SQL

F1 = ("flows",)
OUT = CSV_COLUMNS
_OUT_SQL = ", ".join(c if c != "label" else f"{NORM_SQL} as label" for c in OUT)


_SHARD_SQL = f"cast(concat('0x', substr(md5(uid), 1, 6)) as bigint) % {SHARDS}"


def _csv_dir(spark, sf, tag, **kw):
    return write_csv_files(spark, fixtures.flows(spark, sf), tag, **kw)


def _paths(spark, d):
    return [r["path"] for r in files.discover_files(spark, d).collect()]


@register("src_discover_files", f"select concat(source_file, '_', {_SHARD_SQL}, '.csv') as filename from flows group by 1", F1)
def q_src_discover_files(spark, sf):
    """*.csv files of a folder (non-recursive), sorted by path."""
    d = _csv_dir(spark, sf, "discover")
    lst = files.discover_files(spark, d)
    return lst.select(F.element_at(F.split("path", "/"), -1).alias("filename"))


@register("src_file_inventory", f"select concat(source_file, '_', {_SHARD_SQL}, '.csv') as filename, 'unknown' as category, "
          "count(*) as n_rows from flows group by 1", F1)
def q_src_file_inventory(spark, sf):
    """One row per file: name and category from the name, with the rows scanned from its path
    (sizes in MB depend on how numbers are written and are checked in the tests)."""
    d = _csv_dir(spark, sf, "inventory")
    inv = files.file_inventory(files.discover_files(spark, d))
    rows = files.scan_flows(spark, _paths(spark, d)).groupBy("file_path").agg(F.count(F.lit(1)).alias("n_rows"))
    return (inv.join(rows, files.listed_path("path") == files.plain_path("file_path"))
            .select("filename", "category", "n_rows"))


@register("src_scan_flows", f"select {_OUT_SQL} from flows", F1)
def q_src_scan_flows(spark, sf):
    """Headered CSV scan: STRING read, names canonicalised, per-cell try_cast, label normalised."""
    d = _csv_dir(spark, sf, "scan")
    return files.scan_flows(spark, _paths(spark, d)).select(*OUT)


@register("src_scan_headerless", f"select {_OUT_SQL} from flows", F1)
def q_src_scan_headerless(spark, sf):
    """CSV without a header row, columns named by the caller."""
    d = _csv_dir(spark, sf, "headerless", header=False)
    names = [SOURCE_NAMES.get(c, c) for c in CSV_COLUMNS]
    return files.scan_headerless(spark, _paths(spark, d), names).select(*OUT)


@register("src_row_cap_per_file", f"""
select uid, source_file from (
  select uid, source_file, row_number() over (partition by source_file, {_SHARD_SQL} order by uid) as pos from flows) t
where pos <= 1000""", F1)
def q_src_row_cap_per_file(spark, sf):
    """The first 1,000 rows of every file, in file order; reading stops there."""
    d = _csv_dir(spark, sf, "rowcap")
    capped = files.scan_flows(spark, _paths(spark, d), cap=1000)
    return capped.select("uid", F.regexp_replace("file_name", FILE_RE, "").alias("source_file"))


@register("src_union_files", """
select uid, source_file, proto,
       case when source_file = 'capture-3' then null else service end as service,
       case when source_file = 'capture-3' then null else history end as history
from flows""", F1)
def q_src_union_files(spark, sf):
    """Files with two different headers, unioned by name (absent columns null)."""
    d = _csv_dir(spark, sf, "union", drop={"capture-3": ["service", "history"]})
    scan = files.scan_flows(spark, _paths(spark, d))
    return scan.select("uid", F.regexp_replace("file_name", FILE_RE, "").alias("source_file"),
                       "proto", "service", "history")


_CACHE_SQL = f"""
select uid, {NORM_SQL} as label,
  round(coalesce(orig_bytes + resp_bytes, 0), 6) as total_bytes,
  round(coalesce((orig_bytes + resp_bytes) / nullif(duration, 0), 0), 6) as bytes_per_sec,
  round(coalesce((orig_pkts + resp_pkts) / nullif(duration, 0), 0), 6) as pkts_per_sec,
  cast(coalesce(proto = 'udp', false) as int) as proto_udp,
  cast(hour(make_timestamp(cast(ts * 1000000 as bigint))) as int) as hour,
  cast(isodow(make_timestamp(cast(ts * 1000000 as bigint))) in (6, 7) as int) as is_weekend
from flows"""


@register("src_feature_cache", _CACHE_SQL, F1)
def q_src_feature_cache(spark, sf):
    """Features per file through the cache, filled in two steps: first the files of two
    captures, then all (the others are computed, the first read); protocol dummies cover the
    values of all files."""
    d = _csv_dir(spark, sf, "cache")
    listing = files.discover_files(spark, d)
    ex = CompositeFeatures([NetworkTrafficFeatures(), TimeBasedFeatures()])
    root = scratch_dir(spark, "feature-cache")
    cache.cached_features(spark, listing.where(F.col("path").rlike("capture-[01]_")), ex, root)
    got = cache.cached_features(spark, listing, ex, root)
    return got.select("uid", "label", *[F.round(c, 6).alias(c) for c in
                                        ("total_bytes", "bytes_per_sec", "pkts_per_sec")],
                      "proto_udp", "hour", "is_weekend")


@register("src_peek", f"select {_OUT_SQL} from flows where source_file = 'capture-0' and {_SHARD_SQL} = 0 order by uid limit 5", F1)
def q_src_peek(spark, sf):
    """The first five rows of the first file."""
    d = _csv_dir(spark, sf, "peek")
    return files.peek(spark, _paths(spark, d)).select(*OUT)


@register("src_skip_bad_lines", "select uid, proto, service from flows where mod(cast(substr(uid, 2) as bigint), 5) <> 0 "
          "union all select uid, proto, service from flows where mod(cast(substr(uid, 2) as bigint), 10) = 0", F1)
def q_src_skip_bad_lines(spark, sf):
    """Lines with a surplus field are skipped, unless the surplus field is empty.  The stand-in
    file gives every tenth flow an empty surplus field and every other fifth one a filled one."""
    n = F.substring("uid", 2, 20).cast("long")
    value = lambda c: F.coalesce(F.col(c), F.lit(""))
    line = F.concat_ws(",", "uid", value("proto"), value("service"))
    line = F.when(n % 10 == 0, F.concat(line, F.lit(","))).when(n % 5 == 0, F.concat(line, F.lit(",surplus"))).otherwise(line)
    path = scratch_dir(spark, "bad-lines")
    flows = fixtures.flows(spark, sf)
    flows.select(line.alias("value")).write.text(path)
    names = ["uid", "proto", "service"]
    paths = [r["path"] for r in files.discover_files(spark, path, "part-*").collect()]
    return files.scan_headerless(spark, paths, names).select(*names)


_QUOTED_SQL = """'say "' || history || '", ' || chr(10) || chr(10) || uid || chr(10) || '"' """


@register("src_scan_quoted", f"select uid, {_QUOTED_SQL} as history, proto, orig_bytes from flows", F1)
def q_src_scan_quoted(spark, sf):
    """CSV whose quoted fields hold quotes, commas and line breaks, read in splits."""
    text = F.concat(F.lit('say "'), F.col("history"), F.lit('", \n\n'), F.col("uid"), F.lit('\n"'))
    d = write_csv_files(spark, fixtures.flows(spark, sf).withColumn("history", text), "quoted",
                        columns=["uid", "history", "proto", "orig_bytes"])
    return files.scan_flows(spark, _paths(spark, d)).select("uid", "history", "proto", "orig_bytes")
