"""Connection-log CSV files.

Scans read every column as STRING and cast per cell with ``try_cast`` (a bad token is a
null, never a lost file).  Files are grouped by their header line and each group is read
with its own schema: a CSV schema binds by position, so one schema over files with
different headers would silently shift columns.  Groups are unioned by name.

Quoting is the usual one: a doubled quote inside quotes is a quote, and a line break inside
quotes belongs to its field.  Files with such line breaks are found by their quotes and read
through :mod:`records`; all others by Spark's CSV reader.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.coerce import duration_seconds
from ..functions.labels import category_from_filename, label_from_filename, label_normalize
from ..operators.rank import BROADCAST_ROWS
from ..session import checkpoint_root, exists
from . import records as rec
from .csv_source import BOM, HeadsSource, LeadingSource, blank, fields, reachable, reader

# Declared column types of a connection-log record (source header names).
DECLARED_TYPES = {
    "uid": "string",
    "id.orig_h": "string",
    "id.orig_p": "int",
    "id.resp_h": "string",
    "id.resp_p": "int",
    "proto": "string",
    "service": "string",
    "duration": "duration",
    "orig_bytes": "double",
    "resp_bytes": "double",
    "conn_state": "string",
    "local_orig": "boolean",
    "local_resp": "boolean",
    "missed_bytes": "double",
    "history": "string",
    "orig_pkts": "double",
    "orig_ip_bytes": "double",
    "resp_pkts": "double",
    "resp_ip_bytes": "double",
    "tunnel_parents": "string",
    "label": "string",
    "detailed-label": "string",
    "ts": "double",
}
# Sub-folders searched when the data folder itself holds no match.
FALLBACK_SUBDIRS = ["data", "IoT-23", "IoT-23-Max", "data/data/IoT-23-Max"]
EXTRA = "_extra"


def canonical_name(name: str) -> str:
    """Trimmed header name with dots and dashes as underscores (ML assemblers reject dots)."""
    return name.strip().replace(".", "_").replace("-", "_")


_BY_CANONICAL = {canonical_name(k): v for k, v in DECLARED_TYPES.items()}


def _declared(name: str) -> str | None:
    """Declared type of a header name, dotted or underscored; None if it has none."""
    return _BY_CANONICAL.get(canonical_name(name))


def _cast(col: F.Column, kind: str) -> F.Column:
    if kind == "duration":
        return duration_seconds(col)
    if kind in ("string", None):
        return col
    return col.try_cast(kind)


# ------------------------------------------------------------------ discovery

def _list(spark: SparkSession, folder: str, pattern: str) -> DataFrame | None:
    """Files of a folder that match, or None; only a missing folder counts as nothing there."""
    if not exists(spark, folder):
        return None
    df = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
          .option("recursiveFileLookup", "false").load(folder).select("path", "length", "modificationTime"))
    return df if df.take(1) else None


def discover_files(spark: SparkSession, data_path: str, pattern: str = "*.csv",
                   num_files: int | None = None) -> DataFrame:
    """(path, length, modificationTime), sorted by path.  A single .csv path is itself;
    otherwise a non-recursive glob of the folder, else of the first fallback sub-folder
    with matches.  The listing is a ``binaryFile`` scan pruned to metadata (no content)."""
    empty = spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    base = data_path.rstrip("/")
    if base.lower().endswith(".csv"):
        found = _list(spark, base.rsplit("/", 1)[0] or "/", base.rsplit("/", 1)[-1])
    else:
        found = _list(spark, base, pattern)
        if found is None:
            for sub in FALLBACK_SUBDIRS:
                found = _list(spark, f"{base}/{sub}", pattern)
                if found is not None:
                    break
    if found is None:
        return empty
    found = found.orderBy("path")
    return found.limit(num_files) if num_files is not None else found


def plain_path(col) -> F.Column:
    """One form of a path, whether listed (raw) or from ``_metadata`` (percent-encoded)."""
    decoded = F.try_url_decode(F.replace(F.col(col), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "/")


def listed_path(col) -> F.Column:
    return F.regexp_replace(F.col(col), "^file:/+", "/")


def file_inventory(files: DataFrame) -> DataFrame:
    """(filename, path, size_mb, category): one row per file."""
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("filename"), "path",
                        F.round(F.col("length") / F.lit(1024.0 * 1024.0), 2).alias("size_mb"),
                        category_from_filename(name).alias("category"))


# ------------------------------------------------------------------ scans

HEADS_BY_DRIVER = 64             # headers read by the driver itself; more are read in tasks


def read_header(spark: SparkSession, path: str) -> list[str] | None:
    """Fields of the first record of a file through the cluster's file system (a read of its first
    lines); None for an empty file."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        held = b""
        while (line := lines.readLine()) is not None:
            held += line.encode()
            if held.startswith(BOM):
                held = held[len(BOM):]
            if blank(held):
                held = b""
            elif held.count(b'"') % 2 == 0:
                return fields(held)
            else:
                held += b"\n"
        return fields(held) if held else None
    finally:
        stream.close()


def _group_by_header(spark: SparkSession, paths) -> dict:
    """Files grouped by header: of a few files the driver reads them (concurrently, one small read a
    file), of many the tasks of a data source do."""
    paths = list(paths)
    if len(paths) > HEADS_BY_DRIVER and all(reachable(p) for p in paths):
        found = {r["path"]: r["header"] for r in reader(spark, HeadsSource, paths).select("path", "header").collect()}
        heads = [found[p] for p in paths]
    else:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=min(32, max(1, len(paths)))) as pool:
            heads = list(pool.map(lambda p: read_header(spark, p), paths))
    groups: dict = {}
    for p, head in zip(paths, heads):
        if head is not None:       # else an empty file: nothing to read
            groups.setdefault(tuple(head), []).append(p)
    return groups


def literal(path: str) -> str:
    """A path whose name holds glob characters, as a path to read."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def column_names(raw_names) -> list[str]:
    """Canonical names of a header's columns; a name that is taken (also by the columns a scan adds)
    gets the next free number behind it, as ``name_1``."""
    out: list[str] = []
    taken = {"file_path", "file_name", "_block", "row_id"}
    for raw in raw_names:
        name = first = canonical_name(raw)
        n = 0
        while name.lower() in taken:
            n += 1
            name = f"{first}_{n}"
        taken.add(name.lower())
        out.append(name)
    return out


META = ("_metadata.file_path", "_metadata.file_name", "_metadata.file_block_start")


def _typed(df: DataFrame, raw_names, with_label: bool, meta=META, line=None) -> DataFrame:
    """Trim/rename, cast per declared type, add file columns, a row id and the label.
    ``meta`` names the columns holding file path, file name and split start.  ``row_id`` (file,
    split, number of the row) tells any two rows of one scan apart and needs no id column.  The
    number is ``line``, or by default counted by the task: the same on every read of a listing with
    the same split sizes, but not to be stored and compared with that of another scan."""
    cols = []
    for i, (raw, name) in enumerate(zip(raw_names, column_names(raw_names))):
        cols.append(_cast(F.col(f"_c{i}"), _declared(raw)).alias(name))
    number = F.monotonically_increasing_id() if line is None else F.col(line)
    row_id = F.concat_ws("#", F.col(meta[0]), F.col(meta[2]).cast("string"), number.cast("string"))
    out = df.select(*cols, F.col(meta[0]).alias("file_path"), F.col(meta[1]).alias("file_name"),
                    F.col(meta[2]).alias("_block"), row_id.alias("row_id"))
    if with_label:
        if "label" in out.columns:
            out = out.withColumn("label", label_normalize("label"))
        else:
            out = out.withColumn("label", label_from_filename("file_name"))
    return out


def infer_undeclared(df: DataFrame, names) -> DataFrame:
    """Type the undeclared columns of a scan, as the reference's reader infers them: numbers
    if every value is one, else true / false if every value is, else text (one aggregate over
    those columns; a column without values stays text)."""
    return infer(df, [c for n, c in zip(names, column_names(names)) if _declared(n) is None])


def infer(df: DataFrame, cols) -> DataFrame:
    """Text columns typed by their values (see :func:`infer_undeclared`)."""
    cols = [c for c in cols if dict(df.dtypes).get(c) == "string"]
    if not cols:
        return df
    flags = ("true", "false")
    checks = [F.struct(F.count(c).alias("n"), F.count(F.col(c).try_cast("double")).alias("num"),
                       F.count_if(F.lower(F.trim(F.col(c))).isin(*flags)).alias("flag")).alias(c) for c in cols]
    row = df.agg(*checks).first()
    kind = {}
    for c in cols:
        r = row[c]
        if r["n"]:
            kind[c] = "double" if r["num"] == r["n"] else "boolean" if r["flag"] == r["n"] else None
    return df.select(*[F.trim(F.col(c)).try_cast(kind[c]).alias(c) if kind.get(c) else F.col(c) for c in df.columns])


CSV = {"mode": "PERMISSIVE", "quote": '"', "escape": '"'}


def _text_schema(n: int) -> StructType:
    return StructType([StructField(f"_c{i}", StringType()) for i in range(n)] + [StructField(EXTRA, StringType())])


def _read_group(spark: SparkSession, paths, n: int, header: bool) -> DataFrame:
    df = (spark.read.schema(_text_schema(n)).option("header", str(header).lower()).option("enforceSchema", "true")
          .options(**CSV).csv([literal(p) for p in paths]))
    # a row with more fields than the header is dropped (its surplus lands in _extra);
    # a shorter row is null-padded and kept
    return df.where(F.col(EXTRA).isNull())


def parsed(rows: DataFrame, n: int, keep, header=None, value: str = "value") -> DataFrame:
    """``_c0 ...`` and the columns ``keep`` of CSV records given as text; records that are blank, hold
    surplus fields, or equal ``header`` at the beginning of a file are left out."""
    text = F.regexp_replace(F.col(value), "\r$", "")
    names = [f"_c{i}" for i in range(n)]
    ddl = ", ".join(f"{c} string" for c in [*names, EXTRA])
    # inline: a record is parsed once, not again by the tests below and by each reader of a column
    out = (rows.where(F.trim(text) != "").select(F.inline(F.array(F.from_csv(text, ddl, {**CSV, "multiLine": "true"}))), *keep)
           .where(F.col(EXTRA).isNull()))
    if header is not None:
        same = F.lit(True)
        for c, h in zip(names, header):
            same &= F.col(c).eqNullSafe(F.lit(h if h != "" else None))
        out = out.where(~(same & (F.col(keep[2]) == 0)))
    return out.drop(EXTRA)


def _broken(spark: SparkSession, paths):
    """(paths of files with line breaks inside quotes, quote counts of the splits of all)."""
    paths = list(paths)
    if not paths:
        return [], None
    checkpoint_root(spark)
    counts = rec.quote_counts(rec.read_lines(spark, [literal(p) for p in paths])).checkpoint()
    found = {r["p"] for r in counts.where("odd > 0").select(plain_path("_path").alias("p")).distinct().collect()}
    return [p for p in paths if "/" + p.removeprefix("file:").lstrip("/") in found or p in found], counts


def _read_broken(spark: SparkSession, paths, counts: DataFrame, names, label: bool, header: bool) -> DataFrame:
    """A header group of files with line breaks inside quotes, read in splits."""
    rows = rec.records(rec.read_lines(spark, [literal(p) for p in paths]), counts)
    rows = parsed(rows, len(names), [*rec.LINE_META, "line"], names if header else None)
    return _typed(rows, names, label, rec.LINE_META, "line")


def scan_flows(spark: SparkSession, paths, label: bool = True, infer: bool = True, cap: int | None = None,
               quoted_breaks: bool = True) -> DataFrame:
    """Headered CSV files -> typed DataFrame (+ file_path, file_name, _block, row_id).  Columns
    without a declared type are inferred per header group unless ``infer`` is off.

    With ``cap`` only the first ``cap`` rows of every file are read (see :func:`scan_leading`).  Line
    breaks inside quotes are looked for by one count of quotes over the files; where no field can
    hold any (connection logs do not), ``quoted_breaks=False`` spares that pass."""
    paths = list(paths)
    if cap is not None and all(reachable(p) for p in paths):
        return scan_leading(spark, paths, cap, label, infer)
    broken, counts = _broken(spark, paths) if quoted_breaks else ([], None)
    parts = []
    for names, ps in sorted(_group_by_header(spark, paths).items(), key=lambda kv: kv[1][0]):
        part = None
        if plain := [p for p in ps if p not in broken]:
            part = _typed(_read_group(spark, plain, len(names), True), names, label)
        if torn := [p for p in ps if p in broken]:
            more = _read_broken(spark, torn, counts, names, label, True)
            part = more if part is None else part.unionByName(more)
        parts.append(infer_undeclared(part, names) if infer else part)
    out = _union(parts)
    return out if cap is None else row_cap_per_file(out, cap)


def _union(parts) -> DataFrame:
    if not parts:
        raise ValueError("no readable CSV file")
    out = parts[0]
    for p in parts[1:]:
        out, p = _same_types(out, p)
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def scan_leading(spark: SparkSession, paths, cap: int, label: bool = True, infer: bool = True) -> DataFrame:
    """The first ``cap`` rows of every headered CSV file, typed as by :func:`scan_flows`: one task a
    file, which stops reading at the cap."""
    parts = []
    for names, ps in sorted(_group_by_header(spark, paths).items(), key=lambda kv: kv[1][0]):
        rows = reader(spark, LeadingSource, ps, width=len(names), cap=cap, header=True)
        uri = F.create_map(*[F.lit(x) for p in ps for x in (p, quote(p, safe="/:~!$&'()*+,;=@-._"))]) if len(ps) <= 1000 else None
        path = F.element_at(uri, F.col("path")) if uri is not None else F.col("path")
        rows = rows.select(*[f"_c{i}" for i in range(len(names))], path.alias("_path"),
                           F.element_at(F.split("path", "/"), -1).alias("_name"), F.lit(0).cast("long").alias("_block"), "line")
        part = _typed(rows, names, label, rec.LINE_META, "line")
        parts.append(infer_undeclared(part, names) if infer else part)
    return _union(parts)


def _same_types(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cast columns whose types differ between header groups to text in both."""
    ta, tb = dict(a.dtypes), dict(b.dtypes)
    odd = {c for c in ta if c in tb and ta[c] != tb[c]}
    if not odd:
        return a, b
    return tuple(d.select(*[F.col(c).cast("string").alias(c) if c in odd else F.col(c) for c in d.columns]) for d in (a, b))


def peek(spark: SparkSession, paths, n: int = 5, label: bool = True) -> DataFrame:
    """The first ``n`` rows of the first file (in path order); reading stops there."""
    return scan_flows(spark, [min(paths)], label, infer=False, cap=n).limit(n)


def scan_headerless(spark: SparkSession, paths, names, label: bool = True, quoted_breaks: bool = True) -> DataFrame:
    """CSV without a header row; ``names`` name the columns in order."""
    paths = list(paths)
    broken, counts = _broken(spark, paths) if quoted_breaks else ([], None)
    plain = [p for p in paths if p not in broken]
    parts = [_typed(_read_group(spark, plain, len(names), False), names, label)] if plain else []
    if broken:
        parts.append(_read_broken(spark, broken, counts, names, label, False))
    return _union(parts)


# ------------------------------------------------------------------ per-file row cap

def row_cap_per_file(df: DataFrame, cap: int, path_col: str = "file_path",
                     block_col: str = "_block") -> DataFrame:
    """At most ``cap`` leading rows of each file of a whole scan, in file order (where files can be
    opened by tasks, :func:`scan_leading` reads no more than these).

    A file split is read in order by one task, so within a split the scan-time
    ``monotonically_increasing_id`` is consecutive.  One aggregate per (file, split)
    gives first id and count; a running sum over the splits of a file (a table of splits,
    not rows) gives offsets; position = offset + id - first id + 1.  No shuffle of the
    rows: the statistics are checkpointed and joined back (broadcast when the number of
    splits is small).  The scan is deterministic, so both reads number rows alike.
    """
    tagged = df.withColumn("_rc_id", F.monotonically_increasing_id())
    stats = (tagged.groupBy(path_col, block_col)
             .agg(F.min("_rc_id").alias("_rc_first"), F.count(F.lit(1)).alias("_rc_n")))
    before = Window.partitionBy(path_col).orderBy(block_col).rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(F.col(path_col).alias("_rc_path"), F.col(block_col).alias("_rc_block"), "_rc_first",
                         F.coalesce(F.sum("_rc_n").over(before), F.lit(0)).alias("_rc_off"))
    checkpoint_root(df.sparkSession)
    stats = stats.checkpoint(eager=True)
    n_splits = stats.count()
    if n_splits <= BROADCAST_ROWS:
        stats = F.broadcast(stats)
    j = tagged.join(stats, (F.col(path_col) == F.col("_rc_path")) & (F.col(block_col) == F.col("_rc_block")))
    pos = F.col("_rc_off") + F.col("_rc_id") - F.col("_rc_first") + F.lit(1)
    return j.where(pos <= F.lit(cap)).select(*df.columns)
