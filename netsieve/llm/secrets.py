"""Operator 6, secret scans with multipart credential linking (DataFrame functions only).

Each kind of part is found by one regular expression; its places follow from the lengths of
the gaps and matches (``split`` and ``regexp_extract_all`` see the same matches).  Strong
parts are reported as they are.  Weak ones are joined by interval to the parts of the other
roles in their scope, the same document within SCOPE code points, and reported only where
complementary parts occur there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import prepare, row_key, stored

SCOPE = 400                      # code points between the starts of two parts
KEY_CHARS = 20                   # shortest weak secret: shorter tokens are too often words or dates

# fixed values: kind, role, weak, pattern
KINDS = [
    ("assign", "secret", False,
     r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", "identifier", False, r"AKIA[A-Z0-9]{12,}"),
    ("hex", "secret", False, r"[0-9a-f]{32,}"),
    ("login", "identifier", True, r"""(?i)(username|user|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""),
    ("key", "secret", True, r"[A-Za-z0-9+/_-]{%d,}={0,2}" % KEY_CHARS),
    ("endpoint", "endpoint", True, r"""(https?|ftp|sftp|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\x00-\x20"'<>]+"""),
]
ROLE = {k: r for k, r, _, _ in KINDS}
# what must be in scope of a weak part of each role
NEEDS = {"secret": ["identifier"], "identifier": ["secret"], "endpoint": ["identifier", "secret"]}


def _matches(kind: str, pattern: str) -> Column:
    """Array of (kind number, gap before, length, kept) of every match in ``text``."""
    p = F.lit(pattern)
    n = [k for k, *_ in KINDS].index(kind)
    whole = F.regexp_extract_all("text", p, F.lit(0))
    gaps = F.split("text", pattern, -1)
    value = F.regexp_extract_all("text", p, F.lit(2)) if kind == "assign" else whole

    def kept(m, v):
        if kind == "assign":
            return F.length(v) >= 8
        if kind == "key":                # a random-looking token
            return m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]")
        return F.lit(True)

    each = F.transform(F.arrays_zip(gaps.alias("g"), whole.alias("m"), value.alias("v")), lambda x: F.struct(
        F.lit(n).alias("k"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("len"),
        kept(x["m"], x["v"]).alias("kept")))
    return F.when(F.col("text").rlike(pattern), F.filter(each, lambda x: x["len"].isNotNull()))


def parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows ``doc_id, key``, parts ``key, k, start, end, kept``): ``key`` is null for a row
    without any match; rows that repeat in doc_id and text share a key and its parts."""
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    src = src.select("doc_id", "text", *[_matches(k, p).alias(f"m_{k}") for k, _, _, p in KINDS])
    some = F.coalesce(*[F.col(f"m_{k}") for k, *_ in KINDS]).isNotNull()
    rows = stored(src.select("doc_id", F.when(some, row_key("doc_id", "text")).alias("key"),
                             *[f"m_{k}" for k, *_ in KINDS]), "secret-rows")
    one = rows.where("key is not null").dropDuplicates(["key"])
    each = None
    for k, *_ in KINDS:
        e = one.select("key", F.posexplode(f"m_{k}").alias("i", "m")).select("key", "i", "m.k", "m.gap", "m.len", "m.kept")
        each = e if each is None else each.unionByName(e)
    run = Window.partitionBy("key", "k").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("len")).over(run)
    found = each.withColumn("end", end).select("key", "k", (F.col("end") - F.col("len")).alias("start"), "end", "kept").where("kept")
    return rows.select("doc_id", "key"), found.drop("kept")


def _named(k: str, of) -> Column:
    return F.element_at(F.array(*[F.lit(of(x)) for x in KINDS]), F.col(k) + 1)


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The parts to report: ``key, k, start, end``.

    Weak parts inside a strong one are dropped.  The interval join is an equi-join on cells
    of ``scope`` code points: per (key, cell, role) only the first and last start are kept, so
    a weak part meets at most three cells x roles, however many parts a cell holds."""
    f = found.withColumn("role", _named("k", lambda x: x[1])).withColumn("weak", _named("k", lambda x: x[2]))
    before = Window.partitionBy("key").orderBy("start", "weak").rowsBetween(Window.unboundedPreceding, -1)
    f = (f.withColumn("covered", F.coalesce(F.max(F.when(~F.col("weak"), F.col("end"))).over(before) >= F.col("end"), F.lit(False)))
         .where(~(F.col("weak") & F.col("covered"))).withColumn("cell", F.floor(F.col("start") / scope)))
    cells = (f.groupBy(F.col("key").alias("c_key"), F.col("cell").alias("c_cell"), F.col("role").alias("c_role"))
             .agg(F.min("start").alias("lo"), F.max("start").alias("hi")))
    probe = f.where("weak").withColumn("near", F.explode(F.array(*[F.col("cell") + d for d in (-1, 0, 1)])))
    met = (probe.join(cells, (F.col("key") == F.col("c_key")) & (F.col("near") == F.col("c_cell")))
           .where((F.col("role") != F.col("c_role")) & (F.col("lo") <= F.col("start") + scope) & (F.col("hi") >= F.col("start") - scope)))
    roles = met.groupBy("key", "k", "role", "start", "end").agg(F.collect_set("c_role").alias("roles"))
    enough = F.lit(False)
    for role, needs in NEEDS.items():
        ok = F.lit(True)
        for r in needs:
            ok = ok & F.array_contains("roles", r)
        enough = enough | ((F.col("role") == role) & ok)
    return f.where("not weak").select("key", "k", "start", "end").unionByName(roles.where(enough).select("key", "k", "start", "end"))


def secret_report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every whole text.

    Null texts are empty and have no spans; a span is kind:start:end in code points, end
    exclusive, by start and then kind; repeated rows get the same result each; an empty table
    gives an empty result; other columns are not read.  Only rows with a match are shuffled.
    """
    prepare(docs.sparkSession)
    rows, found = parts(docs)
    spans = linked(stored(found, "secret-parts"), scope)
    text = F.concat_ws(":", _named("k", lambda x: x[0]), F.col("start").cast("string"), F.col("end").cast("string"))
    listed = (spans.select("key", F.struct("start", "k", text.alias("t")).alias("s"))
              .groupBy("key").agg(F.array_sort(F.collect_list("s")).alias("s")))
    base = F.filter("s", lambda x: x["k"] < 3)

    def count(k):
        return F.size(F.filter("s", lambda x: x["k"] == k)).cast("long")

    def joined(a):
        return F.array_join(F.transform(a, lambda x: x["t"]), ",")

    by_key = listed.select(F.col("key").alias("s_key"), *[count(i).alias(f"n_{KINDS[i][0]}") for i in range(3)],
                           joined(base).alias("base"), joined(F.col("s")).alias("spans"))
    got = rows.where("key is not null").join(by_key, F.col("key") == F.col("s_key"), "left")
    zero, empty = F.lit(0).cast("long"), F.lit("")
    out = got.select("doc_id", *[F.coalesce(f"n_{KINDS[i][0]}", zero).alias(f"n_{KINDS[i][0]}") for i in range(3)],
                     F.sha2(F.coalesce("base", empty).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", empty).alias("spans"))
    none = rows.where("key is null").select("doc_id", *[zero.alias(f"n_{KINDS[i][0]}") for i in range(3)],
                                            F.sha2(empty.cast("binary"), 256).alias("base_sha256"), empty.alias("spans"))
    return out.unionByName(none)
