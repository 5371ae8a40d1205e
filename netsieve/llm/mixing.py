"""Operator 8, mixing sources to target weights by a low-discrepancy schedule.

Slot j of the mix has the golden-ratio point frac(j * phi), which falls into one source's
interval of the cumulative slot weights.  Slots are ranked per source; the k-th slot of a
source takes block k (modulo its blocks) of that source's documents, laid end to end in a
shuffled order and cut into blocks of equal words.  Everything is DataFrame expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from .common import prepare, stored

WEIGHTS = (5, 2, 1)              # by source in code-point order, repeating
SHARE = 1.5                      # of all words
MAX_REPEAT = 2                   # times a source's words
BLOCK_WORDS = 128
SEED = 17
# fixed values: golden-ratio conjugate, and the fraction of 2^20 times it
PHI = 0.6180339887498949
PHI_20 = 0.607787409740351
CELLS = 1024                     # of the interval join of points and sources
SLOT_CHUNK = 4_096               # slots ranked together
BUCKET_ROWS = 512                # documents ordered together
BROADCAST_SOURCES = 10_000


WORD = r"[^\x20\x09-\x0D]+"


def document_sizes(docs: DataFrame, keep=()) -> DataFrame:
    """``doc_id, source, size, key`` and ``keep``: words (runs of other than space and \\t..\\r) and the
    shuffle key of every document; null texts have size 0."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), F.lit(f"|{SEED}")))
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
                       .cast("long").alias("size"), key.alias("key"), *keep)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, block: int = BLOCK_WORDS) -> DataFrame:
    """One row a source: ``source, src, source_size, target, blocks, slots`` and the
    cumulative slot weights ``lo, hi``.

    Sources in code-point order (null last) weigh ``weights`` in turn and share ``share`` of
    all words; a target stops at MAX_REPEAT times its source and the excess goes to the
    others by weight, until none is above: with sources ordered by cap / weight, those
    capped are a prefix, and the rest get the remaining words in proportion.  This table has
    one row a source and is ordered in one task.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("src"), F.lit(len(weights))) + 1).cast("int"))
    t = (per.withColumn("src", F.row_number().over(order) - 1).withColumn("w", w)
         .withColumn("cap", F.col("source_size") * float(MAX_REPEAT)).withColumn("ratio", F.col("cap") / F.col("w")))
    by_ratio = Window.orderBy("ratio", "src")
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    t = (t.withColumn("goal", F.sum("source_size").over(every) * share)
         .withColumn("rate", (F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest))
         .withColumn("free", F.when(F.col("ratio") > F.col("rate"), F.col("rate")))
         # the first source that its share does not fill sets the level of all behind it
         .withColumn("level", F.first("free", ignorenulls=True).over(whole))
         .withColumn("target", F.when(F.col("level").isNull(), F.col("cap"))
                     .otherwise(F.least(F.col("cap"), F.col("level") * F.col("w"))))
         .withColumn("blocks", F.ceil(F.col("source_size") / float(block)).cast("long"))
         .withColumn("slots", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("blocks"))
                     .otherwise(F.lit(0.0))))
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("slots").over(every)
    return (t.withColumn("hi", F.coalesce(F.try_divide(F.sum("slots").over(run), total), F.lit(0.0)))
            .withColumn("lo", F.coalesce(F.lag("hi").over(order), F.lit(0.0)))
            .select("source", "src", "source_size", "target", "blocks", "slots", "lo", "hi"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_SOURCES else df


def slot_schedule(targets: DataFrame, n_slots: int, n_sources: int) -> DataFrame:
    """``slot, src, rank, block, epoch`` of every slot: the schedule of the mix.

    Points meet sources by an equi-join on cells of the unit interval.  Ranks come from
    counts per (source, chunk of slots) and positions inside a chunk, so a source with most
    slots is not ordered in one task.
    """
    spark = targets.sparkSession
    a, b = F.floor(F.col("slot") / F.lit(1 << 20)), F.col("slot") % F.lit(1 << 20)
    x = (a * F.lit(PHI_20)) % F.lit(1.0) + b * F.lit(PHI)
    points = (spark.range(n_slots).withColumnRenamed("id", "slot").withColumn("u", x - F.floor(x))
              .withColumn("cell", F.floor(F.col("u") * CELLS)))
    cells = (targets.where(F.col("hi") > F.col("lo"))
             .select("src", "blocks", "lo", "hi",
                     F.explode(F.sequence(F.floor(F.col("lo") * CELLS),
                                          F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1)))).alias("cell")))
    hit = (points.join(_small(cells, n_sources), "cell").where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")))
           .select("slot", "src", "blocks", F.floor(F.col("slot") / SLOT_CHUNK).alias("chunk")))
    counts = hit.groupBy("src", "chunk").agg(F.count(F.lit(1)).alias("n"))
    past = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offset = counts.select("src", "chunk", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("before"))
    inside = Window.partitionBy("src", "chunk").orderBy("slot")
    return (hit.withColumn("i", F.row_number().over(inside) - 1).join(offset, ["src", "chunk"])
            .withColumn("rank", F.col("before") + F.col("i"))
            .select("slot", "src", "rank", (F.col("rank") % F.col("blocks")).alias("block"),
                    F.floor(F.col("rank") / F.col("blocks")).alias("epoch")))


def document_places(sizes: DataFrame, targets: DataFrame, n_docs: int, n_sources: int) -> DataFrame:
    """Each document with its source's row and ``at``, its first word's place in the
    source's shuffled words.  Sums per (source, key bucket) give the offsets, so a hot source
    is ordered in buckets of about BUCKET_ROWS documents."""
    bits = min(28, max(0, math.ceil(math.log2(max(1, n_docs / BUCKET_ROWS)))))
    bucket = F.shiftright(F.conv(F.substring("key", 1, 7), 16, 10).cast("long"), 28 - bits)
    t = targets.select(F.col("source").alias("t_source"), "src", "source_size", "target")
    d = sizes.join(_small(t, n_sources), F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source").withColumn("bucket", bucket)
    sums = d.groupBy("src", "bucket").agg(F.sum("size").alias("n"))
    past = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = sums.select("src", "bucket", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("before"))
    inside = (Window.partitionBy("src", "bucket").orderBy("key", "size", "doc_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (d.withColumn("i", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offset, ["src", "bucket"])
            .withColumn("at", F.col("before") + F.col("i")).drop("i", "before", "bucket", "key"))


def mix_report(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, block: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of every document.

    ``taken`` counts the words that the schedule takes of it, repeats included: its overlap
    with each block of its source times the slots of that block.  Slots past MAX_REPEAT
    rounds of a source are void, so no document is taken more often.  Null texts have size 0
    and are taken 0 times; a null source is a source, last in order; repeated rows are
    separate documents; an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    sizes = stored(document_sizes(docs), "mix-sizes")
    targets = stored(source_targets(sizes, weights, share, block), "mix-targets")
    n_docs = sizes.count()
    n_sources, slots = targets.agg(F.count(F.lit(1)), F.sum("slots")).first()
    schedule = slot_schedule(targets, int(math.floor((slots or 0.0) + 0.5)), n_sources)
    times = schedule.where(F.col("epoch") < MAX_REPEAT).groupBy("src", "block").agg(F.count(F.lit(1)).alias("times"))
    placed = stored(document_places(sizes, targets, n_docs, n_sources), "mix-places")
    out = ["doc_id", "source", "size", "source_size", "target"]
    end = F.col("at") + F.col("size")
    piece = (placed.where(F.col("size") > 0)
             .withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((end - 1) / block))))
             .withColumn("words", F.least(end, (F.col("block") + 1) * block) - F.greatest(F.col("at"), F.col("block") * block)))
    taken = (piece.join(times, ["src", "block"], "left").groupBy("src", "at")
             .agg(*[F.first(c).alias(c) for c in out],
                  F.sum(F.col("words") * F.coalesce("times", F.lit(0))).cast("long").alias("taken")))
    empty = placed.where(F.col("size") == 0).select(*out, F.lit(0).cast("long").alias("taken"))
    return taken.select(*out, "taken").unionByName(empty)


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, block: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: ``slot, place, doc_id, source, n_words, text``, a row a piece of a document in a
    slot.

    Slots are joined to the blocks of equal words that :func:`slot_schedule` names for them; in order of
    slot and place (of a piece's first word in its block) the texts are the mix.  A piece is the words of
    a document that fall into a block, with single spaces between them, so the words taken of a document
    are those that :func:`mix_report` counts.  Null and empty texts have no piece; a null source is a
    source; repeated rows are separate documents; an empty table gives an empty result; other columns
    are not read.  Texts are cut before the join, which is on (source, block), so a hot source spreads
    over all tasks."""
    spark = docs.sparkSession
    prepare(spark)
    sizes = stored(document_sizes(docs, keep=("text",)), "mix-texts")
    targets = stored(source_targets(sizes, weights, share, block), "mix-targets")
    n_sources, slots = targets.agg(F.count(F.lit(1)), F.sum("slots")).first()
    schedule = (slot_schedule(targets, int(math.floor((slots or 0.0) + 0.5)), n_sources)
                .where(F.col("epoch") < MAX_REPEAT).select("slot", "src", "block"))
    placed = document_places(sizes, targets, sizes.count(), n_sources).where(F.col("size") > 0)
    end = F.col("at") + F.col("size")

    def piece(b):
        first = F.greatest(F.col("at"), b * block)
        n = (F.least(end, (b + 1) * block) - first).cast("int")
        return F.struct(b.alias("block"), (first - b * block).alias("place"), n.alias("n_words"),
                        F.array_join(F.slice("words", (first - F.col("at") + 1).cast("int"), n), " ").alias("text"))

    blocks = F.sequence(F.floor(F.col("at") / block), F.floor((end - 1) / block))
    pieces = (placed.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
              .select("src", "doc_id", "source", F.explode(F.transform(blocks, piece)).alias("p"))
              .select("src", "doc_id", "source", "p.*"))
    return (schedule.join(pieces, ["src", "block"])
            .select("slot", "place", "doc_id", "source", F.col("n_words").cast("long").alias("n_words"), "text"))
