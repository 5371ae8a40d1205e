"""The positional device equals a plain row_number, also with a hot key and any partitioning."""

import pytest
from pyspark.sql import Window, functions as F

from netsieve.operators.rank import positional_index, running_sums


def skewed(spark, n=3000):
    # a third of the rows share group 'hot' and order value 0
    rows = [(i, "hot" if i % 3 == 0 else f"g{i % 5}", 0 if i % 3 == 0 else i % 97) for i in range(n)]
    return spark.createDataFrame(rows, "id long, g string, v long")


def test_positional_equals_row_number(spark):
    df = skewed(spark)
    for parts in (1, 17):
        d = df.repartition(parts)
        got = positional_index(d, ["v", "id"], ["g"], n_groups=6, num_partitions=13)
        ref = d.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
        bad = got.join(ref, "id").where(F.col("_pos") != F.col("rn")).count()
        assert bad == 0


def test_global_position(spark):
    df = skewed(spark)
    got = positional_index(df, ["v", "id"], num_partitions=11)
    assert sorted(r["_pos"] for r in got.collect()) == list(range(1, 3001))


def test_running_sums(spark):
    df = skewed(spark).withColumn("w", (F.col("id") % 7).cast("long"))
    got = running_sums(df, [F.col("v").desc(), "id"], ["w"], ["g"], n_groups=6, num_partitions=9)
    ref = df.withColumn("rs", F.sum("w").over(Window.partitionBy("g").orderBy(F.col("v").desc(), "id")
                                              .rowsBetween(Window.unboundedPreceding, 0)))
    assert got.join(ref, "id").where(F.col("cum_w") != F.col("rs")).count() == 0


@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_running_sums_across_arrow_batches(spark, batch):
    """Groups that straddle Arrow batches and partitions, null group keys, double sums,
    and group totals."""
    prev = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        df = spark.range(0, 400).select(
            "id", F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise((F.col("id") % 3).cast("string")).alias("g"),
            ((F.col("id") * 7919) % 101).alias("v"), ((F.col("id") % 5) * 0.5).alias("w"),
            (F.col("id") % 4).cast("int").alias("c"))
        got = running_sums(df, ["v", "id"], ["w", "c"], ["g"], n_groups=4, num_partitions=5, total_prefix="tot_")
        w = Window.partitionBy("g").orderBy("v", "id")
        ref = df.select("id", F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rw"),
                        F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rc"),
                        F.sum("w").over(Window.partitionBy("g")).alias("tw"))
        j = got.join(ref, "id")
        assert j.count() == 400
        assert j.where((F.abs(F.col("cum_w") - F.col("rw")) > 1e-9) | (F.col("cum_c") != F.col("rc"))
                       | (F.abs(F.col("tot_w") - F.col("tw")) > 1e-9)).count() == 0
        assert dict(got.dtypes)["cum_c"] == "bigint"
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", prev)
