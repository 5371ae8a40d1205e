"""Class-count aggregates: per class, per (file, class) with totals and the minority count."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def class_distribution(df: DataFrame, label_col: str = "label") -> DataFrame:
    """(label, n): rows per class, null labels excluded."""
    return (df.where(F.col(label_col).isNotNull()).groupBy(label_col)
              .agg(F.count(F.lit(1)).alias("n")))


def class_counts_by_file(df: DataFrame, file_col: str = "source_file",
                         label_col: str = "label") -> DataFrame:
    """(file, label, n, label_total, min_class_total).

    The (file, label) aggregate is partial-then-final (map-side combine); the totals are
    a window per class over that small result (files x classes rows), not over the data; the
    smallest total is one number.
    """
    per = (df.where(F.col(label_col).isNotNull()).groupBy(file_col, label_col)
             .agg(F.count(F.lit(1)).alias("n")))
    totals = per.withColumn("label_total", F.sum("n").over(Window.partitionBy(label_col)))
    least = totals.agg(F.min("label_total")).first()[0]
    return totals.withColumn("min_class_total", F.lit(least).cast("long"))
