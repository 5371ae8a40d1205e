"""A Spark ML forest never gets a partition of more than FOREST_ROWS rows (about)."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from netsieve.operators import models as M


def test_partitions_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(M, "FOREST_ROWS", 100, raising=False)
    seen = []
    monkeypatch.setattr(M._SparkML, "fit", lambda self, df, *a: seen.append(df))
    df = spark.range(0, 1000, 1, 2).select(array_to_vector(F.array(F.col("id").cast("double"))).alias("features"), F.lit(0.0).alias("label_idx"))
    forest = M.RandomForest(n_estimators=2, max_depth=2)
    forest.fit(df)
    assert seen[0].rdd.getNumPartitions() == 10 and seen[0].count() == 1000
    assert forest._estimator(0).getCacheNodeIds() is False
