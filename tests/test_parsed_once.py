"""A CSV record given as text is parsed once, whatever tests and columns follow."""

from netsieve.sources.files import parsed


def test_parsed_once(spark):
    lines = [("uid,label,orig_pkts", "f", 0), ("a,benign,3", "f", 0), ("b,\"x, y\",4\r", "f", 0), ("  ", "f", 0),
             ("c,z,5,surplus", "f", 0), ("uid,label,orig_pkts", "f", 9), ("d", "f", 9)]
    rows = spark.createDataFrame(lines, "value string, path string, block long").repartition(1)
    out = parsed(rows.withColumn("name", rows.path), 3, ["path", "name", "block"], ["uid", "label", "orig_pkts"])
    assert sorted((r[0], r[1] or "", r[2] or "") for r in out.select("_c0", "_c1", "_c2").collect()) == [
        ("a", "benign", "3"), ("b", "x, y", "4"), ("d", "", ""), ("uid", "label", "orig_pkts")]
    plan = out.where("_c1 <> 'q'").select("_c0", "_c1", "_c2")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("\n\n")[0].count("from_csv(") == 1
