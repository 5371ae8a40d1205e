"""edge cases of fit / transform."""

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from netsieve.operators.prep import Preprocessor, drop_null_target, medians, modes, vocabulary

SCHEMA = "uid string, a double, b double, c string, flag boolean, label string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_fit_edge_cases(spark):
    rows = [("u1", None, 1.0, None, None, "Normal"), ("u2", None, 1.0, "x", None, "attack"),
            ("u3", None, 1.0, "y", None, "ddos"), ("u4", None, 1.0, None, None, None)]
    m = Preprocessor("label", ["c", "flag"], ["a", "b"]).fit(frame(spark, rows))
    st = m.state
    assert st.medians["a"] == 0.0                       # all-null numeric -> 0
    assert st.modes["flag"] == "false"                  # all-null boolean -> False
    assert st.modes["c"] == "x"                         # tie x / y -> smallest
    assert st.divisors["b"] == 1.0                      # constant column
    assert st.labels == ["benign", "ddos", "malicious", "unknown"]
    out = m.transform(frame(spark, [("t1", float("inf"), 1.0, "zzz", True, "scan"),
                                    ("t2", None, None, None, None, "benign")]), keep=["uid"])
    got = {r["uid"]: (r["f"], r["label_idx"]) for r in
           out.select("uid", vector_to_array("features").alias("f"), "label_idx").collect()}
    f1, l1 = got["t1"]
    assert f1[0] == 0.0 and f1[1] == 0.0                # +inf -> 0; constant -> 0 after scaling
    assert f1[2:4] == [0.0, 0.0]                        # unseen category: all-zero block
    assert l1 == -1.0                                   # unseen label
    f2, l2 = got["t2"]
    assert f2[2:4] == [1.0, 0.0]                        # null category -> fitted mode 'x'
    assert l2 == 0.0


def test_drop_na_restores_when_all_null(spark):
    df = frame(spark, [("u1", 1.0, 1.0, "x", True, None), ("u2", 2.0, 1.0, "x", True, None)])
    out = drop_null_target(df, "label")
    assert [r["label"] for r in out.collect()] == ["unknown", "unknown"]
    df2 = frame(spark, [("u1", 1.0, 1.0, "x", True, "a"), ("u2", 2.0, 1.0, "x", True, None)])
    assert drop_null_target(df2, "label").count() == 1


def test_median_exact_and_skewed(spark):
    vals = [0.0] * 300 + [float(i) for i in range(1, 601)]      # a third of the rows equal
    df = spark.createDataFrame([(v, v * 2 if v else None) for v in vals], "x double, y double")
    got = {r["column_name"]: r["median"] for r in medians(df, ["x", "y"]).collect()}
    import statistics
    assert got["x"] == statistics.median(vals)
    assert got["y"] == statistics.median([v * 2 for v in vals if v])


@pytest.mark.parametrize("seed", range(6))
def test_median_matches_brute_force(spark, seed):
    import random
    import statistics
    rnd = random.Random(seed)
    n = rnd.randint(1, 80)
    pool = [float(rnd.randint(-5, 5)) for _ in range(4)] + [None, float("nan")]
    xs = [rnd.choice(pool) if rnd.random() < 0.5 else rnd.uniform(-100, 100) for _ in range(n)]
    ys = [float(rnd.randint(0, 3)) if i % 2 else None for i in range(n)]
    df = spark.createDataFrame(list(zip(xs, ys)), "x double, y double").repartition(5)
    got = {r["column_name"]: r["median"] for r in medians(df, ["x", "y"]).collect()}
    for c, vals in (("x", xs), ("y", ys)):
        clean = [v for v in vals if v is not None and not math.isnan(v)]
        if clean:
            assert got[c] == pytest.approx(statistics.median(clean), rel=1e-12, abs=1e-12)
        else:
            assert c not in got


def test_modes_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert modes(df, ["c"]).first()["mode"] == "a"


def test_transform_equals_fit_rows(spark):
    rows = [(f"u{i}", float(i % 7), float(i % 3), "xy"[i % 2], i % 2 == 0, "ab"[i % 3 == 0]) for i in range(50)]
    df = frame(spark, rows)
    m = Preprocessor("label", ["c", "flag"], ["a", "b"]).fit(df)
    a = {r["uid"]: r["f"] for r in m.transform(df, keep=["uid"]).select("uid", vector_to_array("features").alias("f")).collect()}
    b = {r["uid"]: r["f"] for r in m.transform(df.repartition(7), keep=["uid"]).select("uid", vector_to_array("features").alias("f")).collect()}
    assert a == b
    col_a = [x[0] for x in a.values()]
    assert abs(sum(col_a) / len(col_a)) < 1e-12       # scaled column has mean 0
    assert math.isclose(sum(x * x for x in col_a) / len(col_a), 1.0)   # population std 1


def test_vocabulary_of_an_id_column(spark):
    """A category per row: numbered completely and in order, by range partitions."""
    df = spark.range(5000).select(F.concat(F.lit("u"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("uid"),
                                  (F.col("id") % 3).cast("string").alias("c"))
    out = vocabulary(df, ["uid", "c"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    got = {(r["column_name"], r["category"]): r["idx"] for r in out.collect()}
    assert got == {**{("uid", f"u{i:05d}"): i for i in range(5000)}, **{("c", str(i)): i for i in range(3)}}


def test_median_of_hot_and_spread_values(spark):
    import statistics
    rows = [(float(i % 7 == 0) * 5.0 or 5.0 if i % 3 else float(i), float(i) if i % 4 else None, float("nan") if i % 2 else 1.5, None) for i in range(4001)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    got = {r["column_name"]: r["median"] for r in medians(df, ["a", "b", "c", "d"]).collect()}
    want = {"a": statistics.median(r[0] for r in rows), "b": statistics.median(r[1] for r in rows if r[1] is not None), "c": 1.5}
    assert got == want


@pytest.mark.parametrize("unknown", ["ignore", "error"])
def test_large_vocabularies_stay_distributed(spark, monkeypatch, tmpdir_path, unknown):
    """An id as category: encoded by a join, to the same vectors as from lists."""
    from netsieve.operators import prep
    from netsieve.operators.prep import PreprocessorModel
    df = spark.createDataFrame([(f"u{i:03d}", float(i), ["x", "y", None][i % 3], "a" if i % 2 else "b") for i in range(200)],
                               "uid string, a double, c string, label string").withColumn("id", F.col("uid"))
    def vectors(m, d):
        return sorted((r["uid"], r["label_idx"], list(r["f"])) for r in m.transform(d, keep=["uid"]).select(
            "uid", "label_idx", vector_to_array("features").alias("f")).collect())
    lists = Preprocessor("label", ["id", "c"], ["a"], handle_unknown=unknown).fit(df)
    monkeypatch.setattr(prep, "LIST_CATEGORIES", 50)
    tables = Preprocessor("label", ["id", "c"], ["a"], handle_unknown=unknown).fit(df)
    assert set(tables.state.tables) == {"id"} and "id" not in tables.state.vocab
    assert vectors(tables, df) == vectors(lists, df)
    assert {len(v[2]) for v in vectors(lists, df)} == {len(lists.feature_names())}
    tables.save(f"{tmpdir_path}/m", spark)
    again = PreprocessorModel.load(f"{tmpdir_path}/m", spark)
    new = df.withColumn("id", F.lit("new"))
    if unknown == "ignore":
        assert vectors(again, new) == vectors(lists, new)
    else:
        with pytest.raises(Exception):
            vectors(again, new)
    with pytest.raises(ValueError):
        tables.feature_names()


@pytest.mark.parametrize("limit", [10_000, 50])
def test_feature_table_and_long_onehot_of_any_size(spark, monkeypatch, limit):
    """Names and cells of the column form, also where a list of them is refused."""
    from netsieve.operators import prep
    df = spark.createDataFrame([(f"u{i:03d}", float(i), ["x", "y", None][i % 3], i % 2 == 0, "a" if i % 2 else "b") for i in range(200)],
                               "uid string, a double, c string, flag boolean, label string").withColumn("id", F.col("uid"))
    lists = Preprocessor("label", ["id", "c", "flag"], ["a"]).fit(df)
    names = lists.feature_names()
    wide = {(r["uid"], k) for r in lists.onehot_frame(df, ["uid"]).collect() for k, v in r.asDict().items() if k != "uid" and v == 1.0}
    monkeypatch.setattr(prep, "LIST_CATEGORIES", limit)
    m = Preprocessor("label", ["id", "c", "flag"], ["a"]).fit(df)
    table = m.feature_table(spark).orderBy("position").collect()
    assert [r["name"] for r in table] == names and [r["position"] for r in table] == list(range(len(names)))
    cells = m.onehot_long(df, ["uid"])
    assert {(r["uid"], r["name"]) for r in cells.collect()} == wide and cells.columns == ["uid", "position", "name", "value"]
    vec = {r["uid"]: list(r["f"]) for r in m.transform(df, keep=["uid"]).select("uid", vector_to_array("features").alias("f")).collect()}
    assert all(vec[r["uid"]][r["position"]] == 1.0 for r in cells.collect())
    assert m.onehot_long(df.withColumn("id", F.lit("new")).withColumn("c", F.lit("new")), ["uid"]).select("name").distinct().count() == 2


def test_only_the_parts_asked_for_are_fitted(spark):
    df = spark.createDataFrame([(float(i) if i % 3 else None, "x" if i % 2 else "y", "a") for i in range(30)], "n double, c string, label string")
    whole = Preprocessor("label", ["c"], ["n"]).fit(df).state
    num = Preprocessor("label", ["c"], ["n"]).fit(df, ["numeric"]).state
    cat = Preprocessor("label", ["c"], ["n"]).fit(df, ["categorical"]).state
    assert (num.means, num.divisors, num.medians) == (whole.means, whole.divisors, whole.medians) and not num.vocab and not num.labels
    assert cat.vocab == whole.vocab and cat.categorical == ["c"] and not cat.means and not cat.labels
    with pytest.raises(ValueError, match="unknown parts"):
        Preprocessor("label").fit(df, ["other"])
