"""The configured run end to end on CSV files."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from netsieve import fixtures
from netsieve.plans.q_stream import SIG_COLS
from netsieve.plans.training import run_training
from netsieve.sources.fixture_csv import write_csv_files


def test_run_training(spark, tmpdir_path):
    d = write_csv_files(spark, fixtures.flows_signal(spark, SF001), "train-run", columns=SIG_COLS)
    cfg = {
        "data": {"path": d, "balance_classes": True, "max_rows": 500},
        "features": {"categorical_columns": ["proto", "conn_state"],
                     "numerical_columns": ["orig_pkts", "resp_pkts", "resp_bytes", "duration", "orig_bytes",
                                           "total_bytes", "bytes_per_sec"]},
        "training": {"output_dir": f"file:{tmpdir_path}/models",
                     "models": {"random_forest": {"n_estimators": 10}, "logistic_regression": {"max_iter": 50},
                                "knn": {"enabled": False}, "gmm": {"enabled": False}}},
    }
    out = run_training(spark, cfg)
    s = out["summary"].collect()
    assert {r["model"] for r in s} == {"random_forest", "logistic_regression", "gaussian_nb"}
    assert all(r["accuracy"] is not None for r in s)
    n = sum(r["count"] for r in out["splits"].collect())
    assert 0 < n <= 500
    rep = out["report"].where(F.col("class") == "accuracy").count()
    assert rep == 3


def test_run_training_without_ids(spark, tmpdir_path):
    """Files without an id column, with repeated rows: the scan's row id tells rows apart."""
    import os
    import random
    rng = random.Random(3)
    for f in range(2):
        with open(os.path.join(tmpdir_path, f"f{f}.csv"), "w") as out:
            out.write("proto,orig_bytes,resp_bytes,label\n")
            for _ in range(150):
                bad = rng.random() < 0.4
                out.write(f"{rng.choice(['tcp', 'udp'])},{rng.randrange(90, 99) if bad else rng.randrange(9)},1,{'malicious' if bad else 'benign'}\n")
    cfg = {"data": {"path": tmpdir_path, "balance_classes": False},
           "features": {"extractors": ["network_traffic"], "categorical_columns": ["proto"], "numerical_columns": ["orig_bytes", "resp_bytes"]},
           "training": {"output_dir": f"file:{tmpdir_path}/models", "hyperparameter_tuning": True, "param_grids": {"knn": {"n_neighbors": [1, 3]}},
                        "models": {"random_forest": {"enabled": False}, "logistic_regression": {"enabled": False}, "gmm": {"enabled": False}}}}
    out = run_training(spark, cfg)
    assert sum(r["count"] for r in out["splits"].collect()) == 300
    assert {r["model"]: r["accuracy"] for r in out["summary"].collect()}.keys() == {"knn", "gaussian_nb"}
    assert out["tuning"]["knn"].count() == 2
    assert {r["model"] for r in out["confusion"].collect()} == {"knn", "gaussian_nb"}
    assert {r["class"] for r in out["roc"].select("class").distinct().collect()} == {f"{m}/{c}" for m in ("knn", "gaussian_nb") for c in ("0.0", "1.0")}


def test_user_extractor_by_name(spark):
    from netsieve.functions.composite import FeatureExtractor
    from netsieve.plans import training as T

    class Doubled(FeatureExtractor):
        name = "doubled"

        def extract_features(self, df):
            return df.withColumn("twice", df["id"] * 2)

    try:
        T.register_extractor("doubled", Doubled)
        assert T.build_extractor(["doubled"]).extract_features(spark.range(3)).agg({"twice": "sum"}).first()[0] == 6
    finally:
        T.EXTRACTORS.pop("doubled", None)
    with pytest.raises(ValueError, match="unknown extractors"):
        T.build_extractor(["network_traffic", "doubled"])
    with pytest.raises(TypeError):
        T.register_extractor("x", 3)


def test_grid_for_an_unknown_model_raises(spark):
    frame = fixtures.flows_signal(spark, SF001)
    cfg = {"training": {"hyperparameter_tuning": True, "param_grids": {"forrest": {"n_estimators": [5]}}, "models": {}},
           "features": {"categorical_columns": ["proto"], "numerical_columns": ["duration"]}}
    with pytest.raises(ValueError, match="unknown models"):
        run_training(spark, cfg, frame)
