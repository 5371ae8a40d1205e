"""Streams over mixed headers and failing batches; the feature cache under odd names."""

import os

import pytest
from pyspark.sql import functions as F

from netsieve.functions import CompositeFeatures, NetworkTrafficFeatures
from netsieve.operators import rank
from netsieve.sources import files
from netsieve.sources.cache import cached_features
from netsieve.streaming import batch_moments, merged_moments, stream_file_batches, stream_fit_snapshots
from netsieve.streaming.batches import run_batches


def write(d, name, *lines):
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_mixed_headers_in_one_stream(spark, tmpdir_path):
    write(tmpdir_path, "a.csv", "uid,label,proto", "1,benign,tcp", "2,ddos,udp")
    write(tmpdir_path, "b c.csv", "uid,proto,label", "3,tcp,benign", "4,tcp,ddos,extra", "5,udp,")
    got = {r["label"]: r["n"] for r in stream_file_batches(spark, tmpdir_path, 2).groupBy("label").agg(F.sum("n").alias("n")).collect()}
    assert got == {"benign": 2, "ddos": 1, "unknown": 1}


def test_failed_batches_are_reported_and_others_raise(spark, tmpdir_path):
    for i in range(3):
        write(tmpdir_path, f"f{i}.csv", "uid,label", f"{i},x")

    def refuse(df, batch_id):
        if batch_id == 1:
            raise ValueError("long reason " * 500)
        return df.select("uid")

    from netsieve.session import scratch_dir
    status = {r["batch_id"]: r for r in run_batches(spark, tmpdir_path, refuse, scratch_dir(spark, "t") + "/out", batch_files=1).collect()}
    assert [status[i]["status"] for i in range(3)] == ["ok", "failed", "ok"]
    assert len(status[1]["error"]) > 6000                    # kept whole

    def broken(df, batch_id):
        raise OSError("store is gone")

    with pytest.raises(Exception):
        run_batches(spark, tmpdir_path, broken, scratch_dir(spark, "t") + "/out", batch_files=1)


def test_moments_skip_nulls(spark):
    a = spark.createDataFrame([("x", 1.0), ("x", None), ("x", None)], "label string, v double")
    b = spark.createDataFrame([("x", 10.0), ("y", None)], "label string, v double")
    got = merged_moments(batch_moments(a, ["v"]).unionByName(batch_moments(b, ["v"]))).collect()
    assert [(r["label"], r["n"], r["mean"], r["var"]) for r in got] == [("x", 2, 5.5, 20.25)]


def test_snapshots_release_their_frames(spark, tmpdir_path):
    rank.release()
    for i in range(2):
        write(tmpdir_path, f"f{i}.csv", "uid,label,orig_bytes", *[f"{i}_{k},{'a' if k % 3 else 'b'},{k}" for k in range(60)])
    out = stream_fit_snapshots(spark, tmpdir_path, {"gaussian_nb": {}}, [], ["orig_bytes"], batch_files=1)
    assert out.count() == 2 and not rank._PERSISTED


def features(spark, d, root, **kw):
    return cached_features(spark, files.discover_files(spark, d), CompositeFeatures([NetworkTrafficFeatures(**kw)]), root)


def test_cache_with_odd_names_and_a_later_protocol(spark, tmpdir_path):
    from netsieve.session import scratch_dir
    root = scratch_dir(spark, "cache-test")
    write(tmpdir_path, "plain.csv", "uid,proto,orig_bytes,resp_bytes", "1,tcp,1,2")
    write(tmpdir_path, "a b%20c+d#e.csv", "uid,proto,orig_bytes,resp_bytes", "2,tcp,1,2", "3,tcp,,2")
    assert sorted(r["uid"] for r in features(spark, tmpdir_path, root).collect()) == ["1", "2", "3"]
    write(tmpdir_path, "later.csv", "uid,proto,orig_bytes,resp_bytes", "4,udp,1,2")
    got = {r["uid"]: (r["proto_tcp"], r["proto_udp"]) for r in features(spark, tmpdir_path, root).collect()}
    assert got == {"1": (1, 0), "2": (1, 0), "3": (1, 0), "4": (0, 1)}
    # other settings of the same extractor have their own rows
    kept = {r["uid"]: r["orig_bytes"] for r in features(spark, tmpdir_path, root, fill_zero=False).collect()}
    assert kept["3"] is None and {r["uid"]: r["orig_bytes"] for r in features(spark, tmpdir_path, root).collect()}["3"] == 0.0


def test_types_of_underscored_and_undeclared_columns(spark, tmpdir_path):
    write(tmpdir_path, "a.csv", "uid,id_orig_p,score,flag,note", "1,80,1.5,true,x", "2,443,,false,7")
    df = files.scan_flows(spark, [f"file:{tmpdir_path}/a.csv"])
    assert {k: dict(df.dtypes)[k] for k in ("id_orig_p", "score", "flag", "note")} == {
        "id_orig_p": "int", "score": "double", "flag": "boolean", "note": "string"}
    assert df.select("row_id").distinct().count() == 2
    assert files.peek(spark, [f"file:{tmpdir_path}/a.csv"], 1).count() == 1


def test_listing_errors_are_not_an_empty_listing(spark, tmpdir_path):
    assert files.discover_files(spark, f"{tmpdir_path}/missing").count() == 0
    with pytest.raises(Exception):
        files.discover_files(spark, "nosuchscheme://x/y")
