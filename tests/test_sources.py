"""CSV files written by the test, then scanned."""

import os

from pyspark.sql import functions as F

from netsieve.sources import files

HDR = "ts,uid,id.orig_h,id.orig_p,id.resp_h,id.resp_p,proto,service,duration,orig_bytes,resp_bytes,conn_state"
ROW = "1704067207.5,C{i},10.0.0.1,{p},10.0.0.2,80,tcp,http,1.5,100,200,SF"


def _write(d, name, lines):
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(lines) + ("\n" if lines else ""))


def make_f3(d):
    for name in ["CTU-Benign-1.csv", "CTU-Malicious-2.csv", "benign-malicious-3.csv", "botnet-ddos-4.csv",
                 "capture-5.csv"]:
        _write(d, name, [HDR] + [ROW.format(i=f"{name[:3]}{k}", p=1000 + k) for k in range(3)])
    _write(d, "labelled-6.csv", ["uid,proto,label"] + [f"L{i},tcp,{v}" for i, v in
                                                       enumerate(["Benign", "NORMAL", "Attack", "anomaly", "C&C", ""])])
    _write(d, "messy-7.csv", [" uid , proto ,orig_bytes, local_orig ",
                              "M1,tcp,10,T", "M2,udp,-,F", "M3,tcp,5,true,EXTRA", "M4,icmp"])
    _write(d, "durations-9.csv", ["uid,duration", "D1,2.5", "D2,0 days 00:00:02.998796", "D3,-", "D4,", "D5,0"])
    _write(d, "empty-10.csv", ["uid,proto"])


def _paths(d, names):
    return [f"file:{os.path.join(d, n)}" for n in names]


def test_labels_from_names_and_values(spark, tmpdir_path):
    make_f3(tmpdir_path)
    names = ["CTU-Benign-1.csv", "CTU-Malicious-2.csv", "benign-malicious-3.csv", "botnet-ddos-4.csv",
             "capture-5.csv", "labelled-6.csv"]
    df = files.scan_flows(spark, _paths(tmpdir_path, names))
    by_file = {r["file_name"]: r["labels"] for r in
               df.groupBy("file_name").agg(F.collect_set("label").alias("labels")).collect()}
    assert by_file["CTU-Benign-1.csv"] == ["benign"]
    assert by_file["CTU-Malicious-2.csv"] == ["malicious"]
    assert by_file["benign-malicious-3.csv"] == ["benign"]
    assert by_file["botnet-ddos-4.csv"] == ["botnet"]
    assert by_file["capture-5.csv"] == ["unknown"]
    lab = {r["uid"]: r["label"] for r in df.where(F.col("file_name") == "labelled-6.csv").collect()}
    assert lab == {"L0": "benign", "L1": "benign", "L2": "malicious", "L3": "malicious", "L4": "c&c",
                   "L5": "unknown"}
    # typed columns and unioned headers
    assert dict(df.dtypes)["id_orig_p"] == "int" and dict(df.dtypes)["orig_bytes"] == "double"
    assert df.where(F.col("file_name") == "labelled-6.csv").where(F.col("orig_bytes").isNotNull()).count() == 0


def test_messy_file(spark, tmpdir_path):
    make_f3(tmpdir_path)
    df = files.scan_flows(spark, _paths(tmpdir_path, ["messy-7.csv"]))
    rows = {r["uid"]: r for r in df.collect()}
    assert set(rows) == {"M1", "M2", "M4"}                  # too many fields: dropped
    assert rows["M2"]["orig_bytes"] is None                   # '-' token: null cell, file kept
    assert rows["M4"]["orig_bytes"] is None and rows["M4"]["proto"] == "icmp"   # short row kept
    assert rows["M1"]["local_orig"] is True and rows["M2"]["local_orig"] is False
    assert "proto" in df.columns and "local_orig" in df.columns       # names trimmed


def test_durations_and_empty(spark, tmpdir_path):
    make_f3(tmpdir_path)
    df = files.scan_flows(spark, _paths(tmpdir_path, ["durations-9.csv", "empty-10.csv"]))
    d = {r["uid"]: r["duration"] for r in df.collect()}
    assert d == {"D1": 2.5, "D2": 2.998796, "D3": 0.0, "D4": None, "D5": 0.0}


def test_headerless(spark, tmpdir_path):
    _write(tmpdir_path, "headerless-8.csv", ["H1,tcp,5", "H2,udp,7"])
    df = files.scan_headerless(spark, _paths(tmpdir_path, ["headerless-8.csv"]), ["uid", "proto", "orig_bytes"])
    assert sorted((r["uid"], r["orig_bytes"]) for r in df.collect()) == [("H1", 5.0), ("H2", 7.0)]


def test_inventory_and_discovery(spark, tmpdir_path):
    make_f3(tmpdir_path)
    lst = files.discover_files(spark, tmpdir_path)
    assert lst.count() == 9
    inv = {r["filename"]: r["category"] for r in files.file_inventory(lst).collect()}
    assert inv["benign-malicious-3.csv"] == "malicious" and inv["CTU-Benign-1.csv"] == "benign"
    assert inv["capture-5.csv"] == "unknown"
    assert files.discover_files(spark, tmpdir_path, num_files=2).count() == 2
    # fallback sub-folder
    sub = os.path.join(tmpdir_path, "nested")
    os.makedirs(os.path.join(sub, "data"))
    _write(os.path.join(sub, "data"), "x.csv", ["uid", "A"])
    assert files.discover_files(spark, sub).count() == 1


def test_row_cap_keeps_file_order(spark, tmpdir_path):
    _write(tmpdir_path, "big.csv", ["uid,orig_bytes"] + [f"R{i:05d},{i}" for i in range(5000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")    # many splits per file
    try:
        df = files.scan_flows(spark, _paths(tmpdir_path, ["big.csv"]))
        assert df.rdd.getNumPartitions() > 4
        got = sorted(r["orig_bytes"] for r in files.row_cap_per_file(df, 1234).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [float(i) for i in range(1234)]
