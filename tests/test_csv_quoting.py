"""CSV as other readers read it: quotes, line breaks, marks, odd names; capped and streamed reads."""

import csv
import io
import os
import random

import pytest

from netsieve.sources import csv_source, files, records
from netsieve.streaming import batches

ROWS = [("u1", 'a "q" b', "1"), ("u2", "l1\nl2", "2"), ("u3", "", "3"), ("u4", 'x,"\n\n"",y', "4"), ("u5", "plain", "5"), ("u6", '"', "6")]


def write(path, rows, header=("uid", "note", "extra"), mark=False, end="\n"):
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=end)
    w.writerows([header, *rows] if header else rows)
    with open(path, "wb") as f:
        f.write((b"\xef\xbb\xbf" if mark else b"") + out.getvalue().encode())
    return f"file:{path}"


def got(df, *cols):
    return sorted(map(tuple, df.select(*(cols or ("uid", "note", "extra"))).collect()), key=repr)


def want(rows=ROWS):
    return sorted([(u, n or None, float(e)) for u, n, e in rows], key=repr)


@pytest.mark.parametrize("mark", [False, True])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quotes_breaks_and_marks(spark, tmpdir_path, mark, end):
    p = write(f"{tmpdir_path}/a[1] {{b}}*%41.csv", ROWS, mark=mark, end=end)
    assert got(files.scan_flows(spark, [p])) == want()
    assert files.discover_files(spark, tmpdir_path).count() == 1
    h = write(f"{tmpdir_path}/h.csv", ROWS, header=None, mark=mark, end=end)
    assert got(files.scan_headerless(spark, [h], ["uid", "note", "orig_bytes"]), "uid", "note", "orig_bytes") == want()
    for cap in (0, 1, 3, 99):
        assert got(files.scan_flows(spark, [p], cap=cap, infer=False), "uid") == sorted((r[0],) for r in ROWS[:cap])
    assert [r["uid"] for r in files.peek(spark, [p], 2).collect()] == ["u1", "u2"]


def test_many_splits(spark, tmpdir_path):
    """Records torn over split edges, whole splits inside quotes, equal to a plain reader."""
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        n = rng.choice([0, 1, 2, 30, 400])
        note = "".join(rng.choice('ab",\n \r') for _ in range(n)).replace("\r", "")
        rows.append((f"u{i}", note, str(i)))
    rows[700] = ("u700", "long\n" * 8000, "700")                       # many splits inside one field
    p = write(f"{tmpdir_path}/big.csv", rows)
    q = write(f"{tmpdir_path}/plain.csv", [(f"v{i}", "x", str(i)) for i in range(500)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = records.read_lines(spark, [p])
        assert lines.rdd.getNumPartitions() > 40
        df = files.scan_flows(spark, [p, q])
        assert got(df) == want(rows + [(f"v{i}", "x", str(i)) for i in range(500)])
        assert df.select("row_id").distinct().count() == 2000
        assert got(files.row_cap_per_file(files.scan_flows(spark, [q]), 7), "uid") == sorted((f"v{i}",) for i in range(7))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_repeated_and_reserved_header_names(spark, tmpdir_path):
    p = write(f"{tmpdir_path}/r.csv", [("u1", "1", "2", "f", "n")], header=("uid", "id.orig_p", "id_orig_p", "file_name", " uid "))
    df = files.scan_flows(spark, [p])
    assert df.columns[:5] == ["uid", "id_orig_p", "id_orig_p_1", "file_name_1", "uid_1"]
    assert got(df, *df.columns[:5]) == [("u1", 1, 2, "f", "n")]


def test_bytes_read_follow_the_cap(spark, tmpdir_path):
    paths = [write(f"{tmpdir_path}/f{i}.csv", [(f"u{k}", "y" * 50, "1") for k in range(40_000)]) for i in range(3)]
    size = os.path.getsize(f"{tmpdir_path}/f0.csv")
    rows = csv_source.reader(spark, csv_source.LeadingSource, paths, width=3, cap=100, header=True)
    assert rows.rdd.getNumPartitions() == 3
    read = {r["path"]: r["b"] for r in rows.groupBy("path").agg({"bytes_read": "max"}).withColumnRenamed("max(bytes_read)", "b").collect()}
    assert len(read) == 3 and all(b <= csv_source.BLOCK < size / 10 for b in read.values())
    heads = csv_source.reader(spark, csv_source.HeadsSource, paths).collect()
    assert [r["header"] for r in heads] == [["uid", "note", "extra"]] * 3 and all(r["bytes_read"] <= csv_source.BLOCK for r in heads)
    open(f"{tmpdir_path}/empty.csv", "w").close()
    assert csv_source.reader(spark, csv_source.HeadsSource, [f"file:{tmpdir_path}/empty.csv"]).first()["header"] is None
    assert files.scan_flows(spark, paths, cap=100).count() == 300


def test_many_headers_are_read_in_tasks(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(files, "HEADS_BY_DRIVER", 2)
    monkeypatch.setattr(files, "read_header", None)
    paths = [write(f"{tmpdir_path}/f{i}.csv", ROWS, mark=i % 2 == 0) for i in range(4)]
    assert got(files.scan_flows(spark, paths)) == want(ROWS * 4)


def test_raw_records_over_any_block_size():
    text = 'a,"b\n""c""\n",d\r\n\n"x""y"\n1,2\n"tail\nno end'.encode()
    whole = list(csv_source.raw_records([text]))
    assert whole == [b'a,"b\n""c""\n",d\r', b"", b'"x""y"', b"1,2", b'"tail\nno end']
    for n in range(1, 9):
        assert list(csv_source.raw_records(text[i:i + n] for i in range(0, len(text), n))) == whole
    assert csv_source.fields(whole[0]) == ["a", 'b\n"c"\n', "d"]


def test_streams_read_like_scans(spark, tmpdir_path):
    write(f"{tmpdir_path}/a.csv", ROWS, mark=True)
    write(f"{tmpdir_path}/b.csv", [("v1", "n", "7")], header=("uid", "note", "extra"))
    seen = {}

    def handler(df, batch_id):
        seen["types"] = dict(df.dtypes)
        return df.select("uid", "note", "extra")
    sink = f"{tmpdir_path}/sink"
    batches.run_batches(spark, tmpdir_path, handler, sink, batch_files=2)
    assert seen["types"]["extra"] == "double" == dict(files.scan_flows(spark, [f"file:{tmpdir_path}/a.csv"]).dtypes)["extra"]
    assert got(spark.read.parquet(sink)) == want(ROWS + [("v1", "n", "7")])


def test_cache_takes_changing_types(spark, tmpdir_path):
    from netsieve.functions import CompositeFeatures, NetworkTrafficFeatures
    from netsieve.sources import cache
    folder, root = f"{tmpdir_path}/in", f"{tmpdir_path}/cache"
    os.makedirs(folder)
    ex = CompositeFeatures([NetworkTrafficFeatures()])
    head = ("uid", "proto", "orig_bytes", "resp_bytes", "duration", "orig_pkts", "resp_pkts", "extra")
    write(f"{folder}/a.csv", [("u1", "tcp", "1", "2", "1", "1", "1", "1")], header=head)
    one = cache.cached_features(spark, files.discover_files(spark, folder), ex, root)
    assert dict(one.dtypes)["extra"] == "double"
    write(f"{folder}/b.csv", [("u2", "udp", "1", "2", "1", "1", "1", "abc")], header=head)
    both = cache.cached_features(spark, files.discover_files(spark, folder), ex, root)
    assert sorted((r["uid"], r["extra"]) for r in both.collect()) == [("u1", "1"), ("u2", "abc")]
