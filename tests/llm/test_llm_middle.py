"""Fill-in-middle forms against a plain version, and exact restoring."""

import hashlib

import pytest
from pyspark.sql import functions as F

from llm_fixtures import SF001, awkward, docs
from netsieve.llm import middle


def plain(doc_id, text):
    """The transformation by slicing."""
    t = text or ""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(t)
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, "<S>" + t[b:] + "<P>" + t[:a] + "<M>" + t[a:b]
    return n, "psm", a, b - a, "<P>" + t[:a] + "<S>" + t[b:] + "<M>" + t[a:b]


def given():
    texts = awkward(4000) + [f"text {i} <S" + ">" * (i % 7) + "<<P <M<S M>" for i in range(60)] + ["has <P> in it", "x<M>", "\n", "é\r\n‍"]
    return [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]


def test_forms_and_restored_texts(spark):
    rows = given()
    df = docs(spark, rows).withColumn("form", F.lit("taken")).withColumn("n", F.lit(1))
    out = middle.fill_in_middle(df)
    added = middle.names(df.columns)
    assert out.columns == [*df.columns, *added] and added[0] == "n_" and added[1] == "form_"
    got = out.select("doc_id", *added, middle.restored(added[4], added[1]).alias("back"), F.coalesce("text", F.lit("")).alias("t")).collect()
    assert all(r["back"] == r["t"] for r in got)
    want = [(d, *plain(d, t)) for d, t in rows]
    assert sorted([tuple(r)[:6] for r in got], key=repr) == sorted(want, key=repr)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert middle.middle_report(df.limit(0)).count() == 0


def test_segments_and_other_units(monkeypatch):
    text = "one two  three\n" * 50 + "日本 😀"
    whole = middle.unit_ends(text)[0]
    assert whole == list(range(1, len(text) + 1))
    words = middle.unit_ends(text, r"\S+\s*")[0]
    assert len(words) == len(text.split()) and words[-1] == len(text)
    monkeypatch.setattr(middle, "SEGMENT", 7)
    monkeypatch.setattr(middle, "_LOADED", {})
    parts = middle.unit_ends(text)
    assert len(parts) > 3 and [x for p in parts for x in p] == whole
    assert [x for p in middle.unit_ends(text, r"\S+\s*") for x in p] == words
    assert [middle._end(parts, n) for n in range(len(whole) + 1)] == [0, *whole]
    with pytest.raises(ValueError, match="does not cover"):
        middle.unit_ends("a b" * 9, r"\S")


def test_query_equals_the_plain_version(spark):
    from netsieve.llm.queries import QUERIES
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = sorted(tuple(r) for r in QUERIES["op12_fill_in_middle"](spark, SF001).collect())
    want = []
    for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect():
        n, form, a, m, out = plain(*r)
        want.append((r["doc_id"], n, form, a, m, sha(out), sha(r["text"] or "")))
    assert got == sorted(want)
