"""Operator 4 against DuckDB and against direct search."""

import random

import numpy as np
import pytest

from llm_fixtures import SF001, awkward, docs, duck, rows, word_text
from netsieve.llm import queries, suffix
from oracle_harness import duck_connect, rows_multiset


def same(df, con, key):
    res = con.execute(queries.ORACLE[key])
    want = rows_multiset([d[0] for d in res.description], res.fetchall())
    assert rows_multiset(df.columns, [tuple(r) for r in df.collect()]) == want


def test_matches_oracle(spark):
    same(queries.QUERIES["op4_decontamination"](spark, SF001), duck_connect(SF001), "op4_decontamination")


def test_suffix_array_order():
    rng = np.random.default_rng(2)
    for _ in range(30):
        h = rng.integers(0, 4, 60).astype(np.uint64)
        sa = suffix.suffix_array(h, 64)
        def key(i):
            x = h[i:].tolist()
            return x[:x.index(0)] if 0 in x else x      # a 0 ends a text
        keys = [key(i) for i in sa]
        assert sorted(sa.tolist()) == list(range(60)) and keys == sorted(keys)


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(8)
    items = [word_text(rng, n) for n in (30, 12, 10, 9, 3, 1)] + [None, "", "w1x w2x w3x", "..."]
    texts = awkward(1500) + [word_text(rng, 50) for _ in range(15)]
    for i, it in enumerate(items[:6]):
        w = it.split()
        texts.append(word_text(rng, 20) + " " + it.upper() + ", " + word_text(rng, 20) + " " + it)
        texts.append(word_text(rng, 5) + " " + " ".join(w[1:]))
        texts.append(" ".join(w[:9]) + " zz " + " ".join(w[9:]))
    bench = [(i, t) for i, t in enumerate(items)] + [(2, items[2]), (77, items[0])]
    return texts, bench


@pytest.mark.parametrize("block, shard", [(1 << 24, 1_000_000), (200, 40)])
def test_planted_passages(spark, planted, monkeypatch, block, shard):
    monkeypatch.setattr(suffix, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix, "SHARD_WORDS", shard)
    texts, bench = planted
    con = duck({"documents": ("doc_id bigint, text varchar", [r[:2] for r in rows(texts)]),
                "benchmark": ("item_id bigint, text varchar", bench)})
    b = spark.createDataFrame(bench, "item_id long, text string")
    same(suffix.contamination_report(docs(spark, texts), b), con, "op4_decontamination")
    left = suffix.remove_contaminated(docs(spark, texts), b)
    clean = {r["doc_id"] for r in suffix.contamination_report(docs(spark, texts), b).where("not contaminated").collect()}
    assert left.columns == docs(spark, texts).columns and {r["doc_id"] for r in left.collect()} <= clean


def test_verbatim_matches_are_maximal(spark):
    rng = random.Random(4)
    item = word_text(rng, 40).split()
    text = "start " + " ".join(item[5:30]) + " gap " + " ".join(item[28:])
    got = suffix.verbatim_matches(docs(spark, [text]), spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")).collect()
    assert sorted((r["item_id"], r["doc_word"], r["item_word"], r["n_words"]) for r in got) == [("5", 1, 5, 25), ("5", 27, 28, 12)]


def test_empty_tables(spark):
    b = spark.createDataFrame([], "item_id long, text string")
    got = suffix.contamination_report(docs(spark, awkward()), b).collect()
    assert len(got) == len(awkward()) and not any(r["contaminated"] for r in got)
    assert suffix.contamination_report(docs(spark, ["x"]).where("false"), b).count() == 0


def test_repeated_benchmark_rows_and_blocks(spark, monkeypatch):
    """A third of the benchmark is one row, another text has many ids: blocks hold distinct texts,
    results equal those of one block."""
    rng = random.Random(17)
    items = [(f"i{k}", word_text(rng, 30, 3000)) for k in range(12)]
    items += [items[0]] * 40 + [(f"same{k}", items[1][1]) for k in range(5)]
    bench = spark.createDataFrame(items, "item_id string, text string").repartition(4)
    texts = [word_text(rng, 40, 3000) + " " + items[k][1] + " " + word_text(rng, 20, 3000) for k in range(12)] + [word_text(rng, 90, 3000)]
    d = docs(spark, texts)
    one = sorted(map(tuple, suffix.contamination_report(d, bench).collect()))
    matches = sorted(map(tuple, suffix.verbatim_matches(d, bench).collect()))
    assert len(suffix._Blocks(bench, 10)) == 1 and suffix._Blocks(bench, 10).texts.count() == 12
    assert [r[3] for r in one] == [1, 6, *[1] * 10, 0] and len(matches) >= 17
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 600)
    assert len(suffix._Blocks(bench, 10)) > 2
    assert sorted(map(tuple, suffix.contamination_report(d, bench).collect())) == one
    assert sorted(map(tuple, suffix.verbatim_matches(d, bench).collect())) == matches
