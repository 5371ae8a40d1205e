"""Operator 8: targets, schedule and limits against brute force, and DuckDB."""

import math
import random
import re

import pytest

from llm_fixtures import SF001, awkward, docs, word_text
from netsieve.llm import mixing, queries
from oracle_harness import duck_connect
from test_llm_decontamination import same


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, out, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        left, total = goal - sum(out.values()), sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: left * w[s] / total for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return out


@pytest.mark.parametrize("seed", range(5))
def test_targets(spark, seed):
    rng = random.Random(seed)
    names = [None, "a", "B", "é", "𝒳", "￿", "zz", "s1", "s10", "s2"][:rng.randrange(1, 11)]
    sizes = {s: rng.choice([0, 3, rng.randrange(10**4)]) for s in names}
    got = {r["source"]: r["target"] for r in mixing.source_targets(
        spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def check(out, texts):
    size = {r["doc_id"]: r["size"] for r in out}
    assert size == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in texts.items()}
    by = {}
    for r in out:
        by.setdefault(r["source"], []).append(r)
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = brute_targets({s: sum(r["size"] for r in rs) for s, rs in by.items()})
    for s, rs in by.items():
        assert {r["source_size"] for r in rs} == {sum(r["size"] for r in rs)}
        assert rs[0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["taken"] for r in rs) - want[s]) <= 3 * mixing.BLOCK_WORDS


def test_mix_of_the_table(spark):
    from netsieve.llm.common import load
    text = {r["doc_id"]: r["text"] for r in load(spark, SF001, "documents").collect()}
    out = queries.QUERIES["op8_source_mix"](spark, SF001).collect()
    check(out, text)
    assert sorted(queries.QUERIES["op8_source_mix"](spark, SF001).collect()) == sorted(out)


def test_hot_source_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOT_CHUNK", 16)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    rng = random.Random(1)
    texts = [word_text(rng, rng.randrange(0, 900)) for _ in range(120)]
    d = docs(spark, texts).selectExpr("doc_id", "text", "case when doc_id % 3 = 0 then 'hot' else concat('s', doc_id % 7) end source", "size", "key", "src")
    check(mixing.mix_report(d).collect(), dict(enumerate(texts)))


def test_oracle(spark):
    same(queries.QUERIES["op8_source_mix"](spark, SF001), duck_connect(SF001), "op8_source_mix")


def test_schedule_is_low_discrepancy(spark):
    sizes = spark.createDataFrame([("a", 40_000), ("b", 60_000), ("c", 90_000)], "source string, size long")
    t = mixing.source_targets(sizes, block=64)
    rows_ = {r["src"]: r for r in t.collect()}
    n = math.floor(sum(r["slots"] for r in rows_.values()) + 0.5)
    slots = sorted((r["slot"], r["src"], r["rank"]) for r in mixing.slot_schedule(t, n, 3).collect())
    assert [s[0] for s in slots] == list(range(n))
    seen = dict.fromkeys(rows_, 0)
    for i, (_, src, rank) in enumerate(slots, 1):
        assert rank == seen[src]
        seen[src] += 1
        if i % 97 == 0:                          # every prefix is near the weights
            for s, r in rows_.items():
                assert abs(seen[s] - i * (r["hi"] - r["lo"])) < 6


def test_edges(spark):
    out = mixing.mix_report(docs(spark, awkward())).collect()
    assert len(out) == len(awkward()) and all(r["taken"] <= 2 * r["size"] for r in out)
    assert any(r["source"] is None for r in out)
    assert mixing.mix_report(docs(spark, awkward()).where("false")).count() == 0
    assert [r["taken"] for r in mixing.mix_report(docs(spark, ["", None])).collect()] == [0, 0]


def test_the_mix_holds_the_words_that_are_counted(spark):
    """Pieces in order of slots: whole blocks, the documents' own words, as many of each as mix_report takes."""
    from netsieve.llm import mixing
    from netsieve.llm.common import load
    from llm_fixtures import SF001, awkward, docs
    for d in (load(spark, SF001, "documents"), docs(spark, awkward(3000)), docs(spark, awkward(10)).where("false")):
        mix = mixing.mixed(d).collect()
        text = {}
        for r in d.select("doc_id", "text").collect():
            text.setdefault(r["doc_id"], []).append([w for w in re.split(r"[\x20\x09-\x0D]+", r["text"] or "") if w])
        taken = {}
        for r in mix:
            words = r["text"].split(" ")
            assert len(words) == r["n_words"] > 0
            assert any(words == w[i:i + len(words)] for w in text[r["doc_id"]] for i in range(len(w)) if w[i] == words[0])
            taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["n_words"]
        want = {}
        for r in mixing.mix_report(d).collect():
            want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"]
        assert taken == {k: v for k, v in want.items() if v}
        # a slot holds one block: its pieces follow each other without a gap
        by_slot = {}
        for r in mix:
            by_slot.setdefault(r["slot"], []).append((r["place"], r["n_words"]))
        for slot in by_slot.values():
            slot.sort()
            assert slot[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(slot, slot[1:]))
