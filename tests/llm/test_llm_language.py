"""Operator 3: held-out accuracy, Viterbi against enumeration, edge cases."""

import itertools
import zlib

import numpy as np

from llm_fixtures import SF01, awkward, docs
from netsieve.llm import language, queries
from netsieve.llm.common import load


def test_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in load(spark, SF01, "documents").select("doc_id", "lang").collect()}
    got = queries.QUERIES["op3_language"](spark, SF01).collect()
    assert len(got) == len(lang)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    test = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in test) >= 0.98 * len(test)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    for _ in range(40):
        first = np.cumsum([0, *rng.integers(0, 6, 4)])
        score = rng.normal(size=(first[-1], 3)) * 3
        got = language.viterbi(score, first, 2.0)
        for a, b in zip(first[:-1], first[1:]):
            def value(path):
                return sum(score[a + i, x] for i, x in enumerate(path)) - 2.0 * sum(x != y for x, y in zip(path, path[1:]))
            if b > a:
                best = max(value(p) for p in itertools.product(range(3), repeat=int(b - a)))
                assert abs(value(got[a:b].tolist()) - best) < 1e-9


def test_spans_of_mixed_text(spark):
    src = load(spark, SF01, "documents").where("length(text) > 1500")
    en, de = (src.where(f"lang = '{x}'").orderBy("doc_id").first()["text"][:600] for x in ("en", "de"))
    d = load(spark, SF01, "documents").select("doc_id", "text", "lang")
    mixed = spark.createDataFrame([(10**9, en + "\n" + de, None)], d.schema)
    spans = [(r["start"], r["end"], r["lang"]) for r in language.language_spans(d.unionByName(mixed)).where(f"doc_id = {10**9}").orderBy("start").collect()]
    size = {x: sum(e - s for s, e, g in spans if g == x) for x in ("en", "de")}
    assert min(size.values()) > 500 and len(spans) < 8


def test_language_edges(spark):
    d = docs(spark, awkward())
    got = language.languages(d).collect()
    assert len(got) == len(awkward())
    assert {r["lang_pred"] for r in got} <= {"en", "de", "und"}
    assert sum(r["lang_pred"] == "und" for r in got) == sum(
        not any(c.isalpha() for c in (t[1] if isinstance(t, tuple) else t) or "") for t in awkward())
    assert language.languages(d.where("false")).count() == 0
    none = language.languages(d.drop("lang").selectExpr("*", "cast(null as string) lang")).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}


def test_identified_keeps_every_text_with_a_letter(spark):
    d = docs(spark, awkward())
    got = language.identified(d)
    assert got.columns == d.columns
    kept = [r["text"] for r in got.collect()]
    want = [t for t in ((x[1] if isinstance(x, tuple) else x) for x in awkward()) if any(c.isalpha() for c in t or "")]
    assert sorted(kept) == sorted(want)
    assert got.where("lang is null").count() == 0


def test_marks_alone_are_no_letters_and_far_letters_are(spark):
    from netsieve.llm import language
    train = [("der hund und die katze im haus", "de"), ("the dog and the cat in the house", "en"), ("今日は天気", "ja")]
    rows = [(i, t, g) for i, (t, g) in enumerate(train * 8)]
    odd = {900: "́̂ ́", 901: "\U00030000\U00030001", 902: "123 ́!", 903: "á̂", 904: "\U000E0100"}
    df = spark.createDataFrame(rows + [(k, v, None) for k, v in odd.items()], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language.languages(df).collect()}
    assert [got[k]["lang_pred"] == "und" for k in sorted(odd)] == [True, False, True, False, True]
    assert got[900]["score"] == 0.0


def test_many_values_of_lang_are_bounded(spark, monkeypatch):
    from netsieve.llm import language
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    rows = [(i, "the dog and the cat", "en") for i in range(40)] + [(100 + i, "der hund und die katze", "de") for i in range(40)]
    rows += [(200 + i, "dirty value", f"x{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(language.fit(df).languages) == ["de", "en"]
