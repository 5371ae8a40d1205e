"""Operators 1 and 2 against brute force."""

import hashlib
import statistics

import pytest
from pyspark.sql import functions as F

from llm_fixtures import SF001, SF01, awkward, docs
from netsieve.llm import queries, sketch, tokens
from netsieve.llm.common import load
from netsieve.session import scratch_dir
from test_llm_words import plain


def shingle_set(t):
    w = plain(t)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edit(t, nxt):
    k = len(t) // 3
    return t[:len(t) - k] + nxt[:k]


def test_fingerprints_match_brute_force(spark):
    d = [(r["doc_id"], r["text"]) for r in load(spark, SF01, "documents").select("doc_id", "text").collect()]
    d.sort(reverse=True)
    nxt = {d[i][0]: d[(i + 1) % len(d)][1] for i in range(len(d))}
    text = dict(d)
    got = {r["doc_id"]: r for r in queries.QUERIES["op1_fingerprints"](spark, SF01).collect()}
    assert len(got) == len(d)
    errors, prints = [], {}
    for i, r in got.items():
        e = edit(text[i], nxt[i])
        assert r["n_chars"] == len(text[i])
        assert r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        if len(shingle_set(text[i])) > 100:
            errors.append(abs(r["near_edited"] - jaccard(text[i], e)))
            errors.append(abs(r["near_next"] - jaccard(text[i], nxt[i])))
        assert prints.setdefault(text[i], r["fingerprint"]) == r["fingerprint"]
    assert statistics.mean(errors) < 0.05
    # a sketch holds about one shingle in SCALE
    kept = sum(len(r["fingerprint"]) // sketch.WIDTH for r in got.values())
    assert kept == pytest.approx(sum(len(shingle_set(t)) for t in text.values()) / sketch.SCALE, rel=0.1)


def test_fingerprint_edges(spark):
    got = sketch.edit_report(docs(spark, awkward())).collect()
    assert len(got) == len(awkward())
    one = sketch.edit_report(docs(spark, ["only one document here today"])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert sketch.edit_report(docs(spark, ["x"]).where("false")).count() == 0


def test_next_follows_descending_ids_with_ties(spark):
    texts = [(7, "b " * 9), (7, "a " * 9), (None, "n " * 9), (2, "c " * 9), (9, "d " * 9)]
    got = sketch.edit_report(docs(spark, texts)).collect()
    by = {(r["doc_id"], r["edited_sha256"]) for r in got}
    sha = lambda t, x: hashlib.sha256(edit(t, x).encode()).hexdigest()
    t = {k: c * 9 for k, c in zip("abcdn", ["a ", "b ", "c ", "d ", "n "])}
    assert (None, sha(t["n"], t["d"])) in by and (2, sha(t["c"], t["n"])) in by
    # equal ids follow one another in one order or the other
    first, second = ("a", "b") if (9, sha(t["d"], t["a"])) in by else ("b", "a")
    assert {(9, sha(t["d"], t[first])), (7, sha(t[first], t[second])), (7, sha(t[second], t["c"]))} <= by


def test_merge_and_containment(spark):
    words = [f"w{i}" for i in range(4000)]
    a, b = " ".join(words[:3000]), " ".join(words[2996:])
    fp = {r["doc_id"]: r["fingerprint"] for r in sketch.fingerprints(docs(spark, [a, b, " ".join(words), " ".join(words[:300])])).collect()}
    df = spark.createDataFrame([(fp[0], fp[1], fp[2], fp[3])], "a string, b string, c string, d string")
    r = df.select(sketch.merge_fingerprints(F.col("a"), F.col("b")).alias("m"), sketch.containment_of(F.col("d"), F.col("c")).alias("x"),
                  sketch.containment_of(F.col("c"), F.col("d")).alias("y")).first()
    assert r["m"] == fp[2]
    assert r["x"] == 1.0 and r["y"] == pytest.approx(0.075, abs=0.03)


def brute_counts(texts, name):
    path = queries.vocabulary(name)
    if name.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(sp.encode(t or "")) for t in texts]
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


def test_token_counts_match_the_library(spark):
    text = {r["doc_id"]: r["text"] for r in load(spark, SF001, "documents").collect()}
    got = queries.QUERIES["op2_token_counts"](spark, SF001).collect()
    want = dict(zip(text, brute_counts(text.values(), "byte_bpe_50k.json")))
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want
    assert all(r["n_bytes"] == len(text[r["doc_id"]].encode()) and r["over_limit"] == (r["n_tokens"] > 1024) for r in got)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_edges_and_cache(spark, name):
    texts = [t[1] if isinstance(t, tuple) else t for t in awkward()] + ["special <|endoftext|> inside"]
    cache = scratch_dir(spark, "test-cache")
    d = docs(spark, awkward() + ["special <|endoftext|> inside"])
    vocabulary = queries.vocabulary(name)
    got = tokens.token_counts(d, vocabulary, cache).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(brute_counts(texts, name))
    stored = spark.read.parquet(cache).count()
    assert stored == len({t or "" for t in texts})                 # distinct contents only
    assert sorted(tokens.token_counts(d, vocabulary, cache).collect(), key=str) == sorted(got, key=str)
    assert spark.read.parquet(cache).count() == stored             # all found, none encoded again
    tokens.token_counts(docs(spark, ["one", "entirely new"]), vocabulary, cache).collect()
    assert spark.read.parquet(cache).count() == stored + 1         # the miss alone
    assert tokens.token_counts(d.where("false"), vocabulary, cache).count() == 0


def test_other_tokenizers_keep_their_own_counts(spark):
    cache = scratch_dir(spark, "test-cache")
    d = docs(spark, ["some Text to count, twice"])
    a = tokens.token_counts(d, queries.vocabulary("byte_bpe_50k.json"), cache).first()["n_tokens"]
    b = tokens.token_counts(d, queries.vocabulary("piece_bpe_32k.model"), cache).first()["n_tokens"]
    assert [a, b] == [brute_counts(["some Text to count, twice"], n)[0] for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def test_only_misses_move_their_text(spark, monkeypatch):
    cache = scratch_dir(spark, "test-cache")
    vocabulary = queries.vocabulary("byte_bpe_50k.json")
    known, new = [f"known text {i % 7}" for i in range(40)], ["new one", "new two", "new one"]
    tokens.token_counts(docs(spark, known), vocabulary, cache).collect()
    stored = tokens.read_cache(spark, cache, tokens.tokenizer_digest(vocabulary))

    def keyed(texts):
        return docs(spark, texts).select(F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "text")

    assert tokens.missing_texts(keyed(known), stored) is None       # no text is looked at
    few = tokens.missing_texts(keyed(known + new), stored)
    assert sorted(r["text"] for r in few.collect()) == ["new one", "new two"]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin")   # joined below the shuffle
    monkeypatch.setattr(tokens, "BROADCAST_MISSES", 1)
    many = tokens.missing_texts(keyed(known + new), stored)
    assert sorted(r["text"] for r in many.collect()) == ["new one", "new two"]
