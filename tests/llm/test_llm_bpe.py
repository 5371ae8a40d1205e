"""Byte-level BPE against the tiktoken library, a plain merge loop and exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SF001, awkward, docs
from netsieve.llm import bpe

FILES = ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"]
_LIB: dict = {}


def library(name):
    import tiktoken
    if name not in _LIB:
        _LIB[name] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                       mergeable_ranks=bpe.read_ranks(public_tokenizers.path(name)), special_tokens={})
    return _LIB[name]


@pytest.mark.parametrize("name", FILES)
def test_ids_of_odd_texts_equal_the_library(name):
    enc, lib = bpe.ByteBpe(public_tokenizers.path(name), public_tokenizers.PATTERN), library(name)
    rng = random.Random(3)
    tokens = sorted(enc.ranks)
    texts = [t for t in awkward() if isinstance(t, str)] + ["<|endoftext|> and <P>", "a" * 3000, "ab" * 2000, "é" * 999, " " * 777, "\x00\x1c\x85"]
    for _ in range(1500):
        texts.append("".join(rng.choice("ab") for _ in range(rng.randrange(1, 40))))
        texts.append(b"".join(rng.choice(tokens) for _ in range(rng.randrange(1, 9))).decode("utf-8", "replace"))
        texts.append("".join(rng.choice(tokens).decode("utf-8", "ignore").strip() for _ in range(rng.randrange(1, 12))))
        texts.append("".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0x4e00, 0x9fff), rng.randrange(0x1f300, 0x1f700)]))
                             for _ in range(rng.randrange(1, 30))))
    for t in texts:
        ids = list(enc.encode(t))
        assert ids == lib.encode_ordinary(t)
        assert enc.decode(ids) == t.encode()


def test_pieces_equal_plain_merges_on_a_small_vocabulary():
    """Random ranks over few letters, with tokens that no merges reach."""
    rng = random.Random(11)
    for _ in range(60):
        ranks = {bytes([b]): b for b in range(256)}
        pool = [b"a", b"b", b"c"]
        for r in range(256, 256 + rng.randrange(5, 40)):
            t = rng.choice(pool) + rng.choice(pool)
            if t not in ranks:
                ranks[t] = r
                pool.append(t)
        order = list(range(256, 256 + len(ranks) - 256))
        rng.shuffle(order)                              # ranks that do not follow the sizes
        for t, r in zip([t for t in ranks if len(t) > 1], order):
            ranks[t] = r
        enc = bpe.ByteBpe.__new__(bpe.ByteBpe)
        import ahocorasick
        enc.ranks, enc.token = ranks, {r: t for t, r in ranks.items()}
        enc.size, enc.most = {r: len(t) for r, t in enc.token.items()}, max(ranks.values()) + 1
        enc.trie = ahocorasick.Automaton()
        for t, r in ranks.items():
            enc.trie.add_word(t.decode("latin-1"), r)
        enc.trie.make_automaton()
        enc.shorter, enc.fits, enc.alone = bpe._Memo(enc._shorter, 1000), bpe._Memo(enc._fits, 1000), bpe._Memo(enc._alone, 1000)
        for _ in range(60):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 30)))
            want = [ranks[piece]] if piece in ranks else [ranks[t] for t in bpe.merged(piece, ranks)]
            assert enc.piece_ids(piece) == want


def test_forgetting_and_long_texts_change_nothing(monkeypatch):
    path, pattern = public_tokenizers.path(FILES[0]), public_tokenizers.PATTERN
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 90))) for _ in range(400))
    want = list(bpe.ByteBpe(path, pattern).encode(text))
    monkeypatch.setattr(bpe, "PAIRS", 8)
    monkeypatch.setattr(bpe, "WORDS", 5)
    monkeypatch.setattr(bpe, "LONG_TEXT", 50)
    monkeypatch.setattr(bpe, "IDS", 3)
    assert list(bpe.ByteBpe(path, pattern).encode(text)) == want


def test_work_is_linear_in_one_long_piece():
    enc = bpe.ByteBpe(public_tokenizers.path(FILES[0]), public_tokenizers.PATTERN)
    steps = []
    for n in (2_000, 4_000):
        piece = ("ab" * n).encode()
        enc.fits.clear()
        seen = [0]

        class Counted(bpe._Memo):
            def __getitem__(self, key):
                seen[0] += 1
                return super().__getitem__(key)
        enc.fits = Counted(enc._fits, bpe.PAIRS)
        enc.piece_ids(piece)
        steps.append(seen[0])
    assert steps[1] <= 2.2 * steps[0]


def test_report_on_awkward_rows(spark):
    name = FILES[0]
    path, lib = public_tokenizers.path(name), library(name)
    texts = awkward(3000)
    df = docs(spark, texts).withColumn("ids", F.lit("taken"))
    out = bpe.bpe_report(df, path, public_tokenizers.PATTERN)
    want = []
    for i, t in enumerate(texts):
        doc_id, t = t if isinstance(t, tuple) else (i, t)
        ids = lib.encode_ordinary(t or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    both = bpe.decoded(bpe.encoded(df, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN, ids="ids_")
    assert both.columns == [*df.columns, "ids_", "bytes"]
    assert both.where(F.col("bytes") != F.coalesce(F.col("text"), F.lit("")).cast("binary")).isEmpty()
    assert bpe.bpe_report(df.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_query_equals_the_library(spark):
    from netsieve.llm.queries import QUERIES
    lib = library(FILES[0])
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op13_byte_bpe"](spark, SF001).collect()}
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = lib.encode_ordinary(r["text"] or "")
        assert got[r["doc_id"]] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                    hashlib.sha256((r["text"] or "").encode()).hexdigest())
