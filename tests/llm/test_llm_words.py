"""Word spans and hashes against plain regular expressions."""

import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from netsieve.llm import common

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbZé日 .0\n", max_size=30)), max_size=12))
def test_words_match_the_pattern(texts):
    words, first = common.words_of(pa.array(texts, pa.string()))
    want = [plain(t) for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in want]
    seen = {}
    for h, w in zip(words.tolist(), [x for t in want for x in t]):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_text_and_slices():
    rng = random.Random(1)
    t = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(300_000))
    words, first = common.words_of(pa.array(["head " + t, t], pa.large_string()))
    assert (words[1:first[1]] == words[first[1]:]).all()
    arr = pa.array(["a b", None, "c d e", "f"]).slice(1, 2)
    assert np.diff(common.words_of(arr)[1]).tolist() == [0, 3]


def test_pieces_keep_all_rows_in_order():
    b = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array([None if i % 7 == 0 else "x" * (i * 11 % 90) for i in range(50)])],
                                   names=["id", "text"])
    got = list(common.pieces([b, b.slice(0, 0), b.slice(40, 10)], "text", 100))
    assert [i for g in got for i in g.column(0).to_pylist()] == [*range(50), *range(40, 50)]
    assert max(g.num_rows for g in got) < 50


def test_shingles_short_texts():
    words, first = common.words_of(pa.array(["a b c", "a b c", "c b a", "", "a b c d e f"]))
    sh, at = common.shingles(words, first, 5)
    assert np.diff(at).tolist() == [1, 1, 1, 0, 2]
    assert sh[0] == sh[1] != sh[2]


def test_code_points():
    buf, off = common.text_bytes(pa.array(["aé日", None, "\U0001F600"]))
    assert common.code_points(buf, off).tolist() == [3, 0, 1]
