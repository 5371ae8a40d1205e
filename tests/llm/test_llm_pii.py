"""Operator 10: fixed patterns against plain regular expressions, decoding against
enumeration, tagged spans, masking."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from llm_fixtures import SF01, awkward, docs, rows
from netsieve.llm import pii, queries
from netsieve.llm.common import load


def plain_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m.group() if c.isdigit()]
        odd = [sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(reversed(d))]
        if 12 <= len(d) <= 19 and sum(odd) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-+ 0123456789()é%\n", max_size=60))
def test_base_spans_match_the_patterns(t):
    assert pii.base_spans(t) == plain_spans(t)


def test_base_spans_of_planted_texts():
    rng = random.Random(2)
    bits = ["a.b@c.de", "@x.y", "x@y", "a@b.c@d.e.f", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1111",
            "4111111111111112", "+1 (017) 555-7713", "+49 30 901820", "+1+2", "+123", " ", "é", "..", "日", "0" * 16, "9" * 40]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 8)))
        assert pii.base_spans(t) == plain_spans(t), t


def test_report_matches_on_the_table(spark):
    text = {r["doc_id"]: r["text"] for r in load(spark, SF01, "documents").collect()}
    got = queries.QUERIES["op10_personal_data"](spark, SF01).collect()
    assert len(got) == len(text)
    for r in got:
        spans = plain_spans(text[r["doc_id"]])
        base = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(x[1] == i for x in spans) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) <= set(r["spans"].split(",")) | {""}


def test_decode_is_the_best_labelling():
    rng = np.random.default_rng(5)
    n_lab = 4
    for _ in range(40):
        runs = np.cumsum([0, *rng.integers(1, 5, 3)])
        em, tr = rng.normal(size=(runs[-1], n_lab)), rng.normal(size=(n_lab, n_lab))
        got = pii.decode(em, runs, tr)
        for a, b in zip(runs[:-1], runs[1:]):
            def value(path):
                steps = [0, *path, 0]
                return sum(em[a + i, x] for i, x in enumerate(path)) + sum(tr[x, y] for x, y in zip(steps, steps[1:]))
            assert abs(value(got[a:b].tolist()) - max(value(p) for p in itertools.product(range(n_lab), repeat=int(b - a)))) < 1e-9


def found(tagger, t):
    return [(pii.KINDS[k], t[s:e]) for s, k, e in pii.find_spans(tagger, pa.array([t]))[0][1]]


def test_the_field_finds_unseen_shapes_and_leaves_numbers():
    tagger = pii.train()
    want = {"ring 555-010-4477 now": [("phone", "555-010-4477")], "éé (909) 555-1212, ok": [("phone", "(909) 555-1212")],
            "ssn 212-44-9087.": [("ssn", "212-44-9087")], "to GB82WEST12345698765432 please": [("iban", "GB82WEST12345698765432")],
            "to GB83WEST12345698765432 please": [], "in 1987 and 2024-01-31 at 12:45": [], "ref 2390409500648960 of": [],
            "$1,200.50 or 33% of 450": [], "v1.2.3 page 7-9": []}
    assert {t: found(tagger, t) for t in want} == want


def test_training_fits_its_table():
    tagger = pii.train()
    texts, spans = pii._read_labelled(pii.LABELLED)
    hit = total = 0
    for t, marks in zip(texts, spans):
        got = {(pii.KINDS[k], s) for s, k, e in pii.find_spans(tagger, pa.array([t]))[0][1]}
        for s, kind, e in marks:
            total += 1
            hit += (kind, s) in got
    assert hit >= 0.9 * total


def test_edges_and_masking(spark):
    texts = awkward() + ["mail a.b@c.de, call +1 (017) 555-7713 or 555-123-4567; ip 10.0.0.1"]
    d = docs(spark, texts)
    got = pii.pii_report(d).collect()
    assert len(got) == len(texts)
    want = sorted((str(r[0]), len(plain_spans(r[1] or ""))) for r in rows(texts))
    assert sorted((str(r["doc_id"]), sum(r[f"n_{k}"] for k in pii.BASE)) for r in got) == want
    out = pii.redact(d)
    assert out.columns == d.columns and out.count() == len(texts)
    r = out.where(f"doc_id = {len(texts) - 1}").first()
    assert r["text"] == "mail [EMAIL], call [PHONE] or [PHONE]; ip [IP]" and r["n_chars"] == len(r["text"])
    clean = {r["text"] for r in out.collect()}
    assert awkward()[6] in clean and None in clean
    assert pii.pii_report(d.where("false")).count() == 0 and pii.redact(d.where("false")).count() == 0
    assert pii.masked("0123456789", [(1, 0, 4), (3, 1, 6), (8, 2, 9)]) == "0[EMAIL]67[CARD]9"


def iban(country, account):
    x = "".join(str(int(c, 36)) for c in account + country + "00")
    s = f"{country}{98 - int(x) % 97:02d}{account}"
    return " ".join(s[i:i + 4] for i in range(0, len(s), 4))


def test_spaced_ibans_with_letter_groups_are_whole():
    rng = random.Random(3)
    tagger = pii.train()
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    banks = {"GB": 14, "NL": 10, "IE": 14, "LV": 13, "BG": 14, "RO": 16, "GI": 15}
    texts, want = ["to GB29 NWBK 6016 1331 9268 19 now"], ["GB29 NWBK 6016 1331 9268 19"]
    for country, n in banks.items():
        for i in range(20):
            want.append(iban(country, "".join(rng.choice("ABCDEFGHIKLMNOPRSTUVW") for _ in range(4)) + digits(n)))
            texts.append(["pay to %s today", "IBAN: %s.", "konto %s, danke", "the %s", "%s"][i % 5] % want[-1])
    got = pii.find_spans(tagger, pa.array(texts))
    hit = [("iban", w) in [(pii.KINDS[k], t[s:e]) for s, k, e in every] for t, w, (_, every) in zip(texts, want, got)]
    assert hit[0] and sum(hit) >= 0.97 * len(hit), [w for w, h in zip(want, hit) if not h]
    assert pii.masked(texts[0], got[0][1]) == "to [IBAN] now"
    wrong = [t.replace(w, w[:2] + f"{(int(w[2:4]) + 1) % 100:02d}" + w[4:]) for t, w in zip(texts, want)]
    assert sum(any(k == 5 for _, k, _ in every) for _, every in pii.find_spans(tagger, pa.array(wrong))) <= 0.05 * len(wrong)


def test_numbers_with_lone_separators():
    tagger = pii.train()
    want = {"ring 555 - 123 - 4567 now": [("phone", "555 - 123 - 4567")], "at (212) - 555-0187 please": [("phone", "(212) - 555-0187")],
            "from 1987 - 1999 in": [], "pages 7 - 9 of 12": [], "took 30 USD and 45 EUR": []}
    assert {t: found(tagger, t) for t in want} == want


def test_tokens_that_can_carry_labels():
    buf, off = pii.text_bytes(pa.array(["NWBK GB29 NWBK 60 - – ab AB", "AB 7 ABCDE AB", "", "AB, (3) USD. ..."], pa.large_string()))
    start, end, first, marked = pii.tokens(buf, off)
    got = [buf[start[i]:end[i]].tobytes().decode() for i in pii.labelable(buf, start, end, first, marked)]
    assert got == ["GB29", "NWBK", "60", "-", "–", "7", "(3)", "USD.", "..."]
