"""Operator 10, personal data: fixed patterns and a linear-chain conditional random field.

The field tags whitespace tokens with begin/inside labels from hashed word-shape features.
It is trained here, by forward-backward in numpy, on the small table of ``pii_labels``.  Only
tokens with a digit or an @, and short upper-case groups and lone separators that follow them,
can carry a label, so a text decomposes exactly into runs of such tokens, and Viterbi steps
through all runs of a batch together.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import _U, mix, pieces, prepare, text_bytes, word_hashes, word_spans
from .pii_labels import LABELLED

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "ssn", "iban"]
LABELS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
SLOTS = 1 << 14                  # hashed features
ROUNDS = 200                     # training steps
PENALTY = 0.02                   # L2
_FORBID = np.float32(-1e6)

# ------------------------------------------------------------------ base patterns
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(t: str):
    """Matches of the e-mail pattern, found from each @ leftwards (linear in the text)."""
    done, at = 0, t.find("@")
    while at >= 0:
        s = at
        while s > done and t[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(t, at) if s < at else None
        if m:
            yield s, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = t.find("@", max(at + 1, done))


def base_spans(t: str) -> list:
    """(start, kind number, end) of the fixed patterns that pass their checks, in order."""
    out = []
    if "@" in t:
        out += [(s, 0, e) for s, e in _emails(t)]
    for m in _IP.finditer(t):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(t):
        if m.end() - m.start() <= 37:
            d = _digits(m.group())
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in t:
        for m in _PHONE.finditer(t):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# ------------------------------------------------------------------ tokens and features
_TOKEN_BYTE = np.arange(256) > 0x20
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x30:0x3A] = ord("0")
_SHAPE[0x41:0x5B] = ord("A")
_SHAPE[0x61:0x7B] = ord("a")
_SHAPE[0x80:] = ord("a")
_IS_ALNUM = np.zeros(256, bool)
_IS_ALNUM[0x30:0x3A] = _IS_ALNUM[0x41:0x5B] = _IS_ALNUM[0x61:0x7B] = True
_IS_ALNUM[0x80:] = True


def _hash_kept(buf: np.ndarray, keep: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each token's kept bytes (0 for none)."""
    lead = np.concatenate([[0], np.cumsum(keep)])
    return word_hashes(buf[keep], lead[start], lead[end])


def tokens(buf: np.ndarray, off: np.ndarray):
    """Token byte spans, token offsets per text, and which tokens hold a digit or an @."""
    start, end = word_spans(buf, off, _TOKEN_BYTE)
    mark = np.concatenate([[0], np.cumsum(((buf >= 0x30) & (buf <= 0x39)) | (buf == 0x40))])
    return start, end, np.searchsorted(start, off, side="left"), mark[end] > mark[start]


def labelable(buf: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Numbers of the tokens that can carry a label: the marked ones, and those that follow one
    through nothing but groups of 1 to 4 upper-case letters (the bank code of a spaced IBAN) and
    separators of at most 3 bytes."""
    if not len(start):
        return np.zeros(0, np.int64)

    def inside(which):
        at = np.concatenate([[0], np.cumsum(which)])
        return at[end] - at[start]
    size, upper = end - start, inside((buf >= 0x41) & (buf <= 0x5A))
    plain = inside((buf < 0x80) & ~_IS_ALNUM[buf])
    dash = (size == 3) & (buf[start] == 0xE2) & (buf[np.minimum(start + 1, len(buf) - 1)] == 0x80)
    joins = ~marked & (((upper >= 1) & (upper <= 4) & (plain <= 1) & (upper + plain == size)) | ((plain == size) & (size <= 3)) | dash)
    idx = np.arange(len(start))
    last = np.maximum.accumulate(np.where(joins, -1, idx))
    doc = np.searchsorted(first, idx, side="right") - 1
    return np.flatnonzero(marked | (joins & (last >= 0) & marked[last] & (doc[last] == doc)))


def features(buf: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """Feature slots (one row per picked token): own exact shape, collapsed shape, word,
    digit count and length; collapsed shape and word of the tokens on either side."""
    n = len(start)
    doc = np.searchsorted(first, pick, side="right") - 1
    near = [pick + d for d in (-1, 0, 1)]
    inside = [(near[0] >= first[doc]), np.ones(len(pick), bool), near[2] < first[doc + 1]]
    use = np.unique(np.concatenate([x[ok] for x, ok in zip(near, inside)])) if len(pick) else pick
    # bytes of the used tokens only, one after the other
    length = end[use] - start[use]
    e = np.cumsum(length)
    s = e - length
    at = np.arange(int(length.sum())) + np.repeat(start[use] - s, length)
    b = buf[at]
    shape = _SHAPE[b]
    run = np.ones(len(b), bool)
    run[1:] = shape[1:] != shape[:-1]
    run[s] = True
    exact = word_hashes(shape, s, e)
    brief = _hash_kept(shape, run, s, e)
    word = _hash_kept(b, _IS_ALNUM[b], s, e)
    digit = np.concatenate([[0], np.cumsum(shape == ord("0"))])
    n_digit = np.minimum(digit[e] - digit[s], 20).astype(np.uint64)
    cols = []
    own = np.searchsorted(use, pick)
    for i, h in enumerate((exact, brief, word, mix(n_digit + _U(1)), mix(n_digit * _U(64) + np.minimum(length, 40).astype(np.uint64)))):
        cols.append(mix(h[own] + _U(101 + i)))
    for side, x, ok in ((1, near[0], inside[0]), (2, near[2], inside[2])):
        j = np.searchsorted(use, np.where(ok, x, pick))
        for i, h in enumerate((brief, word)):
            cols.append(mix(np.where(ok, h[j], _U(7)) + _U(1000 * side + i)))
    assert n >= len(use)
    return (np.stack(cols, axis=1) % _U(SLOTS)).astype(np.int32) if len(pick) else np.zeros((0, 9), np.int32)


def _allowed() -> np.ndarray:
    """Transition mask: inside labels follow their own kind only."""
    ok = np.ones((len(LABELS), len(LABELS)), bool)
    for j, b in enumerate(LABELS):
        if b[0] == "I":
            ok[:, j] = [a[2:] == b[2:] and a != "O" for a in LABELS]
    return ok


# ------------------------------------------------------------------ training
def _read_labelled(rows: list) -> tuple[list, list]:
    texts, spans = [], []
    for row in rows:
        text, marks, at = "", [], 0
        for m in re.finditer(r"\[(\w+):([^\]]*)\]", row):
            text += row[at:m.start()]
            marks.append((len(text), m.group(1), len(text) + len(m.group(2))))
            text += m.group(2)
            at = m.end()
        texts.append(text + row[at:])
        spans.append(marks)
    return texts, spans


class Tagger:
    """Weights of the field: SLOTS x labels, and transitions between labels."""

    def __init__(self, weight: np.ndarray, trans: np.ndarray):
        self.weight, self.trans = weight.astype(np.float32), trans.astype(np.float32)


def train(rows: list = LABELLED, rounds: int = ROUNDS, penalty: float = PENALTY) -> Tagger:
    """Maximise the penalised likelihood of the labelled runs (Adam, forward-backward)."""
    texts, spans = _read_labelled(rows)
    buf, off = text_bytes(pa.array(texts, pa.large_string()))
    start, end, first, marked = tokens(buf, off)
    pick = labelable(buf, start, end, first, marked)
    feat = features(buf, start, end, first, pick)
    doc = np.searchsorted(first, pick, side="right") - 1
    gold = np.zeros(len(pick), np.int64)
    for i, t in enumerate(pick):
        a, b = start[t] - off[doc[i]], end[t] - off[doc[i]]        # the table is ASCII
        for s, kind, e in spans[doc[i]]:
            if a < e and b > s:
                opened = i > 0 and pick[i - 1] == t - 1 and gold[i - 1] > 0 and start[t - 1] - off[doc[i]] >= s
                gold[i] = LABELS.index(("I-" if opened else "B-") + kind)
    runs = _runs(pick, doc)
    n_lab, width = len(LABELS), int(np.diff(runs).max())
    n_runs = len(runs) - 1
    length = np.diff(runs)
    grid = np.full((n_runs, width), -1)
    for r in range(n_runs):
        grid[r, :length[r]] = np.arange(runs[r], runs[r + 1])
    on = grid >= 0
    ok = _allowed()
    used, feat_c = np.unique(feat, return_inverse=True)
    feat_c = feat_c.reshape(feat.shape)
    w, tr = np.zeros((len(used), n_lab)), np.zeros((n_lab, n_lab))
    m1, v1, m2, v2 = (np.zeros_like(x) for x in (w, w, tr, tr))
    # gold counts
    prev = np.concatenate([[0], gold[:-1]])
    prev[runs[:-1]] = 0
    gold_tr = np.zeros_like(tr)
    np.add.at(gold_tr, (prev, gold), 1)
    np.add.at(gold_tr, (gold[runs[1:] - 1], np.zeros(n_runs, np.int64)), 1)

    def lse(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

    for step in range(1, rounds + 1):
        em = w[feat_c].sum(axis=1)
        t = np.where(ok, tr, -1e6)
        e = np.where(on[:, :, None], em[np.maximum(grid, 0)], 0.0)
        alpha = np.zeros((n_runs, width, n_lab))
        beta = np.zeros((n_runs, width, n_lab))
        alpha[:, 0] = t[0] + e[:, 0]
        for i in range(1, width):
            a = lse(alpha[:, i - 1, :, None] + t[None], 1) + e[:, i]
            alpha[:, i] = np.where(on[:, i, None], a, alpha[:, i - 1])
        beta[:, width - 1] = t[:, 0]
        for i in range(width - 2, -1, -1):
            b = lse(t[None] + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
            beta[:, i] = np.where(on[:, i + 1, None], b, t[:, 0])
        z = lse(alpha[:, -1] + t[:, 0], 1)
        p = np.exp(alpha + beta - z[:, None, None])
        grad = np.zeros((len(gold), n_lab))
        grad[grid[on]] = -p[on]
        grad[np.arange(len(gold)), gold] += 1
        g1 = np.zeros_like(w)
        for c in range(feat_c.shape[1]):
            np.add.at(g1, feat_c[:, c], grad)
        g2 = gold_tr.copy()
        g2[0] -= p[:, 0].sum(axis=0)
        last = length - 1
        g2[:, 0] -= p[np.arange(n_runs), last].sum(axis=0)
        for i in range(1, width):
            q = alpha[:, i - 1, :, None] + t[None] + (e[:, i] + beta[:, i])[:, None, :] - z[:, None, None]
            g2 -= np.exp(q[on[:, i]]).sum(axis=0)
        for x, g, m, v in ((w, g1 - penalty * w, m1, v1), (tr, g2 - penalty * tr, m2, v2)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    weight = np.zeros((SLOTS, n_lab))
    weight[used] = w
    return Tagger(weight, np.where(ok, tr, _FORBID))


def _runs(pick: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Offsets of the runs of neighbouring picked tokens of one text."""
    if not len(pick):
        return np.zeros(1, np.int64)
    cut = (np.diff(pick) != 1) | (np.diff(doc) != 0)
    return np.concatenate([[0], np.flatnonzero(cut) + 1, [len(pick)]])


def decode(em: np.ndarray, runs: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best labels of every run between two outside tokens; runs step together."""
    n = np.diff(runs)
    order = np.argsort(-n, kind="stable")
    start, n = runs[:-1][order], n[order]
    label = np.zeros(len(em), np.int32)
    if not len(n):
        return label
    active = len(n) - np.searchsorted(n[::-1], np.arange(int(n[0])), side="right")
    back = np.zeros(em.shape, np.int8)
    v = trans[0] + em[start]
    for t in range(1, int(n[0])):
        k = int(active[t])
        q = v[:k, :, None] + trans[None]
        back[start[:k] + t] = q.argmax(axis=1)
        v[:k] = q.max(axis=1) + em[start[:k] + t]
    cur = (v + trans[:, 0]).argmax(axis=1)
    for t in range(int(n[0]) - 1, -1, -1):
        k = int(active[t])
        rows = start[:k] + t
        label[rows] = cur[:k]
        cur[:k] = back[rows, cur[:k]]
    return label


def _valid(kind: str, s: str) -> bool:
    """The exact check behind the tagger."""
    d = _digits(s)
    if kind == "email":
        return False                      # every well-formed address is a base span
    if kind == "ip":
        return False                      # likewise
    if kind == "card":
        return 12 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 7 <= len(d) <= 15 and not re.search("[A-Za-z]", s)
    if kind == "ssn":
        return re.fullmatch("[0-9]{3}-[0-9]{2}-[0-9]{4}", s) is not None
    x = re.sub("[^A-Za-z0-9]", "", s).upper()
    return 15 <= len(x) <= 34 and int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1 if x.isascii() else False


def _account_ends(a: int, b: int, pick: set) -> list:
    """Last tokens to try for an IBAN tagged a to b: b, those behind it in its run, those before it."""
    more = b
    while more + 1 in pick and more - a < 12:
        more += 1
    return [b, *range(b + 1, more + 1), *range(b - 1, a, -1)]


def find_spans(tagger: Tagger, arr: pa.Array) -> list:
    """Per text: (base spans, all spans), each (start, kind number, end) in code points.  A
    tagged span counts where it passes its check and meets no base span; an IBAN may hold base
    spans, and ends at the first of the token ends near the tagged one that passes."""
    buf, off = text_bytes(arr)
    n = len(arr)
    start, end, first, marked = tokens(buf, off)
    pick = labelable(buf, start, end, first, marked)
    out: list = [([], []) for _ in range(n)]
    if not len(pick):
        return out
    doc = np.searchsorted(first, pick, side="right") - 1
    em = tagger.weight[features(buf, start, end, first, pick)].sum(axis=1)
    label = decode(em, _runs(pick, doc), tagger.trans)
    tagged: dict = {}
    opened = None
    for i in np.flatnonzero(label > 0).tolist():
        name, d, t = LABELS[label[i]], int(doc[i]), int(pick[i])
        if name[0] == "I" and opened and opened[0] == d and opened[3] == t - 1 and opened[2] == name[2:]:
            opened[3] = t
        else:
            opened = [d, t, name[2:], t]
            tagged.setdefault(d, []).append(opened)
    for d in np.unique(doc).tolist():
        t = arr[d].as_py()
        base = base_spans(t)
        extra = []
        if d in tagged:
            able = set(pick[np.searchsorted(doc, d):np.searchsorted(doc, d, side="right")].tolist())
            raw = buf[off[d]:off[d + 1]]
            lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            for _, a, kind, b in tagged[d]:
                for last in _account_ends(a, b, able) if kind == "iban" else [b]:
                    s, e = int(lead[start[a] - off[d]]), int(lead[end[last] - off[d]])
                    while s < e and not (t[s].isalnum() or t[s] in "(+"):
                        s += 1
                    while e > s and not t[e - 1].isalnum():
                        e -= 1
                    met = [x for x in base if x[0] < e and s < x[2]]
                    if s < e and _valid(kind, t[s:e]) and all(kind == "iban" and s <= x[0] and x[2] <= e for x in met):
                        if not any(x[0] < e and s < x[2] for x in extra):
                            extra.append((s, KINDS.index(kind), e))
                        break
        out[d] = (base, sorted(base + extra))
    return out


def _text(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def pii_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every whole text.

    Counts and digest are of the fixed patterns; ``spans`` adds what the field finds.  Spans
    are kind:start:end in code points, end exclusive, by start and then kind.  Null texts are
    empty; repeated rows are each reported; other columns are not read; no shuffle.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train())

    def run(batches):
        for b in pieces(batches, "text"):
            found = find_spans(shared.value, b.column(1))
            counts = [pa.array([sum(x[1] == k for x in base) for base, _ in found], pa.int64()) for k in range(len(BASE))]
            yield pa.RecordBatch.from_arrays([
                b.column(0), *counts, pa.array([hashlib.sha256(_text(base).encode()).hexdigest() for base, _ in found], pa.string()),
                pa.array([_text(every) for _, every in found], pa.string())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(t: str, spans: list) -> str:
    """The text with every span (overlapping ones together) replaced by [KIND]."""
    out, at = [], 0
    i = 0
    while i < len(spans):
        s, k, e = spans[i]
        j = i + 1
        while j < len(spans) and spans[j][0] < e:
            e = max(e, spans[j][2])
            j += 1
        out += [t[at:s], f"[{KINDS[k].upper()}]"]
        at, i = e, j
    return "".join(out) + t[at:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns, all rows) with personal data in ``text`` masked; ``n_chars``,
    where there is one and the text changed, is the new length in code points."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train())
    at, schema = docs.columns.index("text"), docs.schema
    size_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches):
        for b in pieces(batches, "text"):
            found = find_spans(shared.value, b.column(at))
            hit = [i for i, (_, every) in enumerate(found) if every]
            if hit:
                cols = list(b.columns)
                texts = cols[at].to_pylist()
                sizes = cols[size_at].to_pylist() if size_at is not None else None
                for i in hit:
                    texts[i] = masked(texts[i], found[i][1])
                    if sizes is not None:
                        sizes[i] = len(texts[i])
                cols[at] = pa.array(texts, cols[at].type)
                if sizes is not None:
                    cols[size_at] = pa.array(sizes, cols[size_at].type)
                b = pa.RecordBatch.from_arrays(cols, names=b.schema.names)
            yield b

    return docs.mapInArrow(run, schema)
