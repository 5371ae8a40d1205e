"""Operator 3, language identification with spans.

Letters are grouped into words by script; the script narrows the candidate languages of a
word; each candidate scores it by smoothed log-probabilities of its hashed character
trigrams; Viterbi with a penalty per switch labels the words of a text, so mixed-language
texts fall into spans.  The language of a text is the one with most letters.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import pieces, prepare

# fixed values: script ranges (first, last code point); other letters form one script
SCRIPTS = [
    ("latin", [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)]),
    ("greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("cyrillic", [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)]),
    ("armenian", [(0x531, 0x58F)]),
    ("hebrew", [(0x590, 0x5FF)]),
    ("arabic", [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)]),
    ("devanagari", [(0x900, 0x97F)]),
    ("bengali", [(0x980, 0x9FF)]),
    ("gurmukhi", [(0xA00, 0xA7F)]),
    ("gujarati", [(0xA80, 0xAFF)]),
    ("tamil", [(0xB80, 0xBFF)]),
    ("telugu", [(0xC00, 0xC7F)]),
    ("kannada", [(0xC80, 0xCFF)]),
    ("malayalam", [(0xD00, 0xD7F)]),
    ("thai", [(0xE00, 0xE7F)]),
    ("georgian", [(0x10A0, 0x10FF)]),
    ("hangul", [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)]),
    ("kana", [(0x3040, 0x30FF), (0x31F0, 0x31FF)]),
    ("han", [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x33FFF)]),
]
BUCKETS = 1 << 15                # hashed trigrams; a model has languages x BUCKETS floats
DOCS_PER_LANGUAGE = 4000         # bound of the training sample
SWITCH_PENALTY = 12.0
SCRIPT_SHARE = 0.01              # of a language's training letters, for it to be a candidate
PIECE = 2 * 1024 * 1024
UND = "und"
MAX_LANGUAGES = 400              # learned: those with the most training documents (a model has BUCKETS floats each)
_LIMIT = 0x34000                 # no letter stands beyond
_TABLES: list = []


def _tables():
    """(script number per code point, 0 for what is no letter or mark; lower case per code point;
    whether a code point is a letter)."""
    if not _TABLES:
        cat = [unicodedata.category(chr(c))[0] for c in range(_LIMIT)]
        part = np.array([c in "LM" for c in cat])            # a mark belongs to a word, but makes none
        letter = np.array([c == "L" for c in cat])
        script = np.where(part, len(SCRIPTS) + 1, 0).astype(np.uint8)
        for i, (_, ranges) in enumerate(SCRIPTS):
            for a, b in ranges:
                script[a:b + 1] = np.where(part[a:b + 1], i + 1, 0)
        lower = np.arange(_LIMIT, dtype=np.uint32)
        for c in range(_LIMIT):
            if cat[c] == "L":
                x = chr(c).lower()
                if len(x) == 1:
                    lower[c] = ord(x)
        _TABLES[:] = [script, lower, letter]
    return _TABLES


def words(texts: list):
    """Words of texts (null as empty): trigram bucket per letter, word starts among the
    letters, script per word, first word per text, code-point start and end per word."""
    script, lower, letter = _tables()
    texts = [t or "" for t in texts]
    cp = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.concatenate([[0], np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))])
    cp = np.where(cp < _LIMIT, cp, _LIMIT - 1) if len(cp) and cp.max() >= _LIMIT else cp
    cls = script[cp]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], cls, [0]]).astype(np.int16)))
    start, end = edge[:-1], edge[1:]
    on = cls[start] > 0 if len(start) else np.zeros(0, bool)
    start, end = start[on], end[on]
    letters = np.concatenate([[0], np.cumsum(letter[cp])])
    some = letters[end] > letters[start]
    if not some.all():                                       # runs of marks alone
        for a, b in zip(start[~some].tolist(), end[~some].tolist()):
            cls[a:b] = 0
        start, end = start[some], end[some]
    at = np.flatnonzero(cls)
    c = lower[cp[at]]
    length = end - start
    first_at = np.concatenate([[0], np.cumsum(length)])[:-1]
    prev = np.concatenate([[0], c[:-1]]).astype(np.uint32) if len(c) else c
    nxt = np.concatenate([c[1:], [0]]).astype(np.uint32) if len(c) else c
    prev[first_at] = 0
    nxt[first_at + length - 1] = 0
    with np.errstate(over="ignore"):
        h = (prev * np.uint32(0x9E3779B1) + c) * np.uint32(0x85EBCA6B) + nxt * np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h >>= np.uint32(32 - 15)
    first = np.searchsorted(start, begin, side="left")
    return h, first_at, cls[start] if len(start) else np.zeros(0, np.uint8), first, start, end, begin


class Model:
    """Languages, trigram log-probabilities (BUCKETS x languages), candidates by script."""

    def __init__(self, languages: list, counts: np.ndarray, letters: np.ndarray, docs: np.ndarray):
        self.languages = languages
        n = counts.sum(axis=1, keepdims=True)
        self.table = np.ascontiguousarray(np.log((counts + 0.5) / (n + 0.5 * BUCKETS)).T.astype(np.float32))
        share = letters / np.maximum(letters.sum(axis=1, keepdims=True), 1)
        self.candidate = (share >= SCRIPT_SHARE).T           # script x language
        self.prior = int(np.argmax(docs)) if len(docs) else -1


def fit(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Learn from at most about ``per_language`` documents of each non-null ``lang`` with
    crc32(doc_id) mod 4 other than 2, chosen by a hash of doc_id; of more than MAX_LANGUAGES values
    of ``lang`` those with the most documents are learned.  Null texts teach nothing."""
    spark = docs.sparkSession
    train = docs.where(F.col("lang").isNotNull() & ~held_out()).select("doc_id", "text", "lang")
    per = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()}
    langs = sorted(per)
    if not langs:
        return Model([], np.zeros((0, BUCKETS)), np.zeros((0, len(SCRIPTS) + 2)), np.zeros(0))
    cut = F.create_map(*[x for v in langs for x in (F.lit(v), F.lit(int(min(1.0, per_language / per[v]) * (1 << 20)) + 1))])
    taken = train.where(F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 20)) < F.element_at(cut, F.col("lang")))
    number = {v: i for i, v in enumerate(langs)}
    width = BUCKETS + len(SCRIPTS) + 2

    def count(batches):
        total = np.zeros((len(langs), width), np.int64)
        for b in pieces(batches, "text", PIECE):
            h, first_at, scr, first, start, end, _ = words(b.column(0).to_pylist())
            lang = np.array([number[v] for v in b.column(1).to_pylist()], np.int64)
            of_word = np.repeat(lang, np.diff(first))
            of_letter = np.repeat(of_word, end - start)
            total += np.bincount(of_letter * width + h, minlength=total.size).reshape(total.shape)
            total += np.bincount(of_word * width + BUCKETS + scr, weights=end - start,
                                 minlength=total.size).reshape(total.shape).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at // width), pa.array(at % width), pa.array(total.ravel()[at])],
                                         names=["lang", "slot", "n"])

    got = (taken.select("text", "lang").mapInArrow(count, "lang long, slot long, n long")
           .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow())
    c = np.zeros((len(langs), width))
    c[np.asarray(got["lang"]), np.asarray(got["slot"])] = np.asarray(got["n"])
    return Model(langs, c[:, :BUCKETS], c[:, BUCKETS:], np.array([per[v] for v in langs]))


def viterbi(score: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word: sum of scores minus ``penalty`` per switch inside a text.
    All texts of a batch step together; ties go to the smaller label."""
    n_words, n_lab = score.shape
    label = np.zeros(n_words, np.int32)
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    if not len(order):
        return label
    start, n = first[:-1][order], n[order]
    active = len(n) - np.searchsorted(n[::-1], np.arange(int(n[0])), side="right")     # texts with more than t words
    stay = np.ones((n_words, n_lab), bool)
    source = np.zeros(n_words, np.int32)
    v = score[start]
    lines = np.arange(len(n))
    for t in range(1, int(n[0])):
        k = int(active[t])
        rows = start[:k] + t
        u = v[:k]
        best = u.argmax(axis=1)
        jump = (u[lines[:k], best] - penalty)[:, None]
        keep = u >= jump
        stay[rows] = keep
        source[rows] = best
        v[:k] = np.where(keep, u, jump) + score[rows]
    cur = v.argmax(axis=1)
    for t in range(int(n[0]) - 1, -1, -1):
        k = int(active[t])
        rows = start[:k] + t
        label[rows] = cur[:k]
        cur[:k] = np.where(stay[rows, cur[:k]], cur[:k], source[rows])
    return label


def label_words(model: Model, texts: list):
    """(label per word, words as of :func:`words`) of texts under the model."""
    w = words(texts)
    h, first_at, scr, first = w[:4]
    n_lab = len(model.languages)
    if not n_lab or not len(scr):
        return np.zeros(len(scr), np.int32), w
    score = np.add.reduceat(model.table[h], first_at, axis=0)
    cand = model.candidate[scr]
    some = cand.any(axis=1)
    score = np.where(cand, score, np.where(some[:, None], np.float32(-1e4), np.float32(0)))
    return viterbi(score, first, SWITCH_PENALTY), w


def predict_texts(model: Model, texts: list):
    """(language or None per text, share of its letters, has a letter)."""
    label, (_, _, _, first, start, end, _) = label_words(model, texts)
    n, n_lab = len(texts), max(1, len(model.languages))
    doc = np.repeat(np.arange(n), np.diff(first))
    mass = np.bincount(doc * n_lab + label, weights=(end - start).astype(float), minlength=n * n_lab).reshape(n, n_lab)
    total = mass.sum(axis=1)
    return mass.argmax(axis=1), mass.max(axis=1) / np.maximum(total, 1), total > 0


def held_out() -> F.Column:
    """Whether crc32(doc_id as text) mod 4 is 2 (false for a null doc_id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every whole text.

    ``lang_pred`` is a learned language, or ``und`` for a null text, a text without a letter,
    or when no language could be learned; ``score`` is the share of the text's letters in
    spans of that language (0 for ``und``).  Only the text enters a prediction; letters of a
    script that no language was seen in decide nothing by themselves.  Repeated rows are each
    labelled; an empty table gives an empty result; other columns are not read.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def run(batches):
        model = shared.value
        for b in pieces(batches, "text", PIECE):
            lab, share, has = predict_texts(model, b.column(1).to_pylist())
            known = has & bool(model.languages)
            names = [model.languages[i] if k else UND for i, k in zip(lab.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(np.where(known, share, 0.0)),
                                              b.column(2)], names=["doc_id", "lang_pred", "score", "held_out"])

    src = docs.select("doc_id", "text", held_out().alias("held_out"))
    kind = src.schema["doc_id"].dataType.simpleString()
    out = src.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, held_out boolean")
    return out.select("doc_id", "held_out", "lang_pred", "score")


def language_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, start, end, lang``: spans of consecutive words of one language, code points."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def run(batches):
        model = shared.value
        for b in pieces(batches, "text", PIECE):
            label, (_, _, _, first, start, end, begin) = label_words(model, b.column(1).to_pylist())
            doc = np.repeat(np.arange(b.num_rows), np.diff(first))
            if not len(doc) or not model.languages:
                continue
            head = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (label[1:] != label[:-1])]))
            tail = np.append(head[1:], len(doc)) - 1
            d = doc[head]
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(d)), pa.array(start[head] - begin[d]), pa.array(end[tail] - begin[d]),
                pa.array([model.languages[i] for i in label[head].tolist()], pa.string())], names=["doc_id", "start", "end", "lang"])

    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, start long, end long, lang string")


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the documents that have no letter; a null ``lang`` is
    filled with the predicted language where there is one."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    at, lang_at, schema = docs.columns.index("text"), docs.columns.index("lang"), docs.schema

    def run(batches):
        model = shared.value
        for b in pieces(batches, "text", PIECE):
            lab, _, has = predict_texts(model, b.column(at).to_pylist())
            lang = b.column(lang_at)
            if lang.null_count and model.languages:
                guess = pa.array([model.languages[i] if h else None for i, h in zip(lab.tolist(), has.tolist())], lang.type)
                cols = list(b.columns)
                cols[lang_at] = pc.coalesce(lang, guess)
                b = pa.RecordBatch.from_arrays(cols, names=b.schema.names)
            yield b.filter(pa.array(has))

    return docs.mapInArrow(run, schema)
