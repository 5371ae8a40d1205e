"""Operator 13, byte-level BPE encoding and decoding from a file of ranks.

A piece of text (one match of the splitting pattern) is encoded without running its merges:
pyahocorasick, over bytes mapped to Latin-1 characters, finds the longest token at every byte;
from the left the longest one is taken that is compatible with the token before it, and where
none is, the search steps back.  Two adjacent tokens are compatible if merging their joined
bytes gives just them.  A sequence whose neighbours are all compatible is the result of the
merges: the first merge over a border between tokens would have been made in that pair alone
too.  A place from which the search has stepped back is never entered again (what leads to it is
the one encoding of the bytes before it), so the work is linear in the piece.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from itertools import batched, chain
from operator import methodcaller

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fresh, pieces, prepare

ENCODE_BYTES = 256 * 1024        # of text encoded at once
LONG_TEXT = 1 << 20              # characters beyond which a text is split into pieces bit by bit
PAIRS = 1 << 18                  # remembered pairs of tokens (new ones; as many old ones stay)
WORDS = 1 << 18                  # remembered pieces of at most WORD_CHARS characters (likewise)
WORD_CHARS = 32
IDS = 1 << 16                    # ids decoded at once
_LOADED: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """``token bytes -> rank`` of a file with one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """What the merges make of a short piece: again and again the adjacent pair whose joined bytes
    have the lowest rank (the leftmost of equals) becomes one."""
    none = 1 << 62
    rank = ranks.get
    parts = [piece[i:i + 1] for i in range(len(piece))]
    joined = [rank(piece[i:i + 2], none) for i in range(len(piece) - 1)]     # of each part and the next
    while joined and (low := min(joined)) < none:
        i = joined.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del joined[i]
        if i < len(joined):
            joined[i] = rank(parts[i] + parts[i + 1], none)
        if i:
            joined[i - 1] = rank(parts[i - 1] + parts[i], none)
    return parts


class _Memo(dict):
    """Results by key, computed when missing.  At ``most`` entries they become the old ones, from
    which a key still in use comes back; what was old before is forgotten."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class _Words(_Memo):
    """A memo of pieces that keeps no long ones."""

    def __missing__(self, key):
        return super().__missing__(key) if len(key) <= WORD_CHARS else self.compute(key)


class ByteBpe:
    """Encoder and decoder of one file of ranks and one splitting pattern."""

    def __init__(self, path: str, pattern: str):
        import ahocorasick
        import regex
        self.ranks = read_ranks(path)
        lacking = [b for b in range(256) if bytes([b]) not in self.ranks]
        if lacking:
            raise ValueError(f"no token for the bytes {lacking[:5]} ...")
        self.token = {r: t for t, r in self.ranks.items()}
        self.size = {r: len(t) for r, t in self.token.items()}
        self.most = max(self.token) + 1
        self.split = regex.compile(pattern)
        self.trie = ahocorasick.Automaton()
        for t, r in self.ranks.items():
            self.trie.add_word(t.decode("latin-1"), r)
        self.trie.make_automaton()
        self.shorter = _Memo(self._shorter, self.most)
        self.fits = _Memo(self._fits, PAIRS)
        self.alone = _Memo(self._alone, self.most)
        self.words = _Words(lambda p: tuple(self.piece_ids(p.encode())), WORDS)

    def _shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of this one, or -1."""
        t = self.token[token]
        return next((self.ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ranks), -1)

    def _alone(self, token: int) -> bool:
        """Whether merging a token's bytes gives the token: some tokens no merges reach."""
        return merged(self.token[token], self.ranks) == [self.token[token]]

    def _fits(self, pair: int) -> bool:
        a, b = (self.token[x] for x in divmod(pair, self.most))
        return merged(a + b, self.ranks) == [a, b]

    def piece_ids(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token as a whole is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, size, shorter, fits, alone, most = len(piece), self.size, self.shorter, self.fits, self.alone, self.most
        longest = [-1] * n
        for end, t in self.trie.iter(piece.decode("latin-1")):
            longest[end + 1 - size[t]] = t               # ends ascend: the last one is the longest
        out: list[int] = []
        dead = bytearray(n + 1)
        at, t = 0, longest[0] if n else -1
        while at < n:
            last = out[-1] * most if out else -1
            while t >= 0 and (dead[at + size[t]] or not (fits[last + t] if out else alone[t])):
                t = shorter[t]
            if t >= 0:
                out.append(t)
                at += size[t]
                t = longest[at] if at < n else -1
            else:
                dead[at] = 1
                t = out.pop()
                at -= size[t]
                t = shorter[t]
        return out

    def encode(self, text: str) -> array:
        """Ids of a whole text, special strings as ordinary text."""
        out = array("i")
        if len(text) <= LONG_TEXT:
            out.extend(chain.from_iterable(map(self.words.__getitem__, self.split.findall(text))))
        else:
            for some in batched(map(methodcaller("group"), self.split.finditer(text)), IDS):
                out.extend(chain.from_iterable(map(self.words.__getitem__, some)))
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def tokenizer(path: str, pattern: str) -> ByteBpe:
    """The encoder of a file, loaded once a worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBpe(path, pattern)
    return _LOADED[path, pattern]


def _lists(arr: pa.Array):
    """(values as numpy, offsets) of a list<int> array without nulls."""
    off = np.asarray(arr.offsets).astype(np.int64)
    return np.asarray(arr.values), off


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` (all columns) and ``ids`` (array of int; another name where that one is taken).

    Null and empty texts have no ids; every row is encoded whole; an empty table gives an
    empty result.  Nothing is shuffled.
    """
    prepare(docs.sparkSession)
    src = docs.withColumn(fresh("_text", docs.columns), F.coalesce(F.col(f"`{text}`"), F.lit("")))
    at = len(src.columns) - 1

    def run(batches):
        enc = tokenizer(path, pattern)
        for b in pieces(batches, b_text, ENCODE_BYTES):
            off, ids = [0], array("i")
            for t in b.column(at).to_pylist():
                ids.extend(enc.encode(t))
                off.append(len(ids))
            col = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.frombuffer(ids, np.int32) if ids else np.zeros(0, np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns[:at], col], names=names)

    b_text = src.columns[-1]
    names = [*docs.columns, fresh("ids", docs.columns)]
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
    return src.mapInArrow(run, StructType([*docs.schema.fields, StructField(names[-1], ArrayType(IntegerType()))]))


def decoded(rows: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``rows`` and ``bytes`` (binary): the bytes of the tokens in ``ids``; null ids give null,
    an unknown id raises."""
    prepare(rows.sparkSession)

    @F.arrow_udf("binary")
    def join(x: pa.Array) -> pa.Array:
        enc = tokenizer(path, pattern)
        return pa.array([None if v is None else enc.decode(v) for v in x.to_pylist()], pa.binary())

    return rows.withColumn(fresh("bytes", rows.columns), join(F.col(f"`{ids}`")))


def bpe_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text: digests of its ids in
    decimal, joined by commas, and of the bytes that they decode to.  Both digests are taken a
    bounded number of ids at a time."""
    rows = encoded(docs.select("doc_id", "text"), path, pattern).select("doc_id", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        enc = tokenizer(path, pattern)
        for b in batches:
            ids, off = _lists(b.column(1))
            names, texts = [], []
            for s, e in zip(off[:-1].tolist(), off[1:].tolist()):
                h, d = hashlib.sha256(), hashlib.sha256()
                for k in range(s, e, IDS):
                    part = ids[k:min(e, k + IDS)].tolist()
                    h.update((("," if k > s else "") + ",".join(map(str, part))).encode())
                    d.update(enc.decode(part))
                names.append(h.hexdigest())
                texts.append(d.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(off)), pa.array(names, pa.string()), pa.array(texts, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
