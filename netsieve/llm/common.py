"""Helpers of the document operators: Arrow batches, word hashing, spans, sparse features.

A *word* here is a maximal run of the bytes 0-9, A-Z (lower-cased), a-z and >= 0x80 of
the UTF-8 text; word hashes are 64-bit and the same in every task.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import apply_conf, scratch_dir

# texts are handed to numpy in pieces of about this many bytes (a longer text is one piece)
PIECE_BYTES = 1024 * 1024
BLOCK_BYTES = 512 * 1024          # of text hashed at once
TRIM_PIECES = 16                 # pieces after which a worker gives freed memory back

_U = np.uint64


def prepare(spark: SparkSession) -> None:
    """Session settings of the document operators: small Arrow batches, so that a batch of
    long texts stays a few MB."""
    apply_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 * 1024 * 1024))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` into the shared scratch folder and read it back: cuts lineage, and a
    lost executor costs no recomputation of what led to it."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{tag}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, columns) -> str:
    """``name``, made different from every given column."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(*cols) -> F.Column:
    """128-bit hex key of a row from nullable columns (a null differs from every text)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~")) for c in cols]))


def pieces(batches, text_col: str, max_bytes: int = PIECE_BYTES):
    """Slice record batches so that each slice holds about ``max_bytes`` of text at most
    (one longer text makes a slice of its own)."""
    count = 0
    for b in batches:
        if b.num_rows == 0:
            continue
        off = text_offsets(b.column(b.schema.get_field_index(text_col)))
        i, n = 0, b.num_rows
        while i < n:
            j = int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1
            j = min(n, max(i + 1, j))
            yield b.slice(i, j - i)
            i = j
            count += 1
            if count % TRIM_PIECES == 0:
                trim()
    trim()


def trim() -> None:
    """Give freed memory back to the system: workers are used again for other stages, and what
    they keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):    # another C library
        pass


def text_offsets(arr: pa.Array) -> np.ndarray:
    """Byte offsets (n + 1) of a string array into its data buffer; nulls are empty."""
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    dt = np.int64 if wide else np.int32
    raw = np.frombuffer(arr.buffers()[1], dtype=dt)[arr.offset:arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, dt)
    return raw.astype(np.int64)


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array, offsets starting at 0; nulls are empty texts."""
    off = text_offsets(arr)
    if arr.null_count:                       # a null may leave bytes behind
        arr = arr.fill_null("")
        off = text_offsets(arr)
    if len(off) < 2 or off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(arr.buffers()[2], dtype=np.uint8)[off[0]:off[-1]], off - off[0]


def _word_table() -> np.ndarray:
    ok = np.zeros(256, bool)
    ok[0x30:0x3A] = ok[0x41:0x5B] = ok[0x61:0x7B] = True
    ok[0x80:] = True
    return ok


def _byte_values() -> np.ndarray:
    v = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
    v[0x41:0x5B] = v[0x61:0x7B]              # A-Z hash like a-z
    return v


WORD_BYTE = _word_table()
_BYTE_VALUE = _byte_values()
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)
_POW = np.ones(1, np.uint64)
_POW_INV = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _POW_INV
    if len(_POW) < n:
        n = 1 << int(n - 1).bit_length()
        with np.errstate(over="ignore"):
            _POW = np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, _U(_BASE))]), dtype=np.uint64)
            _POW_INV = np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, _U(_BASE_INV))]), dtype=np.uint64)
    return _POW, _POW_INV


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> _U(33))
        h = h * _U(0xFF51AFD7ED558CCD)
        h ^= h >> _U(29)
        h *= _U(0xC4CEB9FE1A85EC53)
        h ^= h >> _U(32)
    return h


def word_spans(buf: np.ndarray, off: np.ndarray, table: np.ndarray = WORD_BYTE) -> tuple[np.ndarray, np.ndarray]:
    """Byte (start, end) of every maximal run of ``table`` bytes; runs stop at text ends."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    w = table[buf]
    flip = np.empty(n, bool)
    flip[0] = w[0]
    np.not_equal(w[1:], w[:-1], out=flip[1:])
    edges = np.flatnonzero(flip)
    inner = off[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < n)])
    joined = inner[w[inner] & w[inner - 1]]  # a run that goes on across a text boundary
    # runs alternate: even edges open, odd edges close
    opens, closes = edges[0::2], edges[1::2]
    if len(closes) < len(opens):
        closes = np.append(closes, n)
    if len(joined):
        opens = np.sort(np.concatenate([opens, joined]))
        closes = np.sort(np.concatenate([closes, joined]))
    return opens, closes


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word; a polynomial over random byte values modulo 2^64, mixed.
    Worked off in blocks of whole words, so a very long text needs no huge arrays."""
    out = np.empty(len(start), np.uint64)
    i, n = 0, len(start)
    with np.errstate(over="ignore"):
        while i < n:
            j = max(i + 1, int(np.searchsorted(end, start[i] + BLOCK_BYTES, side="right")))
            a, b = start[i], end[j - 1]
            p, pinv = _powers(int(b - a) + 1)
            acc = np.empty(int(b - a) + 1, np.uint64)
            acc[0] = 0
            np.cumsum(_BYTE_VALUE[buf[a:b]] * p[:b - a], dtype=np.uint64, out=acc[1:])
            out[i:j] = (acc[end[i:j] - a] - acc[start[i:j] - a]) * pinv[start[i:j] - a]
            i = j
    return mix(out)


def words_of(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, word offsets per text) of a string array."""
    buf, off = text_bytes(arr)
    start, end = word_spans(buf, off)
    return word_hashes(buf, start, end), np.searchsorted(start, off, side="left")


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``k`` words inside a text, and shingle offsets per text.  A
    text of fewer than ``k`` words, but not none, has one shingle of all its words."""
    n_words = np.diff(first)
    n_sh = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    sh_first = np.concatenate([[0], np.cumsum(n_sh)])
    if sh_first[-1] == 0:
        return np.zeros(0, np.uint64), sh_first
    with np.errstate(over="ignore"):
        pad = np.concatenate([words, np.zeros(k, np.uint64)])
        h = np.zeros(len(words), np.uint64)
        mult = 1
        for j in range(k):
            h += pad[j:j + len(words)] * _U(mult)
            mult = mult * 0xD1342543DE82EF95 % 2**64
        doc = np.repeat(np.arange(len(n_sh)), n_sh)
        pos = first[:-1][doc] + (np.arange(sh_first[-1]) - sh_first[:-1][doc])
        out = h[pos]
        short = np.flatnonzero((n_words > 0) & (n_words < k))
        for d in short:                      # at most k - 1 words each
            acc, mult = 0, 1
            for x in words[first[d]:first[d + 1]].tolist():
                acc = (acc + x * mult) % 2**64
                mult = mult * 0xD1342543DE82EF95 % 2**64
            out[sh_first[d]] = acc ^ int(n_words[d])
    return mix(out), sh_first


def code_points(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Code points of each text."""
    lead = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    return lead[off[1:]] - lead[off[:-1]]
