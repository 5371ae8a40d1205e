"""Operator 2, token counts through a digest cache.

Counts are stored by (tokenizer-version digest, content digest) in a Parquet table.  A run
joins the documents' digests to the stored counts, encodes each distinct missing content
once, appends the new counts to the table, and joins again.
"""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import pieces, prepare, stored

CACHE_SCHEMA = StructType([StructField("digest", StringType()), StructField("n_bytes", LongType()),
                           StructField("n_tokens", LongType()), StructField("tokenizer", StringType())])
BROADCAST_MISSES = 200_000       # digests of 64 bytes
ENCODE_BYTES = 128 * 1024        # of text encoded at once: an encoding takes many times its text
_LOADED: dict = {}


def tokenizer_digest(path: str) -> str:
    """Digest of what decides a count: the vocabulary file, the library and its version,
    and the options (library defaults, no added special tokens, no truncation)."""
    import importlib.metadata
    lib = "sentencepiece" if path.endswith(".model") else "tokenizers"
    h = hashlib.sha256(json.dumps([lib, importlib.metadata.version(lib), "no added special tokens"]).encode())
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            h.update(block)
    return h.hexdigest()[:32]


def counter(path: str):
    """``texts -> token counts`` with the library of the vocabulary file, loaded once a worker."""
    if path not in _LOADED:
        if path.endswith(".model"):
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            _LOADED[path] = lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
        else:
            import os
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            _LOADED[path] = lambda texts: [len(x) for x in t.encode_batch_fast(texts, add_special_tokens=False)]
    return _LOADED[path]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_cache(spark: SparkSession, cache_path: str, tokenizer: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row per digest."""
    if not _exists(spark, cache_path):
        return spark.createDataFrame([], CACHE_SCHEMA).drop("tokenizer")
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == tokenizer)
            .groupBy("digest").agg(F.max("n_bytes").alias("n_bytes"), F.max("n_tokens").alias("n_tokens")))


def missing_texts(docs: DataFrame, cache: DataFrame | None) -> DataFrame | None:
    """Distinct ``digest, text`` of ``docs`` whose digest is not in ``cache``; None if all are.

    What is missing is found from digests alone.  Up to BROADCAST_MISSES missing digests pick their
    texts in the scan, so only those move; more are met where the distinct texts lie."""
    distinct = docs.select("digest", "text").dropDuplicates(["digest"])
    if cache is None:
        return distinct
    missing = stored(docs.select("digest").distinct().join(cache.select("digest"), "digest", "left_anti"), "token-misses")
    n = missing.count()
    if not n:
        return None
    if n > BROADCAST_MISSES:
        return distinct.join(missing.hint("shuffle_merge"), "digest", "left_semi")
    return (docs.select("digest", "text").join(F.broadcast(missing), "digest", "left_semi")
            .dropDuplicates(["digest"]))


def fill_cache(docs: DataFrame, cache_path: str, vocabulary: str) -> DataFrame:
    """Encode the distinct contents of ``docs`` (columns ``digest, text``) that the cache
    lacks and append their counts; returns the cache of this tokenizer version."""
    spark = docs.sparkSession
    tok = tokenizer_digest(vocabulary)

    def encode(batches):
        count = counter(vocabulary)
        for b in pieces(batches, "text", ENCODE_BYTES):
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(count(texts), pa.int64()), pa.array([tok] * len(texts), pa.string())],
                names=CACHE_SCHEMA.names)

    distinct = missing_texts(docs, read_cache(spark, cache_path, tok) if _exists(spark, cache_path) else None)
    if distinct is None:
        return read_cache(spark, cache_path, tok)
    distinct.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").partitionBy("tokenizer").parquet(cache_path)
    return read_cache(spark, cache_path, tok)


def token_counts(docs: DataFrame, vocabulary: str, cache_path: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text.

    The normalised content is the text itself, null as empty (any other normalisation could
    change the count); its digest is SHA-256.  A repeated content is encoded once, a
    repeated row is counted each time; an empty table gives an empty result; other columns
    are not read.  With a cache, digests alone are moved to find the misses.  Their content is
    shuffled by digest once, after map-side de-duplication, so
    a third of all rows with one text is one row a task; the last join reads the run's counts
    as a written table, so that adaptive execution can split a hot digest.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.sha2(text.cast("binary"), 256)
    cache = fill_cache(docs.select(digest.alias("digest"), text.alias("text")), cache_path, vocabulary)
    keyed = docs.select(F.col("doc_id"), digest.alias("digest"))
    return (keyed.join(stored(cache, "token-counts"), "digest", "left")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
