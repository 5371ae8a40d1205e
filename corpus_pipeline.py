"""Corpus pipeline: documents -> words to take of each document that stays.

Every stage takes all its predecessor kept and returns the columns of ``documents``; the last
returns the mix.  ``run`` writes each stage as Parquet and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from netsieve.llm.common import load, stored
from netsieve.llm.language import identified
from netsieve.llm.mixing import mix_report
from netsieve.llm.near import near_dedup
from netsieve.llm.pii import redact
from netsieve.llm.suffix import remove_contaminated


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without a letter go; a null ``lang`` is filled."""
    return identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest doc_id."""
    return near_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return remove_contaminated(docs, load(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in their texts."""
    return redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: words to take of every document (repeats counted), by source targets."""
    return mix_report(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# near-duplicate classes and language models are beyond SQL; tested against brute force
ORACLE_SQL = None
