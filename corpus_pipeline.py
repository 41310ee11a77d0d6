"""Corpus pipeline: quality rules, near-duplicates, benchmark passages, source mix, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplake.llm import decontaminate, mixing, quality_rules, simhash, tokens
from shoplake.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail the line rules go, and documents that fail the base rule or lose too much text."""
    return quality_rules.clean(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the least doc_id."""
    return simhash.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the corpus; returns their index: doc_id, start, n_tokens, ids_crc32."""
    return tokens.encode_corpus(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", token_stage),
]

# SimHash and the tokenizer have no SQL form; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
