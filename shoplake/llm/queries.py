"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, licenses, mixing, ngram_join, quality_model, quality_rules, search, secrets, simhash,
               substrings, tokens, trie, warc)
from .common import table
from .sql import ORACLE_SQL as ORACLE_SQL


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.sort_array(F.concat("base", "added"))).alias("spans"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.template_table(spark)).select(
        "doc_id", "license_id", "containment", "template_id", "start_word", "n_windows")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "matched_words", "stretch_words")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.train(docs, table(spark, sf_dir, "labels")))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_signals(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(search.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_secret_scan": op2_secret_scan,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_token_output": op4_token_output,
    "op5_license_scan": op5_license_scan,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_quality_rules": op9_quality_rules,
    "op10_mixing": op10_mixing,
    "op11_ranked_search": op11_ranked_search,
    "op12_ngram_jaccard_join": op12_ngram_jaccard_join,
    "op13_conversation_trie": op13_conversation_trie,
}
