"""Registered queries of this subpackage: each applies one operator to its whole table.

The library's operators keep interfaces of their own; the digest columns of a
query are derived here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sheaf.llm import (
    bpe,
    collocation,
    decontaminate,
    divergence,
    fingerprint,
    gru_lm,
    line_rules,
    pairwise,
    secret_scan,
    sharding,
    simhash,
    token_counts,
    warc,
)
from sheaf.llm.common import read, tokenizer_path


def op1_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.capture_histories(read(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op5_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.log_likelihood(read(spark, sf_dir, "documents"))


def op6_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(read(spark, sf_dir, "documents")).drop("text_hash")


def op7_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.findings(read(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op10_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(read(spark, sf_dir, "documents")).drop("path", "place")


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_bpe_automaton, op2_decontamination, op3_warc_index, op4_simhash, op5_gru_lm, op6_line_frequency,
        op7_pairwise_quality, op8_secret_scan, op9_token_counts, op10_jump_sharding,
        op11_source_divergence, op12_collocations, op13_fingerprints)}
