"""Training-data pipeline over ``documents``: rules, near-duplicates, decontamination, secrets, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor
kept; its result is written as Parquet to the shared folder and read again as
the next one's ``docs``, so a lost executor never costs more than a stage. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheaf.llm import bpe, decontaminate, line_rules, secret_scan, simhash
from sheaf.llm.common import materialise, read, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, and the others' lines above the limits; ``n_chars`` follows."""
    return line_rules.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; ``n_chars`` follows."""
    return secret_scan.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` and token ``ids`` of each document."""
    return bpe.encode(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("tokens", tokens)]

#: Fingerprints, a trained forest and a tokenizer are beyond SQL; ``tests/llm`` holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
