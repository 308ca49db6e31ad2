"""Ingestion requests arriving as files (JSON lines or Parquet),
read with the explicit request schemas; the same readers feed the stream of
``streaming/ingest.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas


def read_requests(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Single-document requests (``IngestionRequest``)."""
    return spark.read.schema(schemas.INGESTION_REQUEST).format(fmt).load(path)


def read_batch_requests(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Batch requests: header plus a ``document`` list (``BatchIngestionRequest``)."""
    return spark.read.schema(schemas.BATCH_REQUEST).format(fmt).load(path)
