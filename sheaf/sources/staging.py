"""Staging between transform and load.

Staged data is written once per run under a run id fixed on the driver
(F16), partitioned by community, in a shared file system; the returned key
is the run directory. Re-running a task rewrites the same files, so a
retried load is idempotent.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from .. import schemas


def run_id(now: datetime | None = None) -> str:
    """F16: UTC time of the run, ISO-like but safe in file system paths."""
    now = now or datetime.now(tz=timezone.utc)
    return now.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%S.%fZ")


def staging_key(root: str, activity: str, rid: str) -> str:
    """K3: ``{root}/{activity}/{run}``; communities are partitions below it
    (``community_id=…``)."""
    return f"{root.rstrip('/')}/{activity}/{rid}"


def _store(df: DataFrame, root: str, activity: str, rid: str | None, fmt: str) -> str:
    key = staging_key(root, activity, rid or run_id())
    df.hint("rebalance", "community_id").write.mode("overwrite").partitionBy("community_id").format(fmt).save(key)
    return key


def store_extracted(df: DataFrame, root: str, rid: str | None = None, fmt: str = "json") -> str:
    """K1: stage extracted rows (must carry ``community_id``)."""
    return _store(df, root, "extracted", rid, fmt)


def store_transformed(docs: DataFrame, root: str, rid: str | None = None, fmt: str = "json") -> str:
    """K2: stage transformed documents (must carry ``community_id``)."""
    return _store(docs, root, "transformed", rid, fmt)


def read_staged(spark: SparkSession, key: str, fmt: str = "json",
                schema: str = schemas.DOCUMENTS + ", community_id string",
                require_rows: bool = True) -> DataFrame:
    """S9 + S10 + S11: staged documents by key with the explicit document
    schema; a missing key and (by default) an empty result are errors."""
    try:
        df = spark.read.schema(schema).format(fmt).load(key)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise ValueError(f"nothing is staged under {key}") from exc
        raise
    if require_rows and df.isEmpty():
        raise ValueError(f"no transformed documents are staged under {key}")
    return df
