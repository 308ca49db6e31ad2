"""Configuration scans (S1, S2): module and platform documents.

Documents arrive as JSON lines or Parquet exported from the configuration
store; both are read with the explicit schemas of ``schemas.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def read_modules(spark: SparkSession, path: str, fmt: str = "json",
                 platform_name: str | None = None) -> DataFrame:
    """Modules having a platform of ``platform_name``, without ``name``."""
    df = spark.read.schema(schemas.MODULES).format(fmt).load(path)
    if platform_name is not None:
        df = df.filter(F.exists("options.platforms", lambda p: p["name"] == F.lit(platform_name)))
    return df.drop("name")


def read_platforms(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Platform documents (metadata looked up by join, see J1)."""
    return spark.read.schema(schemas.PLATFORMS).format(fmt).load(path)
