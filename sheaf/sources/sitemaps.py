"""S8 source: sitemap files. A sitemap is bounded by its protocol (50,000
URLs per file), so each file is read whole as one row; many files are read
in parallel, one row per file, ready for ``operators.web.sitemap_links``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_sitemaps(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """Rows ``sitemap_url`` (the file) and ``content`` (its text)."""
    return (spark.read.option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").text(path, wholetext=True)
            .select(F.input_file_name().alias("sitemap_url"), F.col("value").alias("content")))
