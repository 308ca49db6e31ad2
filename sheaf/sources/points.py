"""The stored point table of summary / digest collections.

Parquet partitioned by ``collection`` and ``month`` (the first seven letters of
``date``): predicates on them, also those of a request table joined to the
store (dynamic partition pruning), leave other folders unread; ``date`` and
``createdAt`` predicates are pushed into the scan (row-group skipping), and the
payload is read without any vector column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import staged

POINT_COLUMNS = ["collection", "point_id", "date", "createdAt", "_node_content"]


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.substring("date", 1, 7))


def write_points(points: DataFrame, path: str) -> str:
    """Replace the written collections' months only (dynamic partition overwrite);
    rows sorted by date inside each file so that date filters skip row groups."""
    (with_month(points.select(*POINT_COLUMNS)).hint("rebalance", "collection", "month")
     .sortWithinPartitions("collection", "month", "date", "point_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("collection", "month").parquet(path))
    return path


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return scan_points(spark, path).select(*POINT_COLUMNS)


def scan_points(spark: SparkSession, path: str) -> DataFrame:
    """The store with its partition column ``month``."""
    return spark.read.schema(f"{schemas.POINTS.rstrip()}, month string").parquet(path)


def latest_stored_dates(store: DataFrame, wanted: DataFrame) -> DataFrame:
    """A1 on the store: the latest date of each ``wanted`` collection.

    The newest month comes from the partition columns alone; only its folder is read for dates.
    Small sides are staged (a row for each collection asked for), so the planner knows their size and sends them
    to the executors; the comparisons tell it that they are selective enough to prune folders by.
    """
    wanted = staged(wanted, "wanted").filter(F.col("collection") > "")
    months = staged(store.select("collection", "month").join(wanted, "collection", "left_semi")
                    .groupBy("collection").agg(F.max("month").alias("month")), "months").filter(F.col("month") > "")
    latest = (store.select("collection", "month", "date").join(months, ["collection", "month"], "left_semi")
              .groupBy("collection").agg(F.max("date").alias("date")))
    return staged(latest, "latest")
