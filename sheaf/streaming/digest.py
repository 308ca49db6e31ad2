"""ST2: rolling digest input — point counts in sliding event-time windows.

The batch digest (``operators/digest.py``) keeps the reference's semantics;
this is its continuous twin for a stream of points: windows of
``window_size`` sliding by ``slide`` per collection, a watermark bounding
state and dropping data later than ``lateness``. Results are written per
micro-batch (update mode) into ``batch_id=N`` directories; a reader keeps
the newest count of each window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def window_counts(points: DataFrame, window_size: str = "4 hours", slide: str = "1 hour",
                  lateness: str = "1 hour") -> DataFrame:
    """ST2 streaming aggregate: ``collection, window, n_points``. Event time
    must be TIMESTAMP for a watermark; TIMESTAMP_NTZ input is read as UTC
    (the session zone is pinned to UTC)."""
    return (points.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
            .groupBy(F.window("ts", window_size, slide), "collection")
            .agg(F.count(F.lit(1)).alias("n_points")))


def start_digest_windows(spark: SparkSession, source: str, sink: str, checkpoint: str, schema: str,
                         window_size: str = "4 hours", slide: str = "1 hour", lateness: str = "1 hour",
                         available_now: bool = True, max_files_per_trigger: int | None = None,
                         state_partitions: int | None = None):
    """Start the windowed count stream; returns the ``StreamingQuery``.

    ``state_partitions`` fixes the number of state-store partitions. A
    stateful stream keeps that number for its whole life (it is stored in the
    checkpoint at the first batch, and adaptive execution does not apply to
    streams), so choose it for the expected state size; by default the
    session's ``spark.sql.shuffle.partitions`` is used.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source)
    counts = window_counts(stream, window_size, slide, lateness)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.select("collection",
                      F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      F.date_format("window.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
                      F.col("n_points").cast("bigint").alias("n_points"))
         .write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}"))

    writer = (counts.writeStream.outputMode("update").foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    if not state_partitions:
        return writer.start()
    # The stream runs on a clone of the session taken at start: set the
    # value only around ``start`` and leave the caller's session unchanged.
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, previous)


def latest_window_counts(spark: SparkSession, sink: str) -> DataFrame:
    df = spark.read.parquet(sink)
    return (df.groupBy("collection", "window_start", "window_end")
            .agg(F.max_by("n_points", "batch_id").alias("n_points")))
