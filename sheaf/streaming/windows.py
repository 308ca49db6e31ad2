"""ST2: digest texts of sliding windows, from keyed state with timers.

Each point belongs to the windows that cover its event time. The state of a
(collection, window) holds its points' digest lines, at most ``limit`` of them
(those with the least ids, as the batch digest keeps them), so it is bounded
however many points a window gets. A micro-batch emits the digests that it
changed; an event-time timer drops a window's state once the watermark has
passed its end. Results go to ``batch_id=N`` folders; readers keep the newest
digest of each window, so a batch that is replayed changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.payload import NO_TEXT_CONTENT, digest_line
from ..operators.digest import DIGEST_LIMIT
from .state import stateful_writer

DIGEST = "collection string, window_start timestamp, window_end timestamp, n_points long, n_texts long, digest string"


class WindowDigest(StatefulProcessor):
    """Keeps the first ``limit`` points of a (collection, window start) and emits their joined lines."""

    def __init__(self, limit: int, size_ms: int):
        self.limit, self.size_ms = limit, size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.points = handle.getValueState("points", "ids array<bigint>, lines array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = not self.points.exists()
        before = {} if new else dict(zip(*self.points.get(), strict=True))
        held = dict(before)
        for pdf in rows:
            held.update((int(i), None if line is None or pd.isna(line) else str(line)) for i, line in zip(pdf["point_id"], pdf["line"], strict=True))
            if len(held) > 4 * self.limit:
                held = {i: held[i] for i in sorted(held)[:self.limit]}
        kept = {i: held[i] for i in sorted(held)[:self.limit]}
        if kept == before:
            return
        self.points.update((list(kept), list(kept.values())))
        start = pd.Timestamp(key[1])
        end = start + pd.Timedelta(milliseconds=self.size_ms)
        if new:
            self.handle.registerTimer(int((end if end.tzinfo else end.tz_localize("UTC")).timestamp() * 1000))
        texts = [line for line in kept.values() if line is not None]
        yield pd.DataFrame({"collection": [key[0]], "window_start": [start], "window_end": [end], "n_points": [len(kept)],
                            "n_texts": [len(texts)], "digest": ["\n".join(texts) if texts else NO_TEXT_CONTENT]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.points.clear()
        return iter(())

    def close(self) -> None:
        pass


def window_digests(points: DataFrame, window_size: str = "4 hours", slide: str = "1 hour", lateness: str = "1 hour",
                   limit: int = DIGEST_LIMIT) -> DataFrame:
    """The changed digests of a stream of points (``collection, point_id, ts, _node_content``)."""
    size_ms = int(pd.Timedelta(window_size).total_seconds() * 1000)
    timed = points.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    lines = timed.select("ts", "collection", "point_id", digest_line("_node_content").alias("line"),
                         F.window("ts", window_size, slide).alias("w")).select(
        "ts", "collection", "point_id", "line", F.col("w.start").alias("window_start"))
    return lines.groupBy("collection", "window_start").transformWithStateInPandas(
        WindowDigest(limit, size_ms), DIGEST, "Update", "EventTime")


def start_window_digests(spark: SparkSession, source: str, sink: str, checkpoint: str, schema: str,
                         max_files_per_trigger: int | None = None, available_now: bool = True,
                         state_partitions: int | None = None, **windows):
    """Start the stream of window digests; returns the ``StreamingQuery``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}")

    return stateful_writer(spark, lambda: window_digests(reader.parquet(source), **windows), write_batch, checkpoint,
                           available_now, state_partitions)


def latest_window_digests(spark: SparkSession, sink: str) -> DataFrame:
    """The newest digest of each window."""
    df = spark.read.schema(f"{DIGEST}, batch_id long").parquet(sink)
    row = F.struct("window_end", "n_points", "n_texts", "digest")
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return (df.groupBy("collection", "window_start").agg(F.max_by(row, "batch_id").alias("r"))
            .select("collection", stamp("window_start").alias("window_start"), stamp("r.window_end").alias("window_end"),
                    "r.n_points", "r.n_texts", "r.digest"))
