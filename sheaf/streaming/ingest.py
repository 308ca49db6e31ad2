"""ST1: continuous intake of single ingestion requests.

Requests land as files in a shared folder; a Structured Streaming query
turns each micro-batch into documents (P10/P18/F12) and writes it with
``foreachBatch`` into its own ``batch_id=N`` directory of the sink. A batch
that is replayed after a failure overwrites exactly its own directory, so the
sink is exactly-once. Readers take the newest version of each document
(``latest_documents``), which is the upsert of X3 applied on read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.documents import request_documents
from ..operators.load import load_documents
from ..operators.summaries import top_per_key


def start_ingest(spark: SparkSession, source: str, sink: str, checkpoint: str,
                 available_now: bool = True, max_files_per_trigger: int | None = None, fmt: str = "parquet"):
    """ST1: start the stream over request files (``fmt``: parquet or json lines,
    read with the request schema); returns the ``StreamingQuery``."""
    reader = spark.readStream.schema(schemas.INGESTION_REQUEST).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = request_documents(reader.load(source))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}")

    writer = docs.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def start_load(spark: SparkSession, source: str, store: str, checkpoint: str, available_now: bool = True,
               max_files_per_trigger: int | None = None, fmt: str = "parquet", **load):
    """ST1 + X3 + K4: start the stream of requests into the collections at ``store``; returns the ``StreamingQuery``.

    Each micro-batch is one upsert (:func:`load_documents`, which takes ``load``)
    and writes one small generation; ``compact_after`` (20) of them are folded
    into a new base. A replayed batch finds its documents stored and writes nothing new.
    """
    load = {"compact_after": 20, **load}
    reader = spark.readStream.schema(schemas.INGESTION_REQUEST).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        load_documents(batch, store, run=str(batch_id), **load)

    writer = request_documents(reader.load(source)).writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def latest_documents(spark: SparkSession, sink: str) -> DataFrame:
    """Current documents of the sink: per (collection, doc_id) the row of the
    newest batch. Requests carry no time, so versions within one micro-batch
    are ordered by content hash: the result never depends on row order. Tasks
    keep one row per key before the shuffle (a limit per key)."""
    df = spark.read.parquet(sink)
    content = F.xxhash64(*[F.to_json(c) if t.startswith(("map", "struct", "array")) else F.col(c)
                           for c, t in df.dtypes if c != "batch_id"])
    return top_per_key(df.withColumn("_content", content), ["collection", "doc_id"],
                       [F.col("batch_id").desc(), F.col("_content").desc()], 1).drop("_content", "batch_id")
