"""Starting streams with keyed state: the state store and its partitions are fixed when a stream starts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stateful_writer(spark: SparkSession, stream: Callable[[], DataFrame], write_batch: Callable[[DataFrame, int], None], checkpoint: str,
                    available_now: bool = True, state_partitions: int | None = None, interval: str = "1 minute"):
    """Start ``stream()`` into ``write_batch`` and return the ``StreamingQuery``.

    Keyed state needs the RocksDB store (its files go to the checkpoint folder
    at every batch, so state survives a lost executor). A stream runs on a clone
    of the session taken at start: both settings are set only around it.
    """
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        writer = stream().writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
