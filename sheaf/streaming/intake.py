"""ST1: intake of request lines into the collections, with a dead-letter table.

Requests come as JSON lines. A line that isn't a request (no JSON object, a
required field missing or of another kind) goes to the dead-letter table with
its reason, file and line as read. Every other one becomes a document version,
ordered by the time of its file, the file's name and its place in it.

The state of a document (the hash of its newest content) is the collection
store's own: a micro-batch is one upsert, in which the latest of several
versions of a document counts, whatever order the rows come in, and unchanged
repeats write nothing. Keyed state in the stream would hold the same hashes a
second time and cost a call to the state store for every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.documents import request_documents
from ..operators.load import load_documents
from ..quality import REASON, first_reason

REQUIRED = ("communityId", "platformId", "text", "metadata")  # fixed value: fields without a default


def request_lines(lines: DataFrame) -> DataFrame:
    """``value`` (a JSON line) with the request's fields and a reject reason (``no_json``, ``no_object``, ``missing_<field>``, ``bad_<field>``)."""
    fields = F.from_json("value", schemas.INGESTION_REQUEST)
    variant = F.try_parse_json("value")
    kind = F.schema_of_variant(variant)
    present = F.json_object_keys("value")
    reasons: list[tuple[Column, str]] = [(variant.isNull(), "no_json"), (~kind.startswith("OBJECT"), "no_object")]
    reasons += [(~F.coalesce(F.array_contains(present, F.lit(f)), F.lit(False)), f"missing_{f}") for f in REQUIRED]
    text_like = [F.schema_of_variant(F.try_variant_get(variant, f"$.{f}", "variant")) for f in REQUIRED[:3]]
    reasons += [(F.coalesce(t != "STRING", F.lit(True)), f"bad_{f}") for f, t in zip(REQUIRED, text_like, strict=False)]
    meta = F.schema_of_variant(F.try_variant_get(variant, "$.metadata", "variant"))
    reasons.append((F.coalesce(~meta.startswith("OBJECT"), F.lit(True)), "bad_metadata"))
    return lines.select("*", fields.alias("r"), first_reason(reasons).alias(REASON)).select(
        *[c for c in lines.columns], REASON, "r.*")


def read_lines(spark: SparkSession, source: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines with where they stand: ``value, file, modified, block``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"),
                                      F.col("_metadata.file_block_start").alias("block"))


def numbered(lines: DataFrame) -> DataFrame:
    """The lines with their number in their file's block (``row``): a block's lines come to one task in order."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, row = None, 0
        for batch in batches:
            rows = []
            for place in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                at, row = (at, row + 1) if place == at else (place, 0)
                rows.append(row)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.int64())], names=["value", "file", "modified", "block", "row"])

    return lines.select("value", "file", "modified", "block").mapInArrow(work, "value string, file string, modified timestamp, block long, row long")


def ordered_documents(lines: DataFrame) -> DataFrame:
    """The documents of a stream of lines, each with its place in the order of versions (``sequence``)."""
    good = request_lines(numbered(lines)).filter(F.col(REASON).isNull())
    place = F.struct("modified", "file", "block", "row").alias("sequence")
    return request_documents(good.select("*", place), keep=["sequence"])


def start_intake(spark: SparkSession, source: str, store: str, checkpoint: str, max_files_per_trigger: int | None = None,
                 available_now: bool = True, **load):
    """Start the stream of request lines into the collections at ``store``; returns the ``StreamingQuery``.

    Each micro-batch is one upsert (:func:`load_documents`, which takes ``load``); a replayed one finds its documents stored.
    """
    load = {"compact_after": 20, **load}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        load_documents(batch, store, run=str(batch_id), sequence="sequence", **load)

    writer = (ordered_documents(read_lines(spark, source, max_files_per_trigger)).writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()


def start_dead_letters(spark: SparkSession, source: str, sink: str, checkpoint: str, max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start the stream of lines that aren't requests into ``sink`` (``batch_id=N`` folders): ``file, value, reason``."""
    bad = request_lines(read_lines(spark, source, max_files_per_trigger)).filter(F.col(REASON).isNotNull())

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.select("file", "value", F.col(REASON).alias("reason")).write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}")

    writer = bad.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()
