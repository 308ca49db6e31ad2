"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Largest table that is sent to every executor. Its size is measured first;
#: a larger one takes the shuffled way, with the same result.
BROADCAST_BYTES = 48 * 1024 * 1024


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage and stops a costly step from running twice. The files are in
    the folder of ``spark.checkpoint.dir``, so a lost executor loses none.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is. NULL stays NULL."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_bytes(value: str | None) -> bytes:
    """UTF-8 bytes; NULL gives none."""
    return b"" if value is None else value.encode("utf-8", "replace")


def ascii_words(value: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered (as bytes, whose ``lower`` and ``split`` know ASCII only)."""
    return text_bytes(value).lower().split()


#: Rows of an Arrow batch: texts are kilobytes each, and two batches of every task are in memory at once.
BATCH_ROWS = 1_000


def tuned(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches that suit rows of text."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


def table_path(sf_dir: str, table: str) -> str:
    return f"{sf_dir.rstrip('/')}/{table}.parquet"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return tuned(spark).read.parquet(table_path(sf_dir, table))


def batches_of_text(batches, limit: int, column: str = "text"):
    """Regroup Arrow batches so that each has at most about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def split_bounded(data: bytes, limit: int = 1 << 20):
    """Pieces of ``data`` of about ``limit`` bytes, cut at blanks; a longer run without one stays whole."""
    at = 0
    while len(data) - at > limit:
        cut = data.rfind(b" ", at, at + limit)
        if cut < 0:
            cut = data.find(b" ", at + limit)
        if cut < 0:
            break
        yield data[at:cut]
        at = cut + 1
    yield data[at:]


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; ``SHEAF_TOKENIZERS`` may name another folder."""
    folder = os.environ.get("SHEAF_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    try:
        import public_tokenizers
    except ImportError:
        return os.path.join("/opt/tokenizers", name)
    return public_tokenizers.path(name)


def text_hash(text: Column) -> Column:
    """XXH64 (seed 42) of the text's UTF-8 bytes; NULL counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def without(docs: DataFrame, bad: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, also: dict[str, str] | None = None) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` and text hash aren't in ``bad`` (columns ``doc_id, text_hash``).

    ``also`` names further columns of ``bad`` and the columns of ``docs`` whose text they must equal.
    ``bad`` is written first and measured: below ``broadcast_bytes`` it is sent
    to the executors, beyond that the planner joins by a shuffle.
    """
    also = also or {}
    more = [F.col(c).cast("string").alias(f"__also{i}") for i, c in enumerate(also)]
    bad = materialise(bad.select(F.col("doc_id").cast("long").alias("__id"), F.col("text_hash").alias("__hash"), *more).distinct(), "rejected")
    size = F.lit(64)
    for i in range(len(also)):
        size = size + F.coalesce(F.octet_length(f"__also{i}"), F.lit(0))
    if (bad.agg(F.sum(size)).first()[0] or 0) <= broadcast_bytes:
        bad = F.broadcast(bad)
    same = docs["doc_id"].cast("long").eqNullSafe(bad["__id"]) & (text_hash(docs["text"]) == bad["__hash"])
    for i, column in enumerate(also.values()):
        same = same & docs[column].cast("string").eqNullSafe(bad[f"__also{i}"])
    return docs.join(bad, same, "left_anti")


def bounded_sample(df: DataFrame, hashed: Column, rows: int) -> DataFrame:
    """At most ``rows`` rows of ``df``, chosen by ``hashed``; all of them if there are no more.

    The share is set from the row count, so tasks hand on only what is drawn.
    """
    n = df.count()
    if n <= rows:
        return df
    share = rows / n * max(0.5, 1 - 4 / rows ** 0.5)  # so far below that ``limit`` hardly ever cuts
    return df.where(F.pmod(hashed, F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))).limit(rows)


def frequent(counts: DataFrame, rows: int) -> DataFrame:
    """The rows of ``counts`` with the largest ``n``: all above the least bound that at most ``rows`` exceed.

    The bound comes from a histogram of about 3,000 logarithmic steps, so no
    task sends more than its part of the result.
    """
    step = F.floor(F.log2(F.greatest(F.col("n"), F.lit(1)).cast("double")) * 64)
    held = 0
    least = None
    for r in sorted(counts.groupBy(step.alias("s")).count().collect(), key=lambda r: -r["s"]):
        held += r["count"]
        if held > rows:
            break
        least = r["s"]
    return counts.where(F.lit(False)) if least is None else counts.where(step >= F.lit(least))
