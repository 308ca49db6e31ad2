"""Operator 10: sharding by jump consistent hashing, in SQL expressions only.

The shard of a key is the last bucket below the shard count that the key's own
pseudo-random walk jumps to, so there is no ring table to build or broadcast,
and one more shard takes rows only into itself (about one row in ``n + 1``).
The walk is an ``aggregate`` over at most ``n`` steps; the 64-bit product of
its generator is put together from 32-bit halves, because Spark's checked
arithmetic raises on overflow.

``number`` gives the rows of a shard the slots 0, 1, 2, ... by rising key
without sorting a shard in one task: equal rows are counted before the
shuffle, rows are ranked in blocks of ``BLOCK`` keys, and the blocks' offsets
are summed up in two levels.

Defined cases: a NULL key counts as key 0 and is numbered first; NULL text has
size 1 and checksum 0, like an empty text; texts of any length are read whole;
equal rows get slots of their own; an empty table gives an empty table; other
columns are ignored by the query, and :func:`jump` only returns an expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed value: the multiplier of the published jump hash generator.
MULTIPLIER = 2862933555777941757
LOW32 = (1 << 32) - 1
#: Keys in a block of the numbering, and blocks in a block of the next level.
BLOCK = 4096


def _step(hi: Column, lo: Column) -> tuple[Column, Column]:
    """``state * MULTIPLIER + 1`` modulo 2^64 on (high, low) halves, without overflow."""
    mask, mul_hi, mul_lo = F.lit(LOW32), F.lit(MULTIPLIER >> 32), F.lit(MULTIPLIER & LOW32)
    half = F.lit(0xFFFF)
    p0 = lo.bitwiseAND(half) * mul_lo + F.lit(1)
    p1 = F.shiftright(lo, 16) * mul_lo
    low = p0 + F.shiftleft(p1.bitwiseAND(half), 16)
    cross = hi.bitwiseAND(half) * mul_lo + F.shiftleft((F.shiftright(hi, 16) * mul_lo).bitwiseAND(half), 16)
    high = F.shiftright(low, 32) + F.shiftright(p1, 16) + (lo * mul_hi).bitwiseAND(mask) + cross.bitwiseAND(mask)
    return high.bitwiseAND(mask), low.bitwiseAND(mask)


def jump(key: Column, shards: int) -> Column:
    """Shard of ``key`` (a long, NULL counts as 0) among ``shards``."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(LOW32)).alias("lo"),
                     F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def walk(s: Column, _: Column) -> Column:
        hi, lo = _step(s["hi"], s["lo"])
        # The next bucket: floor((b + 1) * 2^31 / (top 31 bits of the state + 1)).
        to = F.floor((s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + 1).cast("double")))
        on = F.struct(hi.alias("hi"), lo.alias("lo"), s["j"].alias("b"), to.cast("long").alias("j"))
        return F.when(s["j"] < shards, on).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, walk)["b"].cast("int")


def number(rows: DataFrame, shard: str, key: str, order: list[str], slot: str = "slot") -> DataFrame:
    """Adds ``slot``: 0, 1, 2, ... within ``shard`` by ``key``, then ``order`` (NULL first).

    All columns of ``rows`` but these must depend on them (they are carried
    along); rows that are equal in all columns may share a task, not an order.
    """
    same = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    same = same.withColumn("_block", F.coalesce(F.floor(F.col(key) / BLOCK), F.lit(-(1 << 62))))
    blocks = (same.groupBy(shard, "_block").agg(F.sum("_n").alias("_in"))
              .withColumn("_over", F.floor(F.col("_block") / BLOCK)))
    overs = blocks.groupBy(shard, "_over").agg(F.sum("_in").alias("_in"))
    before = lambda by: F.coalesce(F.sum("_in").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    overs = overs.select(F.col(shard).alias("_os"), F.col("_over").alias("_oo"),
                         before(W.partitionBy(shard).orderBy("_over")).alias("_far"))
    blocks = blocks.withColumn("_near", before(W.partitionBy(shard, "_over").orderBy("_block")))
    offsets = (blocks.join(overs, (F.col(shard) == F.col("_os")) & (F.col("_over") == F.col("_oo")))
               .select(F.col(shard).alias("_bs"), F.col("_block").alias("_bb"), (F.col("_far") + F.col("_near")).alias("_offset")))
    own = W.partitionBy(shard, "_block").orderBy(F.col(key).asc_nulls_first(), *order)
    first = F.coalesce(F.sum("_n").over(own.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = (same.withColumn("_first", first)
              .join(offsets, (F.col(shard) == F.col("_bs")) & (F.col("_block") == F.col("_bb")))
              .withColumn("_first", F.col("_first") + F.col("_offset")))
    # Equal rows come apart again, at most BLOCK at a time in one array.
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / BLOCK)))
    placed = placed.withColumn("_part", parts).withColumn("_from", F.col("_part") * BLOCK)
    each = F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + (BLOCK - 1), F.col("_n") - 1)))
    return (placed.withColumn("_i", each).withColumn(slot, F.col("_first") + F.col("_i"))
            .select(*rows.columns, slot))


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shard, slot and the shard after one more is added, by ``doc_id``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("shard", jump(F.col("doc_id"), shards))
    rows = number(rows, "shard", "doc_id", ["size", "text_crc32"])
    return rows.withColumn("law", F.lit("key")).withColumn("grown_shard", jump(F.col("doc_id"), shards + 1))
