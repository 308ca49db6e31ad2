"""L4 for a table of queries: exact top-k by cosine over metric partitions.

Rows become unit vectors, whose straight distance orders them as the cosine
does and obeys the triangle inequality. Centres are a bounded sample; every
row belongs to its nearest one, and a cell knows how far its rows lie from the
centre. A query first takes the k best of its own cell. The k-th of these is a
bound: a cell whose nearest possible row is farther can't hold a better one and
is left out (triangle bound), the others are searched, so the result is exact
whatever the sample is. Cells are cut into blocks of rows, so a cell that holds
most rows is many tasks; a task holds one block and streams the queries sent to
it, multiplying matrices batch by batch.

Candidates within rounding of the bound are scored again one by one in a fixed
order, so equal vectors have equal scores and ties go to the smaller id.

Defined cases: a zero vector's cosine is 0 to everything; NULL vectors are left
out; a query is not its own neighbour; fewer than k other rows give fewer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .summaries import top_per_key

CENTRES = 128         # cells at most; a bounded sample of the rows
BLOCK_ROWS = 20_000   # rows of a cell that one task holds
SLACK = 1e-6          # wider than any rounding of a distance

CELLS = "cell int, id long, v array<double>, away double"


def unit_rows(column: pa.Array) -> np.ndarray:
    """A list column as a matrix of unit rows (zero rows stay zero)."""
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)
    norm = np.sqrt((values * values).sum(axis=1, keepdims=True))
    return values / np.where(norm > 0, norm, 1)


def as_lists(m: np.ndarray) -> pa.Array:
    offsets = np.arange(0, (len(m) + 1) * m.shape[1], m.shape[1], dtype=np.int32) if m.shape[1] else np.zeros(len(m) + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(m.ravel()))


def choose_centres(rows: DataFrame, centres: int) -> np.ndarray:
    """Unit vectors of a bounded sample of distinct rows, by hash."""
    n = rows.count()
    share = min(1.0, 2 * centres / max(1, n))
    drawn = (rows.where(F.pmod(F.xxhash64("id", F.lit("centre")), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
             .orderBy(F.xxhash64("id")).limit(centres).select("v").toArrow())
    if not drawn.num_rows:
        return np.zeros((0, 0))
    return np.unique(unit_rows(drawn.column(0).combine_chunks()), axis=0)


def into_cells(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """``CELLS``: each row's unit vector, its nearest centre and how far it is from that."""
    middle = rows.sparkSession.sparkContext.broadcast(centres)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = middle.value
        for batch in batches:
            if not batch.num_rows:
                continue
            v = unit_rows(batch.column(1))
            square = np.maximum(0, (v * v).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * v @ c.T)
            cell = square.argmin(axis=1)
            away = np.sqrt(((v - c[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), batch.column(0), as_lists(v), pa.array(away)], names=["cell", "id", "v", "away"])

    return rows.mapInArrow(work, CELLS)


def search_cells(cells: DataFrame, sent: DataFrame, k: int, sizes: DataFrame) -> DataFrame:
    """``qid, id, score``: the ``k`` best rows of every block for each query that ``sent`` (``cell, qid, q``) sends to its cell."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
    held = cells.join(sizes.select("cell", "n"), "cell").select(
        "cell", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "v")
    asked = sent.join(sizes.select("cell", "n"), "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(1).alias("kind"), F.col("qid").alias("id"), F.col("q").alias("v"))
    ordered = held.unionByName(asked).repartition("cell", "block").sortWithinPartitions("cell", "block", "kind", "id")

    def best(ids: np.ndarray, rows: np.ndarray, qids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[int, int, float]]:
        scores = queries @ rows.T
        scores[qids[:, None] == ids[None, :]] = -np.inf  # not its own neighbour
        for i, qid in enumerate(qids):
            own = scores[i]
            last = np.partition(own, len(own) - k)[len(own) - k] if len(own) > k else -np.inf
            near = np.flatnonzero((own >= last - SLACK) & (own > -np.inf))
            exact = (rows[near] * queries[i]).sum(axis=1)
            for j in np.lexsort((ids[near], -exact))[:k]:
                yield int(qid), int(ids[near[j]]), float(exact[j])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, rows, joined = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, block, kind, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            edges = np.flatnonzero((cell[1:] != cell[:-1]) | (block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *edges], [*edges, len(cell)], strict=True):
                if key != (cell[lo], block[lo]):
                    key, ids, rows, joined = (cell[lo], block[lo]), [], [], None
                values = batch.column(4).slice(int(lo), int(hi - lo))
                matrix = np.asarray(values.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(int(hi - lo), -1)
                if kind[lo] == 0:
                    ids.append(own[lo:hi])
                    rows.append(matrix)
                elif ids:
                    if joined is None:
                        joined = np.concatenate(ids), np.concatenate(rows)
                    for at in range(0, len(matrix), 256):
                        found = list(best(*joined, own[lo:hi][at: at + 256], matrix[at: at + 256]))
                        if found:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)],
                                                             names=["qid", "id", "score"])

    return ordered.mapInArrow(work, "qid long, id long, score double")


def nearest(df: DataFrame, wanted: Column, k: int, id_col: str = "vec_id", vector: str = "embedding",
            centres: int = CENTRES, report: bool = False) -> DataFrame:
    """For each row of ``df`` that ``wanted`` selects its ``k`` nearest other rows: ``query_id, rank, id, score``.

    With ``report`` instead ``query_id, cells, searched``: how many cells there are and how many its bound left.
    """
    spark = df.sparkSession

    def kept(frame: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    rows = df.where(F.col(vector).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v"), F.coalesce(wanted, F.lit(False)).alias("asks"))
    middle = choose_centres(rows, centres)
    if not len(middle):
        return spark.createDataFrame([], "query_id long, cells long, searched long" if report else "query_id long, rank long, id long, score double")
    cells = kept(into_cells(rows.select("id", "v"), middle), "cells")
    queries = cells.join(rows.where("asks").select("id").distinct(), "id", "left_semi").select("cell", F.col("id").alias("qid"), F.col("v").alias("q"), "away")
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"))
    sizes = kept(sizes, "sizes")
    found = kept(search_cells(cells, queries.select("cell", "qid", "q"), k, sizes), "own")
    # A query with k rows in its own cell has a bound; unit rows at cosine s are sqrt(2 - 2 s) apart.
    first = top_per_key(found, ["qid"], [F.col("score").desc(), "id"], k)
    bound = first.groupBy("qid").agg(F.count(F.lit(1)).alias("n_found"), F.min("score").alias("least"))
    reach = F.when(F.col("n_found") >= k, F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("least")))).otherwise(F.lit(float("inf")))
    bound = bound.select("qid", reach.alias("reach"))
    radius = {r["cell"]: r["radius"] for r in sizes.select("cell", "radius").collect()}  # a row for each of the bounded cells
    ring = spark.sparkContext.broadcast((middle, np.array([radius.get(i, -np.inf) for i in range(len(middle))])))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, r = ring.value
        for batch in batches:
            if not batch.num_rows:
                continue
            home, qid, reach = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
            q = np.asarray(batch.column(2).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, -1)
            zero = ~(q != 0).any(axis=1)
            apart = np.sqrt(np.maximum(0, (q * q).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * q @ c.T))
            # A zero vector lies on no sphere: as a query it searches every cell. As a row it scores 0 and is at distance 1,
            # within any bound that a score of 0 or less gives.
            reach = np.where(zero, np.inf, reach)
            near = (apart - r[None, :] <= reach[:, None] + SLACK) & (r >= 0)[None, :]
            near[np.arange(len(home)), home] = False
            i, cell = np.nonzero(near)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(qid[i]), as_lists(q[i])], names=["cell", "qid", "q"])

    asked = queries.join(bound, "qid", "left").select("cell", "qid", "q", F.coalesce("reach", F.lit(float("inf"))).alias("reach"))
    sent = kept(asked.mapInArrow(send, "cell int, qid long, q array<double>"), "sent")
    if report:
        counts = sent.groupBy("qid").agg((F.count(F.lit(1)) + 1).alias("searched"))
        return queries.select("qid").join(counts, "qid", "left").select(
            F.col("qid").alias("query_id"), F.lit(len(radius)).cast("long").alias("cells"), F.coalesce("searched", F.lit(1)).alias("searched"))
    best = top_per_key(found.unionByName(search_cells(cells, sent, k, sizes)), ["qid"], [F.col("score").desc(), "id"], k)
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.col("score").desc(), "id")).cast("long")
    return best.select(F.col("qid").alias("query_id"), rank.alias("rank"), "id", F.round("score", 6).alias("score"))
