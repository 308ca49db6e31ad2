"""Exact filtered vector search (L4).

The reference searches with a zero query vector, so only the filter and the
limit matter there; with a real vector this is exact cosine top-k. Scores
are computed per row with higher-order functions (JVM-side); the top-k per
key is a ``WindowGroupLimit``, so each task keeps only ``k`` rows per key
before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cosine(vector: str, query: Sequence[float], digits: int | None = 6) -> Column:
    """Cosine similarity of ``vector`` (array<float>) and a fixed ``query``;
    0 when either is a zero vector. Rounded to ``digits`` unless None."""
    q = [float(x) for x in query]
    qn = math.sqrt(sum(x * x for x in q))
    v = F.col(vector)
    dot = F.aggregate(F.zip_with(v, F.array(*[F.lit(x) for x in q]), lambda a, b: a.cast("double") * b),
                      F.lit(0.0), lambda acc, x: acc + x)
    vn = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    score = F.when((vn > 0) & F.lit(qn > 0), dot / (vn * F.lit(qn if qn > 0 else 1.0))).otherwise(F.lit(0.0))
    return F.round(score, digits) if digits is not None else score


def vector_search(df: DataFrame, query: Sequence[float], k: int, id_col: str, vector: str = "embedding",
                  keys: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """L4: top ``k`` rows by raw cosine score (ties: smaller id first), per ``keys``
    when given, after the optional filter ``where``. Adds ``score`` (6 digits) and
    ``rank`` (1-based); the vector column is dropped from the result."""
    src = df.filter(where) if where is not None else df
    scored = src.withColumn("score", cosine(vector, query, digits=None)).drop(vector)
    order = [F.col("score").desc(), F.col(id_col)]
    if not keys:
        # Global top-k: each task keeps k rows (TakeOrderedAndProject), then k are ranked.
        scored = scored.orderBy(*order).limit(k)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (scored.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= k)
            .withColumn("score", F.round("score", 6)))
