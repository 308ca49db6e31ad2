"""Row-level error isolation (R1, R2) and guards.

The pipelines never let one bad row stop the others: each check is a pure
column expression that yields a reason string, the first failing check wins,
and ``split_valid`` cuts a frame into the rows that pass and a quarantine with
the reason attached. Both halves share one lineage, so Spark evaluates the
checks where the rows already are (no shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASON = "_reject_reason"


def first_reason(checks: Sequence[tuple[Column, str]]) -> Column:
    """``checks`` are (failure condition, reason); NULL when every check passes.

    A NULL condition counts as "not failing": write conditions so that unknown
    input fails explicitly (``coalesce(cond, True)``) where that is meant.
    """
    expr = None
    for cond, reason in checks:
        expr = (F.when(cond, F.lit(reason)) if expr is None
                else expr.when(cond, F.lit(reason)))
    return expr.otherwise(F.lit(None).cast("string")) if expr is not None else F.lit(None).cast("string")


def with_reason(df: DataFrame, checks: Sequence[tuple[Column, str]]) -> DataFrame:
    return df.withColumn(REASON, first_reason(checks))


def keep_rows(df: DataFrame, cond: Column) -> DataFrame:
    """``df.filter(cond)`` that Catalyst cannot push below the projections.

    For rows produced by an expensive expression (an XML or JSON parse): a
    plain ``Filter`` would be pushed below the parse and re-evaluate it inside
    the predicate once per referenced field. Routing the rows through a
    generator (``inline`` of a zero- or one-element array) keeps the parse
    evaluated once per row.
    """
    row = F.struct(*df.columns)
    empty = F.array().cast(T.ArrayType(df.select(row).schema[0].dataType))
    return df.select(F.inline(F.when(F.coalesce(cond, F.lit(False)), F.array(row)).otherwise(empty)))


def split_valid(df: DataFrame, checks: Sequence[tuple[Column, str]] | None = None,
                barrier: bool = False) -> tuple[DataFrame, DataFrame]:
    """Return ``(ok, rejected)``; ``rejected`` keeps every column plus the reason.

    ``barrier=True`` is for rows produced by an expensive expression: the
    split goes through ``keep_rows`` so the parse runs once per row.
    """
    if checks is not None:
        df = with_reason(df, checks)
    if not barrier:
        ok = df.filter(F.col(REASON).isNull()).drop(REASON)
        rejected = df.filter(F.col(REASON).isNotNull())
        return ok, rejected
    return (keep_rows(df, F.col(REASON).isNull()).drop(REASON),
            keep_rows(df, F.col(REASON).isNotNull()))


def reject_counts(rejected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """R2: number of rejected rows per job key and reason (partial aggregation)."""
    return (rejected.groupBy(*keys, REASON)
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
            .withColumnRenamed(REASON, "reason"))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """S10 / W7 guard for single-job calls: an empty input is an error.

    ``isEmpty`` reads at most one row, it does not scan the whole input.
    """
    if df.isEmpty():
        raise ValueError(message)
    return df
