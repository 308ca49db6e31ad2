"""Small inputs that hold the odd cases: NULLs, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, shard int, n_tokens string, word string, tail int, score double"

LONG = "alpha beta gamma delta " * 6_000


def odd_documents(spark: SparkSession, texts: list[str | None] = ()) -> DataFrame:
    base = [None, "", "   \n\t ", "one", "ONE", "é É ß 日本", LONG, "same text here for all", "same text here for all",
            "x" * 40_000, "a b c d e f g h i j k l m n o p", *texts]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(None, "a row without an id"), (3, "one"), (3, "another text under the same id"), (3, "one")]
    return spark.createDataFrame(
        [(i, t, None if i == 4 else "en", None if i == 5 else "host", None, 7, 1, "clash", "clash", 0, 0.5) for i, t in rows], DOCS)


def tuples(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def texts_of(df: DataFrame) -> list[tuple]:
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
