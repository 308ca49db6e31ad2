"""Operator 6: quality rules with cross-document line frequency.

Each document's lines are normalised (A-Z in lower case, white space runs as
one space, digits as 0) and hashed; a line that stands in more than
``max_share`` of a host's distinct documents, or in more than ``min_docs`` of
them, whichever is reached first, and in ``floor`` of them at least, is removed
from that host's documents (:func:`judge` counts what goes,
:func:`clean_documents` returns the texts without it). A document left with less
than the share ``min_left`` of its words is rejected. Copies of
one text count as one document of their host, so a page that was fetched often
doesn't turn its own lines into boilerplate. ``source`` is the host.

Verdicts read the texts once; everything after that works on hashes (16 bytes a
line), cleaned texts are cut where they stand, and counting combines before the shuffle, so a line or a host that holds
a third of all rows is no hot key.

Defined cases: NULL text has no words and no lines and fails the base rules;
NULL host is a host of its own; repeated rows give repeated rows; texts and
lines of any length are read whole; an empty table gives an empty table; other
columns are ignored (:func:`keep_documents` and :func:`clean_documents` return
them as they are, but for the text and ``n_chars`` of cleaned documents).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import BROADCAST_BYTES, materialise, text_hash, tuned, without

SYMBOLS = "#*$%&|<>"  # fixed value: characters counted as symbols
WINDOW = 5
FLOOR = 5  # fixed value: distinct documents of a host that share a line before it can be above a limit

MEASURES = ("doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, "
            "n_dup_lines long, n_repeat_words long, lines array<struct<hash: long, words: int>>")


def repeated_words(words: list, width: int = WINDOW) -> int:
    """Words in windows of ``width`` words that are found twice or more (each such window counts its words once)."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) > len(words) - 1:
        return 0
    # Windows are numbered from shorter ones and their next word, so equal numbers are equal windows.
    windows = codes
    for k in range(1, width):
        windows = np.unique(windows[:len(words) - k] << 32 | codes[k:], return_inverse=True)[1]
    again = np.bincount(windows)[windows] > 1
    starts = np.concatenate([[0], np.cumsum(again)])
    place = np.arange(len(words))
    return int(np.count_nonzero(starts[np.minimum(place + 1, n)] > starts[np.maximum(0, place - width + 1)]))


def line_hash(words: list[bytes]) -> int:
    """Hash of a normalised line, as a signed long."""
    h = xxhash.xxh64_intdigest(re.sub(rb"[0-9]", b"0", b" ".join(words)), 7)
    return h - (1 << 64) if h >> 63 else h


def measure(text: str | None) -> tuple:
    """The base measures and the (hash, words) of each distinct line of a text."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    seen: set[bytes] = set()
    dup, lines = 0, {}
    for line in raw.split(b"\n"):
        own = line.lower().split()
        if not own:
            continue
        dup += line in seen
        seen.add(line)
        h = line_hash(own)
        lines[h] = lines.get(h, 0) + len(own)
    # Code points in words: bytes that don't continue a character, without white space.
    chars = len(text or "") - sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
    symbols = sum(raw.count(c.encode()) for c in SYMBOLS)
    h = xxhash.xxh64_intdigest(raw, 42)
    return (h - (1 << 64) if h >> 63 else h, len(words), chars, symbols, dup, repeated_words(words),
            [{"hash": h, "words": n} for h, n in lines.items()])


def measures(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = pa.list_(pa.struct([("hash", pa.int64()), ("words", pa.int32())]))
        names = ["text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"]
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                columns = list(zip(*(measure(t.as_py()) for t in batch.column(2)), strict=True))
                arrays = [pa.array(c, line if n == "lines" else pa.int64()) for n, c in zip(names, columns, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["doc_id", "host", *names])

    return docs.select(docs[key].cast("long"), docs["source"].cast("string"), docs["text"]).mapInArrow(work, MEASURES)


def judged(docs: DataFrame, max_share: float = 0.02, min_docs: int = 20, min_left: float = 0.3,
           min_words: int = 10, key: str = "doc_id", floor: int = FLOOR) -> DataFrame:
    """The rows of :func:`judge` with their ``host`` and the hashes of their lines above the limits (``removed``)."""
    tuned(docs.sparkSession)
    own = materialise(measures(docs, key).withColumn("uid", F.monotonically_increasing_id()), "measures")
    # One document stands for the copies of a text in a host.
    stands = own.groupBy("host", "text_hash").agg(F.min("uid").alias("uid"))
    hosts = stands.groupBy("host").agg(F.count(F.lit(1)).alias("docs")).select(F.col("host").alias("h"), "docs")
    counted = own.select("uid", "host", "lines").join(stands.select("uid"), "uid", "left_semi")
    lines = counted.select("host", F.explode("lines.hash").alias("hash")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    above = (lines.where(F.col("n") >= floor).join(hosts, F.col("host").eqNullSafe(F.col("h")))
             .where((F.col("n") > min_docs) | (F.col("n") > F.col("docs") * F.lit(max_share))).select(F.col("host").alias("bh"), F.col("hash").alias("bl")))
    held = own.select("uid", "host", F.explode("lines").alias("line")).select("uid", "host", "line.*")
    removed = (held.join(above, F.col("host").eqNullSafe(F.col("bh")) & (F.col("hash") == F.col("bl")))
               .groupBy("uid").agg(F.sum("words").alias("gone"), F.count(F.lit(1)).alias("n_lines"), F.collect_list("hash").alias("removed")))
    n, left = F.col("n_words"), F.col("n_words") - F.coalesce("gone", F.lit(0))
    base = (n < min_words) | (100 * F.col("n_repeat_words") > 20 * n)
    depleted = left < n * F.lit(min_left)
    return own.drop("lines").join(removed, "uid", "left").select(
        "doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines_removed"), left.alias("n_words_left"),
        base.alias("base_failed"), (~base & ~depleted).alias("kept"), "host", "removed")


def judge(docs: DataFrame, **limits) -> DataFrame:
    """The measures and the verdict of each document (see the module's text)."""
    return judged(docs, **limits).drop("host", "removed")


def keep_documents(docs: DataFrame, **limits) -> DataFrame:
    """The documents that :func:`judge` keeps, with all their columns.

    A verdict depends on host and text, so a document stays in a host that
    keeps it although another host's copy goes.
    """
    return without(docs, judged(docs, **limits).where(~F.col("kept")), also={"host": "source"})


def without_lines(text: str, removed: set[int]) -> str:
    """The text without the lines whose hash is in ``removed``."""
    def stays(line: str) -> bool:
        own = line.encode("utf-8", "replace").lower().split()
        return not own or line_hash(own) not in removed

    return "\n".join(filter(stays, text.split("\n")))


def clean_documents(docs: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, **limits) -> DataFrame:
    """The documents that :func:`judge` keeps, without their lines above the limits; ``n_chars`` follows the text.

    The line hashes go back to their documents by id, host and text hash, so
    copies of a text are no hot key.
    """
    verdicts = materialise(judged(docs, **limits).select("doc_id", "host", "text_hash", "kept", "removed"), "verdicts")
    kept = without(docs, verdicts.where(~F.col("kept")), also={"host": "source"})
    cuts = (verdicts.where("kept and removed is not null").dropDuplicates(["doc_id", "host", "text_hash"])
            .select(F.col("doc_id").alias("__id"), F.col("host").alias("__host"), F.col("text_hash").alias("__hash"), F.col("removed").alias("__cut")))
    if (cuts.agg(F.sum(64 + F.octet_length(F.coalesce("__host", F.lit(""))) + 8 * F.size("__cut"))).first()[0] or 0) <= broadcast_bytes:
        cuts = F.broadcast(cuts)
    same = (kept["doc_id"].cast("long").eqNullSafe(cuts["__id"]) & kept["source"].cast("string").eqNullSafe(cuts["__host"])
            & (text_hash(kept["text"]) == cuts["__hash"]))

    @F.pandas_udf("string")
    def cleaned(texts, removed):
        return texts.combine(removed, lambda t, r: t if r is None else without_lines(t, set(r))) if len(texts) else texts

    out = kept.join(cuts, same, "left").withColumn("text", cleaned("text", "__cut")).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
