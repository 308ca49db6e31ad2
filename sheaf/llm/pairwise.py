"""Operator 7: quality classifier by Bradley-Terry pairwise ranking.

Documents become short feature vectors in one pass over the whole texts. From
labelled documents preference pairs (a good one over a bad one) are drawn, and
weights are learned by logistic loss on the pairs' feature differences. A
document's strength is its weighted sum of features. The threshold is the
exact quantile of all documents' strengths that leaves the share of bad ones
among all training labels below it; strengths are mapped to scores by a logistic
curve that puts this quantile at ``CUT``.

Only the weights are fitted on a bounded sample: at most ``FIT_ROWS`` labelled
documents (chosen by the hash of their id; of several texts under one id the one
with the least hash) and ``PAIRS`` pairs. Every document is scored and counts
for the threshold.

Defined cases: NULL and empty texts get the score of the all-zero features;
labels of unknown documents, NULL labels and documents without a label are not
learned from; without both kinds of labels every score is 0.5; repeated rows
give repeated rows; texts of any length are read whole; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import bounded_sample, materialise, text_bytes, text_hash, tuned

FIT_ROWS, PAIRS = 10_000, 60_000
CUT = 0.3
SYMBOLS = b"#*$%&|<>"  # fixed value: characters counted as symbols
HASHED = 48  # buckets of the hashed word endings

NAMES = ["words", "word_length", "word_spread", "letters", "upper", "digits", "symbols", "marks", "ends", "pipes", "bangs",
         "upper_words", "distinct", "top_word", "lines", "line_words", "repeated_lines", "repeated_pairs", "wide", "capital"]
WIDTH = len(NAMES) + HASHED

LETTER = re.compile(rb"[A-Za-z\x80-\xff]")


def features(text: str | None) -> np.ndarray:
    """Feature vector of a text; all zero if it has no word."""
    raw = text_bytes(text)
    words = raw.split()
    out = np.zeros(WIDTH)
    if not words:
        return out
    n, size = len(words), len(raw)
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower, digits = kinds[65:91].sum(), kinds[97:123].sum(), kinds[48:58].sum()
    wide = kinds[128:].sum()
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    distinct = len(counts)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    out[:len(NAMES)] = [
        np.log1p(n) / 10, lengths.mean() / 10, lengths.std() / 10, (upper + lower + wide) / size, upper / size, digits / size,
        sum(kinds[c] for c in SYMBOLS) / n, (kinds[44] + kinds[59] + kinds[58]) / n, (kinds[46] + kinds[63]) / n,
        kinds[124] / n, kinds[33] / n, sum(c for w, c in counts.items() if w.isupper()) / n, distinct / n,
        max(counts.values()) / n, np.log1p(len(lines)) / 10, np.log1p(n / len(lines)) / 10,
        1 - len(set(lines)) / len(lines), 1 - pairs / max(1, n - 1), wide / size,
        sum(c for w, c in counts.items() if w[:1].isupper()) / n]
    ends = out[len(NAMES):]
    for w, c in counts.items():
        ends[zlib.crc32(w[-2:]) % HASHED] += c / n
    return out


@dataclass
class Ranking:
    """A fitted ranking: standardisation, weights and how steep the curve from strengths to scores is."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) / self.scale) @ self.weights


def fit(x: np.ndarray, good: np.ndarray, seed: int = 0, decay: float = 1e-3, rounds: int = 400) -> Ranking:
    """Learn from feature rows and their labels (True: preferred)."""
    centre = x.mean(axis=0) if len(x) else np.zeros(WIDTH)
    scale = x.std(axis=0) + 1e-6 if len(x) else np.ones(WIDTH)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(better) or not len(worse):
        return Ranking(centre, scale, np.zeros(x.shape[1]), 0.0)
    rng = np.random.default_rng(seed)
    z = (x - centre) / scale
    gap = z[rng.choice(better, PAIRS)] - z[rng.choice(worse, PAIRS)]
    w, speed = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for r in range(rounds):  # full-batch descent with momentum on mean log(1 + exp(-gap w))
        doubt = 1 / (1 + np.exp(np.clip(gap @ w, -30, 30)))
        grad = -(doubt @ gap) / len(gap) + decay * w
        speed = 0.9 * speed - 0.2 * grad
        w = w + speed
    strength = z @ w
    spread = float(np.median(strength[better]) - np.median(strength[worse]))
    return Ranking(centre, scale, w, 4.0 / max(spread, 1e-6))


def held_out(key: Column, parts: int = 5) -> Column:
    """Whether crc32 of the key as text is a multiple of ``parts``; a NULL key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == 0


def feature_rows(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py()).tolist() for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(rows, pa.list_(pa.float64()))],
                                             names=["doc_id", "good", "text_hash", "x"])
    own = docs.select("doc_id", "good", text_hash(F.col("text")).alias("text_hash"), "text")
    return own.mapInArrow(work, "doc_id long, good boolean, text_hash long, x array<double>")


def known_labels(labels: DataFrame) -> DataFrame:
    """Distinct ``label_id, good`` outside the held-out fold."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("label_id"), (F.col("quality") == 1).alias("good"))
    return known.where(~held_out(F.col("label_id"))).distinct()


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Ranking:
    """Fit on at most ``rows`` of the labelled documents outside the held-out fold."""
    drawn = bounded_sample(known_labels(labels), F.xxhash64("label_id"), rows)  # bounded, so it may be broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = feature_rows(texts.join(F.broadcast(drawn), F.col("doc_id") == F.col("label_id")))
    found = found.groupBy("doc_id", "good").agg(F.min_by("x", "text_hash").alias("x")).orderBy("doc_id", "good").toPandas()
    x = np.array(found["x"].tolist(), float).reshape(-1, WIDTH)
    return fit(x, found["good"].to_numpy(bool))


def exact_quantile(df: DataFrame, column: str, share: float, few: int = 10_000, bins: int = 4_096) -> float | None:
    """The value of ``column`` at rank ``floor(share * (n - 1))``, found by ever narrower histograms; None without rows."""
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n:
        return None
    rank, value = int(share * (n - 1)), F.col(column)
    inside = df.select(column).where(value.isNotNull())
    while low < high and n > few:
        width = (high - low) / bins
        place = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        for r in sorted(inside.groupBy(place.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).collect(),
                        key=lambda r: r["b"]):
            if rank < r["n"]:
                break
            rank -= r["n"]
        low, high, n = r["lo"], r["hi"], r["n"]
        inside = inside.where((value >= F.lit(low)) & (value <= F.lit(high)))
    return low if low == high else sorted(r[0] for r in inside.collect())[rank]


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each document."""
    ranking = train(docs, labels)
    model = tuned(docs.sparkSession).sparkContext.broadcast(ranking)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(1)]).reshape(-1, WIDTH)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.value.strength(x))], names=["doc_id", "strength"])

    own = materialise(docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(work, "doc_id long, strength double"), "strengths")
    kinds = {r["good"]: r["n"] for r in known_labels(labels).groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not ranking.slope or len(kinds) < 2:
        score = F.lit(0.5)
    else:
        at = exact_quantile(own, "strength", kinds[False] / (kinds[False] + kinds[True])) or 0.0
        odds = F.lit(ranking.slope) * (F.col("strength") - F.lit(at)) + F.lit(float(np.log(CUT / (1 - CUT))))
        # At the threshold itself the score is CUT, whatever rounding makes of it.
        score = F.when(F.col("strength") == F.lit(at), F.lit(CUT)).otherwise(1 / (1 + F.exp(-F.greatest(F.least(odds, F.lit(500.0)), F.lit(-500.0)))))
    return own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= F.lit(CUT)).cast("int"))
