"""Model-backed operators with deterministic defaults (X2 embed, X4 summarise).

Both take an optional user function; the defaults make every job run offline
and repeat exactly. The embedding runs per Arrow batch (a scalar Arrow UDF);
the default summary is plain Spark (no Python at all).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.slices import slices
from ..quality import keep_rows
from .summaries import top_per_key

EMBEDDING_DIM = 1024  # the deployment's embedding dimension
SUMMARY_SENTENCES = 3
SLICE_WORDS = 200_000  # words of the texts whose sentence graphs a task holds at once
WORD_BREAK = r"[^\p{L}\p{N}]+"


def hashing_embedder(dim: int = EMBEDDING_DIM) -> Callable[[list], np.ndarray]:
    """Feature hashing of lower-cased whitespace tokens, L2-normalised.

    Vectorised per Arrow batch: the tokens of all texts of the batch are
    hashed in one call, and one ``bincount`` over (row, bucket) builds every
    vector of the batch. Returns an ``(n, dim)`` float32 matrix.
    """
    def embed_batch(texts: list) -> np.ndarray:
        toks = [(t or "").lower().split() for t in texts]
        lens = np.fromiter((len(x) for x in toks), dtype=np.int64, count=len(toks))
        flat = np.array(list(chain.from_iterable(toks)), dtype=object)
        buckets = (pd.util.hash_array(flat) % np.uint64(dim)).astype(np.int64) if len(flat) else \
            np.empty(0, dtype=np.int64)
        rows = np.repeat(np.arange(len(toks), dtype=np.int64), lens)
        m = np.bincount(rows * dim + buckets, minlength=len(toks) * dim).reshape(len(toks), dim)
        m = m.astype(np.float32)
        norms = np.linalg.norm(m, axis=1, keepdims=True)
        m /= np.where(norms > 0, norms, 1).astype(np.float32)
        return m
    return embed_batch


def embed(df: DataFrame, text: str = "text", out: str = "embedding",
          fn: Callable[[list], object] | None = None, dim: int = EMBEDDING_DIM) -> DataFrame:
    """Add ``out array<float>`` computed by ``fn`` inside the executors,
    a slice of an Arrow batch at a time. ``fn`` gets the texts of a slice and
    returns one vector per text (an ``(n, dim)`` matrix or a list of vectors);
    the default is ``hashing_embedder(dim)``.

    An Arrow UDF: only the text column travels to Python, the vectors go back
    slice by slice as an Arrow list column built without copying, and Spark
    re-attaches them to their rows in place (no join, no shuffle). A worker
    holds one batch of texts and the words and vectors of one slice.
    """
    fn = fn or hashing_embedder(dim)

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for (texts,) in slices(batch):
                n = len(texts)
                m = np.asarray(fn(texts.to_pylist()), dtype=np.float32).reshape(n, -1)
                offsets = pa.array(np.arange(n + 1, dtype=np.int32) * m.shape[1])
                yield pa.ListArray.from_arrays(offsets, pa.array(m.ravel()))
    return df.withColumn(out, vectors(F.col(text)))


def extractive_summary(lines: DataFrame, key: str = "collection", order: str = "point_id",
                       text: str = "line", k: int = SUMMARY_SENTENCES) -> DataFrame:
    """X4 default: the ``k`` lines of each group whose words are most
    frequent in the group (ties: earlier first), joined in original order.

    Word frequencies per (group, word) are one partial aggregation; scores
    come back by an equi join, so no group is ever collected whole.
    Rows: ``{key}, n_lines, summary``.
    """
    # The lines feed four branches (words, scores, ranking, counts); nothing is cached for that, the
    # planner reuses the exchange of the limit below them.
    lines = keep_rows(lines.select(key, order, text), F.col(text).isNotNull())
    words = lines.select(key, order, F.explode(F.split(F.lower(F.col(text)), WORD_BREAK)).alias("w")) \
        .filter(F.col("w") != "")
    tf = words.groupBy(key, "w").agg(F.count(F.lit(1)).alias("tf"))
    scores = words.join(tf, [key, "w"]).groupBy(key, order).agg(F.sum("tf").cast("bigint").alias("score"))
    scored = lines.join(scores, [key, order], "left").withColumn("score", F.coalesce("score", F.lit(0)))
    top = top_per_key(scored, [key], [F.col("score").desc(), F.col(order)], k)
    counts = lines.groupBy(key).agg(F.count(F.lit(1)).cast("bigint").alias("n_lines"))
    joined = top.groupBy(key).agg(
        F.expr(f"listagg({text}, ' ') WITHIN GROUP (ORDER BY {order})").alias("summary"))
    return counts.join(joined, key, "left")


def split_sentences(text: F.Column) -> F.Column:
    """The sentences of a text as an array (cut where ``.``, ``!`` or ``?`` is followed by white space; blank ones left out)."""
    marked = F.regexp_replace(text, r"([.!?])[ \t\n\r\f\x0B]+", "$1\u0001")
    return F.filter(F.transform(F.split(marked, "\u0001"), lambda s: F.trim(s)), lambda s: s != "")


def central_sentences(texts: pa.Array, k: int, max_shared: int, rounds: int) -> pa.Array:
    """Of each text (a list of sentences, each a list of words) the numbers of its ``k`` most central sentences, rising."""
    sentences = texts.flatten()
    words = sentences.flatten()
    n_sentences = np.diff(texts.offsets.to_numpy()).astype(np.int64)
    first = np.cumsum(n_sentences) - n_sentences
    doc = np.repeat(np.arange(len(texts)), n_sentences)
    n = len(sentences)
    codes = words.dictionary_encode()
    named = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    code = codes.indices.to_numpy().astype(np.int64)[named]
    at = np.repeat(np.arange(n), np.diff(sentences.offsets.to_numpy()))[named]
    # Words of a text side by side, each with its sentences once.
    group = doc[at] * (len(codes.dictionary) + 1) + code
    order = np.lexsort((at, group))
    group, at = group[order], at[order]
    once = np.ones(len(at), bool)
    once[1:] = (group[1:] != group[:-1]) | (at[1:] != at[:-1])
    group, at = group[once], at[once]
    _, number, held = np.unique(group, return_inverse=True, return_counts=True)
    rare = (held[number] >= 2) & (held[number] <= max_shared)
    group, at = group[rare], at[rare]
    pairs = [np.empty(0, np.int64)]
    for d in range(1, max_shared):
        same = group[d:] == group[:-d]
        x, y = at[:-d][same], at[d:][same]
        pairs += [x * n + y, y * n + x]
    pair, weight = np.unique(np.concatenate(pairs), return_counts=True)
    to, giver = np.divmod(pair, max(n, 1))
    total = np.zeros(n, np.int64)
    np.add.at(total, giver, weight)
    rank = np.full(n, 1_000_000_000, np.int64)
    for _ in range(rounds):
        wide = len(pair) and 850 * int(rank.max()) * int(weight.max()) >= 2**63
        share = (850 * rank.astype(object) if wide else 850 * rank)[giver] * weight // (1000 * total[giver])
        rank = np.full(n, 150_000_000, np.int64)
        np.add.at(rank, to, share.astype(np.int64))
    best = np.lexsort((np.arange(n), -rank, doc))
    kept = np.sort(best[np.arange(n) - first[doc] < k])
    offsets = np.concatenate([[0], np.cumsum(np.minimum(n_sentences, k))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(kept - first[doc[kept]], pa.int32()))


def extractive_sentences(texts: DataFrame, key: str = "doc_id", text: str = "text", k: int = SUMMARY_SENTENCES,
                         max_shared: int = 10, rounds: int = 3) -> DataFrame:
    """X4 by centrality: of each text the ``k`` sentences that rank highest in the graph of its sentences, in order.

    Two sentences are linked by each distinct word that both hold and that 2 to
    ``max_shared`` sentences of the text do (rare words; so a word makes at most
    ``max_shared`` squared pairs). A fixed number of power-iteration rounds passes
    85 % of a sentence's rank on by weight, in billionths and whole numbers, so
    the result is exact. Ties go to the earlier sentence; ``key`` must be unique.
    A graph never leaves its text's row, so nothing is shuffled or written.
    Rows: ``{key}, n_sentences, summary``.
    """
    @F.arrow_udf("array<int>")
    def central(words: pa.Array) -> pa.Array:
        # A few texts at a time, so the pairs at hand are bounded by SLICE_WORDS (or by one text).
        ends = words.values.offsets.to_numpy()[words.offsets.to_numpy()] if len(words) else np.zeros(1, np.int64)
        cuts = np.flatnonzero(np.diff((ends[:-1] - ends[0]) // SLICE_WORDS)) + 1
        edges = [0, *cuts.tolist(), len(words)]
        return pa.concat_arrays([central_sentences(words.slice(i, j - i), k, max_shared, rounds)
                                 for i, j in zip(edges, edges[1:], strict=False)])

    own = texts.select(key, split_sentences(F.col(text)).alias("_s"))
    own = keep_rows(own, F.size("_s") > 0)
    words = F.transform("_s", lambda s: F.split(F.lower(s), WORD_BREAK))
    ranked = own.select(key, "_s", central(words).alias("_best"))
    return ranked.select(key, F.size("_s").cast("bigint").alias("n_sentences"),
                         F.array_join(F.transform("_best", lambda i: F.get("_s", i)), " ").alias("summary"))


def summarize(lines: DataFrame, key: str = "collection", order: str = "point_id", text: str = "line",
              fn: Callable[[str], str] | None = None, sentences: int = SUMMARY_SENTENCES) -> DataFrame:
    """One summary per group, by default its ``sentences`` most typical lines. ``fn`` (the joined
    text → summary) runs per group in ``applyInPandas``; groups are bounded by the digest limit."""
    if fn is None:
        return extractive_summary(lines, key, order, text, sentences)

    def per_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        body = "\n".join(x for x in pdf[text] if x is not None)
        return pd.DataFrame({key: [pdf[key].iloc[0]], "n_lines": [len(pdf)], "summary": [fn(body)]})
    return lines.groupBy(key).applyInPandas(per_group, f"{key} string, n_lines long, summary string")


def vector_norm(v) -> F.Column:
    c = F.col(v) if isinstance(v, str) else v
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
