"""Operator 11: audit of how the sources of a language differ in their words.

For each source of a language: how far its term shares lie from those of each
other source (part ``pair``), and which terms it uses more than the language as
a whole (part ``term``). Shares are integers in billionths with one smoothing
count, so every figure is exact.

Method, late string materialization: tasks count the terms of their documents
and write one row per source and term with the term's 64-bit digest (the term
itself once a task and language); all shuffles of counts carry digests only. The least and the greatest string of
each kept digest tell whether two terms share it; such digests are split by
their strings and counted again (``bits`` makes digests short in tests). Text
comes back by a join for the terms that are returned, and for those tied with
them.

Pair values are a sum over all kept terms of the language. What two sources
that lack a term add is one number per pair; the terms that a source has, and
the terms that two of them share, correct it. A language's sources are cut into
blocks of 256, its terms into buckets by their number, and a task adds up one
bucket for two blocks in integers, so no pair of rows is ever shuffled and no
hot source or term lands in one task whole.

Defined cases: NULL text, lang and source count as empty strings; an empty text
has no terms, its group still occurs; repeated rows are documents of their own;
texts of any length are read whole, a megabyte at a time; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.common import materialise, split_bounded, tuned

SCALE = 1_000_000_000  # fixed value: shares are in billionths
BLOCK = 256            # sources of a language that one task compares with as many others
BUCKET_ROWS = 250_000
HELD = 1_500_000       # counts of terms that a task holds before it hands them on
WAITING = 400_000      # words that are counted in one step
MASK = (1 << 32) - 1
CHUNK = 2_000_000      # numbers of one numpy step

#: Bytes of terms as they are (A-Z lowered), all others as a blank.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

COUNTS = "lang string, source string, digest long, term binary, n long, docs long"
PAIRS = "lang string, i int, j int, value long"


class _Codes(dict):
    """Numbers terms in the order of their coming."""

    def __missing__(self, term: bytes) -> int:
        code = self[term] = len(self)
        return code


def term_digest(term: bytes, bits: int = 64) -> int:
    """The leading ``bits`` of the term's XXH64, as a signed long."""
    h = xxhash.xxh64_intdigest(term, 42) >> (64 - bits)
    return h - (1 << 64) if h >> 63 else h


def term_counts(docs: DataFrame, bits: int = 64, every: bool = False) -> DataFrame:
    """Partial counts by task: a row per (lang, source, term), and one without a digest per (lang, source).

    Of the rows that a task hands on together one per (lang, term) holds the term itself, or all with ``every``.
    """
    def flush(groups: dict, codes: dict, keys: np.ndarray, n: np.ndarray, docs_of: np.ndarray) -> pa.RecordBatch:
        """All counts of a task so far; keys are a group's number and a term's code."""
        terms = pa.array(codes, pa.binary())
        digests = np.array([term_digest(t, bits) for t in codes], np.int64)
        group, code = keys >> 32, (keys & MASK).astype(np.int64)
        names = list(groups)
        langs = {lang: i for i, lang in enumerate(dict.fromkeys(lang for lang, _ in names))}
        lang_of = np.array([langs[lang] for lang, _ in names], np.int64)
        bare = len(names)  # rows that only say that a group occurs
        silent = np.ones(len(keys), bool)
        silent[np.unique(lang_of[group] << 32 | code, return_index=True)[1]] = False
        shown = pa.array(code, mask=None if every else silent)

        def column(values, none, kind):
            return pa.concat_arrays([pa.array(values, kind), pa.array(none, kind)])

        owner = pa.array(np.concatenate([group, np.arange(bare)]))
        return pa.RecordBatch.from_arrays(
            [pa.array([lang for lang, _ in names], pa.string()).take(owner), pa.array([source for _, source in names], pa.string()).take(owner),
             column(digests[code], [None] * bare, pa.int64()), pa.concat_arrays([terms.take(shown), pa.nulls(bare, pa.binary())]),
             column(n, [0] * bare, pa.int64()), column(docs_of, [0] * bare, pa.int64())],
            names=["lang", "source", "digest", "term", "n", "docs"])

    def summed(parts: list) -> list:
        """Equal keys of the parts added up."""
        keys, n, docs_of = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        if len(keys):
            keys, n, docs_of = keys[start], np.add.reduceat(n[order], start), np.add.reduceat(docs_of[order], start)
        return [(keys, n, docs_of)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, codes, parts, held = {}, _Codes(), [], 0
        words: list[bytes] = []
        coded: list[np.ndarray] = []
        owners, sizes = [], []

        def code_words() -> None:
            nonlocal words
            coded.append(np.array(list(map(codes.__getitem__, words)), np.int64))
            words = []

        def count_block() -> None:
            """The counts of the documents that wait, first by document, then by group."""
            nonlocal coded, owners, sizes, parts, held
            code_words()
            doc = np.repeat(np.arange(len(sizes)), sizes)
            key, n = np.unique(doc << 32 | np.concatenate(coded), return_counts=True)
            group = np.array(owners, np.int64)[key >> 32]
            parts += summed([(group << 32 | key & MASK, n, np.ones(len(n), np.int64))])
            held += len(parts[-1][0])
            if held > 2 * HELD:
                parts = summed(parts)
                held = len(parts[0][0])
            coded, owners, sizes = [], [], []

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                owners.append(groups.setdefault((lang, source), len(groups)))
                size = 0
                for piece in split_bounded(text.translate(LETTERS)):
                    own = piece.split()
                    size += len(own)
                    words += own
                    if len(words) >= WAITING:
                        code_words()
                sizes.append(size)
                if sum(map(len, coded)) >= WAITING:
                    count_block()
                    if held > HELD or len(codes) > HELD:
                        yield flush(groups, codes, *summed(parts)[0])
                        groups, codes, parts, held = {}, _Codes(), [], 0
        if owners:
            count_block()
        if groups:
            yield flush(groups, codes, *summed(parts)[0])

    tuned(docs.sparkSession)
    empty = F.lit("")
    return docs.select(F.coalesce(F.col("lang").cast("string"), empty).alias("lang"), F.coalesce(F.col("source").cast("string"), empty).alias("source"),
                       F.coalesce(F.col("text"), empty).cast("binary").alias("text")).mapInArrow(work, COUNTS)


def kept_terms(docs: DataFrame, partial: DataFrame, min_docs: int = 3, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Counts of the kept terms by source, and the kept terms' strings.

    ``(lang, source, digest, variant, n, lang_n)`` and ``(lang, digest, variant, term)``;
    ``variant`` tells terms with one digest apart; only such terms are counted again with their strings.
    """
    of_term = Window.partitionBy("lang", "digest")
    held = partial.where("digest is not null").groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    held = materialise(held.withColumn("lang_n", F.sum("n").over(of_term)).withColumn("lang_docs", F.sum("docs").over(of_term))
                       .where(F.col("lang_docs") >= min_docs).drop("docs", "lang_docs"), "kept")
    named = (partial.where("term is not null").select("lang", "digest", "term")
             .join(held.select("lang", "digest").distinct(), ["lang", "digest"], "left_semi")
             .groupBy("lang", "digest").agg(F.min("term").alias("term"), F.max("term").alias("other")))
    named = materialise(named, "names")
    same = F.col("term") == F.col("other")
    shared = named.where(~same).select("lang", "digest")
    if shared.isEmpty():
        return held.withColumn("variant", F.lit(0)), named.select("lang", "digest", F.lit(0).alias("variant"), "term")
    of_text = Window.partitionBy("lang", "digest", "term")
    split = (term_counts(docs, bits, every=True).where("digest is not null").join(shared, ["lang", "digest"], "left_semi").groupBy("lang", "source", "digest", "term")
             .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
             .withColumn("lang_n", F.sum("n").over(of_text)).withColumn("lang_docs", F.sum("docs").over(of_text)).where(F.col("lang_docs") >= min_docs)
             .withColumn("variant", F.dense_rank().over(Window.partitionBy("lang", "digest").orderBy("term"))))
    split = materialise(split, "split")
    columns = ["lang", "source", "digest", "variant", "n", "lang_n"]
    held = held.join(shared, ["lang", "digest"], "left_anti").withColumn("variant", F.lit(0)).select(columns).unionByName(split.select(columns))
    texts = ["lang", "digest", "variant", "term"]
    named = named.where(same).withColumn("variant", F.lit(0)).select(texts).unionByName(split.select(texts).distinct())
    return materialise(held, "kept"), materialise(named, "names")


def _share(count: str, total: str) -> str:
    return f"CASE WHEN terms = 0 THEN 1L ELSE 1 + (cast({SCALE} AS decimal(38, 0)) * ({count} + 1)) div ({total} + terms) END"


def _lift(p, q):
    return (p - q) * (p - q) // q


def add_pairs(own: np.ndarray, term: np.ndarray, share: np.ndarray, lack: np.ndarray, total: np.ndarray) -> None:
    """Add to ``total[g, h]`` what terms of sources ``own`` change against ``lack``, the shares of absent terms.

    Rows are sorted by term, and all rows of a term are there.
    """
    none = _lift(lack[:, None], lack[None, :])
    size = len(lack)
    # Terms that one of the two has: equal shares of a source count once, times their number.
    pairs, times = np.unique(own << 32 | share, return_counts=True)
    step = max(1, CHUNK // size)
    for at in range(0, len(pairs), step):
        g, p = pairs[at: at + step] >> 32, pairs[at: at + step, None] & MASK
        n = times[at: at + step, None]
        start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        total[g[start]] += np.add.reduceat(n * (_lift(p, lack[None, :]) - none[g]), start, axis=0)
        total[:, g[start]] += np.add.reduceat(n * (_lift(lack[None, :], p) - none.T[g]), start, axis=0).T
    # Terms that both have.
    start = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    width = np.diff(np.r_[start, len(term)])
    first, k = np.repeat(start, width), np.repeat(width, width)
    ends = np.cumsum(k)
    at = 0
    flat = total.reshape(-1)
    while at < len(term):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
        left = np.repeat(np.arange(at, to), k[at:to])
        right = np.repeat(first[at:to], k[at:to]) + np.arange(len(left)) - np.repeat(ends[at:to] - k[at:to] - done, k[at:to])
        g, h, p, q = own[left], own[right], share[left], share[right]
        np.add.at(flat, g * size + h, _lift(p, q) - _lift(p, lack[h]) - _lift(lack[g], q) + none[g, h])
        at = to


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of units in order, each unit's sources first: the sums of each unit."""
    unit, lack, base, parts, held = None, None, None, [], 0

    def work(last: bool) -> None:
        """Add up the rows held, but for those of the last term if more may follow."""
        nonlocal parts, held
        rows = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else None
        if rows is None:
            return
        idx, digest, variant, share = rows
        cut = len(idx)
        if not last:
            other = np.flatnonzero((digest != digest[-1]) | (variant != variant[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            changed = np.r_[True, (digest[1:cut] != digest[:cut - 1]) | (variant[1:cut] != variant[:cut - 1])]
            add_pairs(np.searchsorted(base["idx"], idx[:cut]), np.cumsum(changed), share[:cut], lack, base["total"])
        parts = [tuple(c[cut:] for c in rows)] if cut < len(idx) else []
        held = len(idx) - cut

    def finish() -> Iterator[pa.RecordBatch]:
        work(True)
        lang, a, b, bucket = unit
        total, idx = base["total"], base["idx"]
        if bucket == 0:
            total += base["terms"] * _lift(lack[:, None], lack[None, :])
        block = idx // BLOCK
        wanted = (block[:, None] == a) & (block[None, :] == b) | (block[:, None] == b) & (block[None, :] == a)
        np.fill_diagonal(wanted, False)
        g, h = np.nonzero(wanted)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(g), pa.string()), pa.array(idx[g], pa.int32()), pa.array(idx[h], pa.int32()), pa.array(total[g, h], pa.int64())],
            names=["lang", "i", "j", "value"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "a", "b", "bucket")), strict=True))
        number = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("idx", "digest", "variant", "share", "terms")}
        at = 0
        for to in [*(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]:
            if keys[at] != unit:
                if unit is not None:
                    yield from finish()
                unit, parts, held = keys[at], [], 0
                base = {"idx": np.zeros(0, np.int64), "terms": 0, "total": np.zeros((0, 0), np.int64)}
                lack = np.zeros(0, np.int64)
            heads = at + int(np.count_nonzero(number["terms"][at:to] >= 0))
            if heads > at:
                base["idx"] = np.r_[base["idx"], number["idx"][at:heads].astype(np.int64)]
                lack = np.r_[lack, number["share"][at:heads]]
                base["terms"] = int(number["terms"][at])
                base["total"] = np.zeros((len(lack), len(lack)), np.int64)
            if to > heads:
                parts.append(tuple(number[c][heads:to].astype(np.int64) for c in ("idx", "digest", "variant", "share")))
                held += to - heads
                if held > CHUNK // 8:
                    work(False)
            at = to
    if unit is not None:
        yield from finish()


def source_pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, i, j, value)`` of every ordered pair of different sources of a language."""
    blocks = F.floor((F.col("sources") - 1) / BLOCK).cast("int")
    own = F.floor(F.col("idx") / BLOCK).cast("int")
    buckets = F.greatest(F.lit(1), F.ceil(F.col("rows") / BUCKET_ROWS).cast("int"))
    units = F.explode(F.sequence(F.lit(0), blocks)).alias("o")
    rows = (entries.select("lang", "idx", "digest", "variant", F.col("p").alias("share"), F.lit(-1).cast("long").alias("terms"), own.alias("own"),
                           F.pmod(F.xxhash64("digest", "variant"), buckets).cast("int").alias("bucket"), units))
    heads = (groups.select("lang", "idx", F.lit(None).cast("long").alias("digest"), F.lit(None).cast("int").alias("variant"), F.col("lack").alias("share"),
                           "terms", own.alias("own"), F.sequence(F.lit(0), buckets - 1).alias("bucket"), units)
             .withColumn("bucket", F.explode("bucket")))
    every = rows.unionByName(heads).select("lang", F.least("own", "o").alias("a"), F.greatest("own", "o").alias("b"), "bucket",
                                           F.coalesce("digest", F.lit(0)).alias("digest"), F.coalesce("variant", F.lit(0)).alias("variant"),
                                           "idx", "share", "terms")
    unit = ["lang", "a", "b", "bucket"]
    ordered = every.repartition(*unit).sortWithinPartitions(*unit, (F.col("terms") < 0), "digest", "variant", "idx")
    return (ordered.mapInArrow(_pair_sums, PAIRS).groupBy("lang", "i", "j").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value")))


def divergence(docs: DataFrame, min_docs: int = 3, top: int = 200, bits: int = 64) -> DataFrame:
    """``(lang, source, part, item, value, rank)``; see the module's text."""
    partial = materialise(term_counts(docs, bits), "terms")
    kept, named = kept_terms(docs, partial, min_docs, bits)
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"), F.count(F.lit(1)).alias("rows"))
    of_lang = Window.partitionBy("lang")
    groups = (partial.where("digest is null").select("lang", "source").distinct()
              .join(totals, ["lang", "source"], "left").na.fill(0, ["words", "rows"])
              .join(named.groupBy("lang").agg(F.count(F.lit(1)).alias("terms")), "lang", "left").na.fill(0, ["terms"])
              .withColumn("idx", F.row_number().over(of_lang.orderBy("source")) - 1)
              .withColumn("sources", F.count(F.lit(1)).over(of_lang)).withColumn("rows", F.sum("rows").over(of_lang))
              .withColumn("lang_words", F.sum("words").over(of_lang)).withColumn("lack", F.expr(_share("0", "words"))))
    groups = materialise(groups, "groups")
    entries = kept.join(groups, ["lang", "source"]).withColumn("p", F.expr(_share("n", "words"))).withColumn("q", F.expr(_share("lang_n", "lang_words")))

    value = F.expr("((p - q) * (p - q)) div q")
    of_group = Window.partitionBy("lang", "source")
    above = entries.where("p > q").select("lang", "source", "digest", "variant", value.alias("value"))
    near = above.withColumn("place", F.rank().over(of_group.orderBy(F.desc("value")))).where(F.col("place") <= top).drop("place")
    terms = near.join(named, ["lang", "digest", "variant"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value")
    in_order = of_group.orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= top)

    who = groups.select("lang", F.col("idx").alias("i"), "source")
    other = groups.select("lang", F.col("idx").alias("j"), F.col("source").alias("item"))
    pairs = source_pairs(entries, groups).join(who, ["lang", "i"]).join(other, ["lang", "j"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(in_order))
    return pairs.unionByName(terms)
