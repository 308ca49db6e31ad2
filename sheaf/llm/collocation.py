"""Operator 12: collocations, phrases of two or three words that stand together more often than their parts would.

Method, a weighted de Bruijn graph per language: nodes are pairs of words, an
edge joins the pairs of a three-word window and weighs what the window occurs.
Tasks count only these longest grams, and an ending edge where a piece stops.
All shorter counts follow from the flow: a pair occurs as often as edges leave
its node, its pieces' ends included; a word as often as the pairs that it
begins, plus the pieces that end with it. A node whose whole flow comes in by
one edge and leaves by one joins these to a path: such a pair needs no count
and no verdict of its own (the longer phrase occurs as often), its flow is the
path's weight. Paths are numbered by pointer doubling in joins.

Words are 64-bit digests (language included) in every shuffle of counts. The
least and greatest word of each frequent digest show whether two words share
one; if so, everything is counted again with another seed. Text is joined for
the phrases that are returned, and those tied with them. Nodes that hold a
500th of a sample's windows or more are dealt out by their third word (this
shapes partitions, not results), so no hot pair lands in one task.

Defined cases: NULL and empty texts have no words; NULL language is ``und``;
repeated rows count again; texts and pieces of any length are read whole, a
megabyte at a time; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.common import bounded_sample, materialise, split_bounded, tuned

END = b"\xff"         # piece end; no byte of UTF-8
MARKS = b".,;:!?\n\x0b\x0c\r"  # fixed value: characters that end a piece
PIECES = bytes(b + 32 if 65 <= b <= 90 else 255 if b in MARKS else 32 if b == 9 else b for b in range(256))

HELD = 4_000_000      # words that a task holds before it hands their counts on
WORDS = 1 << 21       # codes of distinct words among them (three fit a long)
WAITING = 500_000     # words that are coded in one step
SAMPLE = 2_000        # documents that show which nodes are hot
HOT = 500             # a node is hot from this part of a sample's windows on
SPREAD = 64

WINDOWS = "w1 long, w2 long, w3 long, n long, salt int"
NAMES = "lang string, digest long, word binary, n long"


class _Codes(dict):
    """Numbers words in the order of their coming; 0 is a piece's end."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def word_digest(lang: bytes, word: bytes, seed: int, bits: int) -> int:
    """Leading ``bits`` of the XXH64 of a language's word, never 0."""
    return (xxhash.xxh64_intdigest(lang + b"\0" + word, seed) >> (64 - bits)) or 1


def _texts(docs: DataFrame) -> DataFrame:
    tuned(docs.sparkSession)
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def _tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words and piece ends of a text, in lists of a bounded size."""
    for part in split_bounded(text.translate(PIECES).replace(END, b" \xff "), 1 << 20):
        yield part.split()
    yield [END]


def window_counts(docs: DataFrame, seed: int = 0, bits: int = 64, hot: list[int] = ()) -> DataFrame:
    """Partial counts of windows ``(w1, w2, w3)``.

    ``w3`` is 0 where a piece ends after two words or more, ``w2`` and ``w3`` are 0 for a piece of one word.
    """
    hot_nodes = np.sort(np.array(hot, np.uint64))

    def counted(lang: bytes, codes: dict, parts: list) -> pa.RecordBatch:
        digests = np.array([0, *(word_digest(lang, w, seed, bits) for w in list(codes)[1:])], np.uint64)
        keys, n = np.unique(np.concatenate(parts), return_counts=True)
        w1, w2, w3 = (digests[(keys >> shift) & (WORDS - 1)] for shift in (42, 21, 0))
        salt = np.where(np.isin(node_key(w1, w2), hot_nodes), 1 + w3 % np.uint64(SPREAD), np.uint64(0)).astype(np.int32)
        return pa.RecordBatch.from_arrays([*(pa.array(w.view(np.int64)) for w in (w1, w2, w3)), pa.array(n.astype(np.int64)), pa.array(salt)],
                                          names=["w1", "w2", "w3", "n", "salt"])

    def absorb(run: dict) -> None:
        """The windows of the words that wait, those of the last two words before them included."""
        tokens = run["tail"] + run["waiting"]
        codes = np.array(list(map(run["codes"].__getitem__, tokens)), np.int64)
        a, b, c = codes[:-2], codes[1:-1], codes[2:]
        edge, single = (a > 0) & (b > 0), (a == 0) & (b > 0) & (c == 0)
        run["parts"].append(np.concatenate([a[edge] << 42 | b[edge] << 21 | c[edge], b[single] << 42]))
        run["tail"], run["waiting"] = tokens[-2:], []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[str, dict] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, run in state.items():
                absorb(run)
                yield counted(lang.encode("utf-8", "replace"), run["codes"], run["parts"])

        def fresh(tail: list) -> dict:
            return {"codes": _Codes({END: 0}), "parts": [], "waiting": [], "tail": tail}

        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for tokens in _tokens(text):
                    run = state.setdefault(lang, fresh([END, END]))
                    run["waiting"] += tokens
                    held += len(tokens)
                    if len(run["waiting"]) >= WAITING:
                        absorb(run)
                    if held >= HELD or len(run["codes"]) > WORDS // 4:
                        yield from flush()
                        # A text that goes on keeps its last two words.
                        state, held = {lang: fresh(state[lang]["tail"])}, 0
        yield from flush()

    return _texts(docs).mapInArrow(work, WINDOWS)


def node_key(w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return w1 * np.uint64(0x9E3779B97F4A7C15) ^ w2


def hot_nodes(docs: DataFrame, seed: int, bits: int) -> list[int]:
    """Keys of the nodes (``HOT`` at most) that hold a large part of a bounded sample's windows."""
    some = bounded_sample(docs.select("lang", "text"), F.xxhash64("text"), SAMPLE)
    nodes = window_counts(some, seed, bits).where("w2 <> 0").groupBy("w1", "w2").agg(F.sum("n").alias("n"))
    nodes = materialise(nodes, "nodes")
    least = (nodes.agg(F.sum("n")).first()[0] or 0) / HOT
    rows = nodes.where(F.col("n") > F.lit(least)).collect()
    mask = (1 << 64) - 1
    return [int(node_key(np.array([r.w1 & mask], np.uint64), np.array([r.w2 & mask], np.uint64))[0]) for r in rows]


def flows(docs: DataFrame, min_count: int, seed: int = 0, bits: int = 64) -> DataFrame:
    """``(words, w1, w2, w3, n)``: frequent edges (3 words), nodes (2) and words (1) of the graph."""
    windows = window_counts(docs, seed, bits, hot_nodes(docs, seed, bits)).repartition("w1", "w2", "salt")
    # One exchange serves both: its rows aren't filtered before it.
    edges = windows.groupBy("w1", "w2", "salt", "w3").agg(F.sum(F.when(F.col("w3") != 0, F.col("n"))).alias("n"))
    edges = edges.where(F.col("n") >= min_count).select(F.lit(3).alias("words"), "w1", "w2", "w3", "n")
    nodes = windows.groupBy("w1", "w2", "salt").agg(F.sum("n").alias("flow"), F.sum(F.when(F.col("w3") == 0, F.col("n"))).alias("ends"))
    zero = F.lit(0).cast("long")

    def part(words: int, w1: str, w2: Column, n: str, where: Column) -> Column:
        return F.when(where, F.struct(F.lit(words).alias("words"), F.col(w1).alias("w1"), w2.alias("w2"), F.col(n).alias("n")))

    pair = F.col("w2") != 0
    parts = F.array(part(2, "w1", F.col("w2"), "flow", pair & ((F.col("flow") >= min_count) | (F.col("salt") > 0))),
                    part(1, "w1", zero, "flow", F.lit(True)), part(1, "w2", zero, "ends", pair & F.col("ends").isNotNull()))
    shorter = (nodes.select(F.explode(parts).alias("p")).where("p is not null").select("p.*").groupBy("words", "w1", "w2").agg(F.sum("n").alias("n"))
               .where(F.col("n") >= min_count).select("words", "w1", "w2", zero.alias("w3"), "n"))
    return materialise(edges.unionByName(shorter).withColumn("id", F.monotonically_increasing_id()), "flows")


def word_names(docs: DataFrame, seed: int, bits: int) -> DataFrame:
    """Distinct words of each task with their digests, and rows without a digest that count a language's words."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[set, list]] = {}

        def flush() -> pa.RecordBatch:
            langs, digests, words, counts = [], [], [], []
            for lang, (own, n) in held.items():
                own.discard(END)
                code = lang.encode("utf-8", "replace")
                langs += [lang] * (len(own) + 1)
                words += [None, *own]
                digests.append(None)
                digests += [d - (1 << 64) if d >> 63 else d for d in (word_digest(code, w, seed, bits) for w in words[len(words) - len(own):])]
                counts += [n[0]] + [0] * len(own)
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(digests, pa.int64()), pa.array(words, pa.binary()),
                                               pa.array(counts, pa.int64())], names=["lang", "digest", "word", "n"])

        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own, n = held.setdefault(lang, (set(), [0]))
                for tokens in _tokens(text):
                    own.update(tokens)
                    n[0] += len(tokens) - tokens.count(END)
            if sum(len(own) for own, _ in held.values()) > 300_000:
                yield flush()
                held = {}
        if held:
            yield flush()

    return _texts(docs).mapInArrow(work, NAMES)


def paths(edges: DataFrame, links: DataFrame) -> DataFrame:
    """``(id, path, place)`` of the linked edges (``before``, ``after``) by pointer doubling.

    ``path`` is the first edge's id. Edges on a circle are paths of their own.
    """
    linked = links.select(F.col("before").alias("id")).union(links.select("after")).distinct()
    state = (linked.join(links.withColumnRenamed("after", "id"), "id", "left")
             .select("id", F.coalesce("before", "id").alias("path"), F.when(F.col("before").isNotNull(), 1).otherwise(0).cast("long").alias("place")))
    state = materialise(state, "paths")
    reach, n = 1, state.count()
    while True:
        up = state.select(F.col("id").alias("path"), F.col("path").alias("up"), F.col("place").alias("more"))
        state = materialise(state.join(up, "path").select("id", F.col("up").alias("path"), (F.col("place") + F.col("more")).alias("place"),
                                                          (F.col("more") > 0).alias("moved")), "paths")
        moving = state.where("moved")
        if reach > n or moving.isEmpty():
            break
        reach *= 2
        state = state.drop("moved")
    return state.select("id", F.when(F.col("moved"), F.col("id")).otherwise(F.col("path")).alias("path"),
                        F.when(F.col("moved"), 0).otherwise(F.col("place")).alias("place"))


def _score(l: str, r: str) -> Column:
    whole = "cast({} AS decimal(19, 0))"
    a = whole.format("a")
    return F.expr(f"(1000000 * {a} * {a}) div ({whole.format(l)} * {whole.format(r)})")


def candidates(flow: DataFrame, max_share: int = 50) -> DataFrame:
    """The phrases that stay, ``(w1, w2, w3, a, l, r, score, path, place)``; ``w3`` is 0 for two words."""
    edges, nodes, words = (flow.where(F.col("words") == k) for k in (3, 2, 1))
    out = edges.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n_out"), F.max("n").alias("top_out"), F.min("id").alias("after"))
    into = edges.groupBy("w2", "w3").agg(F.count(F.lit(1)).alias("n_in"), F.max("n").alias("top_in"), F.min("id").alias("before"))
    into = into.withColumnRenamed("w2", "w1").withColumnRenamed("w3", "w2")
    nodes = nodes.select("w1", "w2", "n").join(out, ["w1", "w2"], "left").join(into, ["w1", "w2"], "left")
    unary = (F.col("n_in") == 1) & (F.col("n_out") == 1) & (F.col("top_in") == F.col("n")) & (F.col("top_out") == F.col("n"))
    nodes = materialise(nodes.withColumn("unary", F.coalesce(unary, F.lit(False))), "graph")
    numbered = paths(edges, nodes.where("unary").select("before", "after"))

    ends = nodes.where("not unary")
    first, last = (words.select(F.col("w1").alias(w), F.col("n").alias(f)) for w, f in (("w1", "f_first"), ("w2", "f_last")))
    covered = F.coalesce(F.greatest("top_in", "top_out"), F.lit(0))
    pairs = (ends.where(100 * covered.cast("decimal(20,0)") < max_share * F.col("n").cast("decimal(20,0)"))
             .select("w1", "w2", F.lit(0).cast("long").alias("w3"), F.col("n").alias("a"), F.lit(None).cast("long").alias("path"), F.lit(None).cast("long").alias("place"))
             .join(first, "w1").join(last, "w2")
             .withColumn("l", F.col("f_first")).withColumn("r", F.col("f_last")).withColumn("score", _score("l", "r")))
    # The flow of a node inside a path is the path's weight: only the others are looked up.
    left = ends.select("w1", "w2", F.col("n").alias("f_left"))
    right = ends.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("f_right"))
    last3 = words.select(F.col("w1").alias("w3"), F.col("n").alias("f_last"))
    threes = (edges.select("id", "w1", "w2", "w3", F.col("n").alias("a")).join(numbered, "id", "left")
              .join(left, ["w1", "w2"], "left").join(right, ["w2", "w3"], "left").join(first, "w1").join(last3, "w3")
              .withColumn("f_left", F.coalesce("f_left", "a")).withColumn("f_right", F.coalesce("f_right", "a"))
              .withColumn("cut1", _score("f_first", "f_right")).withColumn("cut2", _score("f_left", "f_last")))
    one = F.col("cut1") <= F.col("cut2")
    threes = (threes.withColumn("l", F.when(one, F.col("f_first")).otherwise(F.col("f_left")))
              .withColumn("r", F.when(one, F.col("f_right")).otherwise(F.col("f_last"))).withColumn("score", F.least("cut1", "cut2")))
    columns = ["w1", "w2", "w3", "a", "l", "r", "score", "path", "place"]
    return pairs.select(columns).unionByName(threes.select(columns))


def collocations(docs: DataFrame, min_count: int = 10, max_share: int = 50, limit: int = 2000, bits: tuple[int, ...] = (64,)) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score, path, place)``; see the module's text.

    A phrase of three words on a path of the graph has the path's number and its place there.
    ``bits`` are the digests' lengths in the first and later counts.
    """
    seed = 0
    while True:
        width = bits[min(seed, len(bits) - 1)]
        flow = flows(docs, min_count, seed, width)
        rows = materialise(word_names(docs, seed, width), "words")
        frequent = flow.where(F.col("words") == 1).select(F.col("w1").alias("digest"))
        word = F.struct("lang", "word")
        named = (rows.where("digest is not null").join(frequent, "digest", "left_semi").groupBy("digest").agg(F.min(word).alias("least"), F.max(word).alias("most")))
        named = materialise(named, "names")
        if named.where("least <> most").isEmpty():
            break
        seed += 1
    totals = rows.where("digest is null").groupBy("lang").agg(F.sum("n").alias("n"))
    names = named.select("digest", "least.lang", F.col("least.word").cast("string").alias("word"))

    def text(i: int) -> DataFrame:
        return names.select(F.col("digest").alias(f"w{i}"), F.col("word").alias(f"t{i}"))

    found = candidates(flow, max_share).join(names.select(F.col("digest").alias("w1"), "lang", F.col("word").alias("t1")), "w1")
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = found.withColumn("place_of", F.rank().over(by_score)).where(F.col("place_of") <= limit).drop("place_of")
    near = (near.join(text(2), "w2", "left").join(text(3), "w3", "left").withColumn("phrase", F.concat_ws(" ", "t1", "t2", "t3"))
            .join(totals, "lang"))
    in_order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (near.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= limit)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "path", "place"))
