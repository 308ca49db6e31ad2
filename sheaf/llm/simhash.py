"""Operator 4: SimHash near-duplicates, linked through vantage-point trees.

1. Each whole text gets a 64-bit fingerprint; copies are collapsed to one row
   for each distinct fingerprint before anything is compared.
2. A vantage-point tree routes fingerprints to shards. An inner node has a
   vantage point and a radius; a fingerprint lives on the side that its Hamming
   distance names. One that lives outside and within the link distance of the
   boundary (the triangle bound: no link can reach further) also visits the
   inside; a visitor goes on to every side within reach. So two linked
   fingerprints meet in one home shard, that of the one which was inside where
   their ways parted, and no boundary is crossed twice for one pair. Of the
   near-halving radii the one with the lightest border is taken.
3. The first tree is grown from a bounded sample. Shards that come out too full
   get a tree of their own from a sample of their members in a further pass,
   pass by pass, so the number of shards follows the data without a cap and a
   bad sample costs a pass, never a link.
4. Each shard goes on with a tree over its members until leaves are small,
   compares there, and returns a spanning forest of the exact pairs.
5. The forests are joined into components by star contraction, as Spark joins
   over checkpointed edges.

Defined cases: NULL, empty and blank texts have fingerprint zero and link like
any other; a text of fewer words than a shingle is one shingle; repeated rows
give repeated rows; a NULL ``doc_id`` is never the smallest unless a component
has no other (its id is then NULL); an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import ascii_words, materialise, text_hash, tuned, without

#: Fingerprints from which one routing tree is grown (a documented bound; the tree's shape only), and its leaves.
SAMPLE, FANOUT = 32_768, 1_024
#: Members that a shard should have, and those that are compared without a further split.
SHARD_ROWS, LEAF_ROWS = 20_000, 192
#: A shard with more than this many times ``SHARD_ROWS`` members is split in a further pass; rows that one task routes there.
FULL, ROUTE_ROWS = 4, 2_000_000


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash of the word shingles: a bit is 1 if set in over half of the hashes."""
    words = ascii_words(text)
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) <= width:
        return int.from_bytes(digest(b" ".join(words), 42), "big")
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    hashes = np.frombuffer(b"".join([digest(s, 42) for s in shingles]), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        ones += np.unpackbits(hashes[at: at + 65_536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fp`` (the 64 bits as a signed long) of each document; no shuffle."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), width) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp, pa.int64())], names=["doc_id", "text_hash", "fp"])

    own = docs.select(docs["doc_id"].cast("long"), text_hash(docs["text"]).alias("text_hash"), docs["text"])
    return own.mapInArrow(work, "doc_id long, text_hash long, fp long")


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def split(points: np.ndarray, reach: int = 0) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that halve ``points`` (0.4 to 0.6 if any does) with the lightest border of ``reach``; None if none splits them."""
    best, score = None, None
    for v in points[:: max(1, len(points) // 8)][:9]:
        d = np.bincount(distance(points, v), minlength=65 + reach).cumsum()
        lower = np.minimum(d[:65], len(points) - d[:65])
        border = d[reach: 65 + reach] - d[:65]
        # Balance counts in fifths of the points up to 0.4, then the border decides.
        rank = np.minimum(5 * lower // (2 * len(points) / 5), 5) * 2 * len(points) - border + lower / len(points)
        rank[lower == 0] = -np.inf
        r = int(rank.argmax())
        if lower[r] and (score is None or rank[r] > score):
            best, score = (v, r), rank[r]
    return best


def grow(points: np.ndarray, shards: int, reach: int) -> list:
    """Nested [vantage, radius, inside, outside] down to about ``shards`` leaves, which are numbers."""
    count = iter(range(1 << 30))

    def node(own: np.ndarray, share: int):
        cut = split(own, reach) if share > 1 and len(own) > 1 else None
        if cut is None:
            return next(count)
        d = distance(own, cut[0])
        inside = max(1, min(share - 1, round(share * float((d <= cut[1]).mean()))))
        return [int(cut[0]), cut[1], node(own[d <= cut[1]], inside), node(own[d > cut[1]], share - inside)]

    return node(points, shards)


def route(tree, points: np.ndarray, reach: int, home: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the point, leaf, whether the leaf is its home) for each leaf a point is sent to.

    ``home`` tells the points that live below the tree's root from those that visit.
    """
    out = []

    def walk(node, index, home):
        if not len(index):
            return
        if isinstance(node, int):
            out.append((index, np.full(len(index), node, np.int32), home))
            return
        d = distance(points[index], np.uint64(node[0])).astype(np.int64)
        inside = d <= node[1]
        near_in, near_out = inside | (d - reach <= node[1]), ~inside | (~home & (d + reach > node[1]))
        walk(node[2], index[near_in], (home & inside)[near_in])
        walk(node[3], index[near_out], (home & ~inside)[near_out])

    walk(tree, np.arange(len(points)), np.ones(len(points), bool) if home is None else home)
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def pairs(members: np.ndarray, visitors: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Exact pairs (a member, a visitor) at ``reach`` or fewer bits, through a tree over the members."""
    if not len(members) or not len(visitors):
        return
    cut = split(members, reach) if len(members) > LEAF_ROWS else None
    if cut is None:
        for at in range(0, len(visitors), 512):
            part = visitors[at: at + 512]
            j, i = np.nonzero(distance(part[:, None], members[None, :]) <= reach)
            yield members[i], part[j]
        return
    m, v = distance(members, cut[0]).astype(int), distance(visitors, cut[0]).astype(int)
    yield from pairs(members[m <= cut[1]], visitors[v - reach <= cut[1]], reach)
    yield from pairs(members[m > cut[1]], visitors[v + reach > cut[1]], reach)


class Forest:
    """Spanning forest of pairs over the points of one shard."""

    def __init__(self, points: np.ndarray):
        self.points, self.root = np.unique(points), None
        self.root = np.arange(len(self.points))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = np.searchsorted(self.points, a), np.searchsorted(self.points, b)
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        linked = np.flatnonzero(self.root != np.arange(len(self.root)))
        return self.points[linked], self.points[self.root[linked]]


SENT = "shard long, fp long, home boolean"


def first_shards(distinct: DataFrame, reach: int) -> DataFrame:
    """``SENT`` rows of the first tree, which is grown from a sample and sent to the tasks."""
    n = distinct.count()
    share = min(1.0, 1.2 * SAMPLE / max(1, n))
    drawn = distinct.where(F.pmod(F.xxhash64("fp", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20))).limit(SAMPLE)
    sample = np.array([r[0] for r in drawn.collect()], np.int64).view(np.uint64)
    tree = distinct.sparkSession.sparkContext.broadcast(grow(np.sort(sample), max(1, min(FANOUT, n // SHARD_ROWS)), reach))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            index, shard, home = route(tree.value, points, reach)
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int64)), pa.array(points[index].view(np.int64)), pa.array(home)],
                                             names=["shard", "fp", "home"])

    return distinct.select("fp").mapInArrow(send, SENT)


def further_shards(sent: DataFrame, full: DataFrame, reach: int) -> DataFrame:
    """The rows of the ``full`` shards (``shard, n``), each dealt to the leaves of a tree of its own.

    A shard's rows are dealt to tasks in portions; each portion starts with the
    shard's sample, from which every task grows the same tree, and streams.
    """
    portions = F.ceil(F.col("n") / ROUTE_ROWS).cast("int")
    rows = sent.join(full, "shard")
    hashed = F.pmod(F.xxhash64("fp", "shard"), F.lit(1 << 30))
    sample = (rows.where("home").where(hashed < F.least(F.lit(1.0), F.lit(0.9 * SAMPLE) / F.col("n")) * F.lit(float(1 << 30)))
              .withColumn("portion", F.explode(F.sequence(F.lit(0), portions - 1))).withColumn("sampled", F.lit(True)))
    rows = rows.withColumn("portion", F.pmod(F.xxhash64("fp", F.lit(7)), portions).cast("int")).withColumn("sampled", F.lit(False))
    columns = ["shard", "portion", "sampled", "fp", "home", "n"]
    ordered = (rows.select(columns).unionByName(sample.select(columns)).repartition("shard", "portion")
               .sortWithinPartitions("shard", "portion", F.desc("sampled"), "fp"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, drawn, tree = None, [], None
        for batch in batches:
            shard, portion, sampled = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fp = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
            home, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
            edges = np.flatnonzero((shard[1:] != shard[:-1]) | (portion[1:] != portion[:-1])) + 1
            for lo, hi in zip([0, *edges], [*edges, len(shard)], strict=True):
                if hi == lo:
                    continue
                if key != (shard[lo], portion[lo]):
                    key, drawn, tree = (shard[lo], portion[lo]), [], None
                own = slice(lo, hi)
                drawn.append(fp[own][sampled[own]])
                points, live = fp[own][~sampled[own]], home[own][~sampled[own]]
                if not len(points):
                    continue
                if tree is None:
                    tree = grow(np.sort(np.concatenate(drawn)), int(max(2, min(FANOUT, n[lo] // SHARD_ROWS))), reach)
                index, leaf, lives = route(tree, points, reach, live)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[0] * FANOUT + leaf.astype(np.int64) + 1), pa.array(points[index].view(np.int64)), pa.array(lives)], names=["shard", "fp", "home"])

    return ordered.mapInArrow(deal, SENT)


def shards_of(distinct: DataFrame, reach: int) -> DataFrame:
    """``SENT``: each fingerprint in its home shard and in those it visits, no shard much over ``SHARD_ROWS`` members."""
    sent = materialise(first_shards(distinct, reach), "shards")
    done, before = None, None
    while True:
        counts = sent.groupBy("shard").agg(F.count(F.when(F.col("home"), 1)).alias("n"))
        full = materialise(counts.where(F.col("n") > FULL * SHARD_ROWS), "full")
        most = full.agg(F.max("n")).first()[0]
        if most is None or most == before:  # nothing is too full, or nothing splits any further
            return sent if done is None else done.unionByName(sent)
        before = most
        fits = sent.join(full.select("shard"), "shard", "left_anti")
        done = fits if done is None else done.unionByName(fits)
        # A pass numbers shards from above, so numbers of passes don't meet.
        sent = materialise(further_shards(sent, full, reach).withColumn("shard", F.col("shard") + F.lit(FANOUT)), "shards")


def links(distinct: DataFrame, reach: int) -> DataFrame:
    """Edges ``a, b`` (signed longs) that join the same fingerprints as all pairs within ``reach`` bits do."""
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        points, home = group["fp"].to_numpy(np.int64).view(np.uint64), group["home"].to_numpy(bool)
        forest = Forest(points)
        for a, b in pairs(points[home], points, reach):
            forest.add(a, b)
        a, b = forest.edges()
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return shards_of(distinct, reach).groupBy("shard").applyInPandas(compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``edges`` but the roots, by star contraction.

    A round hangs a node's larger neighbours, then its smaller ones, under the
    least of them; the edges never outnumber the first ones. Each round is
    written to the shared folder. It ends when a round changes nothing.
    """
    def stars(e: DataFrame, both: bool) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        around = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else down
        least = around.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        hung = around.join(least, F.col("u") == F.col("k"))
        hung = hung.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")) if both else \
            hung.select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")),
                                          F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        return hung.where("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    now = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = state(now)
    while seen[0]:
        now = materialise(stars(stars(now, True), False), "edges")
        then, seen = seen, state(now)
        if then == seen:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, width: int = 3, reach: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each document, and ``text_hash`` and ``root`` (the component's fingerprint)."""
    tuned(docs.sparkSession)
    own = materialise(fingerprints(docs, width), "fingerprints")
    distinct = materialise(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct, reach))
    held = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = held.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "r")
    named = held.join(named, F.col("root") == F.col("r")).select(F.col("fp").alias("k"), "component_id", "root")
    return (own.join(named, F.col("fp") == F.col("k"))
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_hash", "root"))


def keep_one(docs: DataFrame, width: int = 3, reach: int = 2) -> DataFrame:
    """One document of each component (the smallest id, then the smallest text hash), with all its columns."""
    own = materialise(near_duplicates(docs, width, reach).select("doc_id", "text_hash", "root"), "components")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    best = own.groupBy("root").agg(F.min(order).alias("best")).select(
        F.col("root").alias("r"), F.col("best.doc_id").alias("best_id"), F.col("best.text_hash").alias("best_hash"))
    lost = own.join(best, F.col("root") == F.col("r")).where(
        ~(F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("text_hash") == F.col("best_hash"))))
    kept = without(docs, lost)
    # Rows that repeat both id and text are left; only they are compared again.
    again = materialise(own.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated")
    if again.isEmpty():
        return kept
    same = docs["doc_id"].cast("long").eqNullSafe(again["doc_id"]) & (text_hash(docs["text"]) == again["text_hash"])
    return without(kept, again).unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
