"""Operator 13: document fingerprints by locally consistent parsing.

A text's code points are names. On each level equal neighbours become one name,
deterministic coin tossing gives each name one of six labels (four rounds of
"lowest bit in which it differs from its left neighbour, and that bit"), a
block starts at each local maximum of the labels, and a block's sequence of
names becomes its name on the next level. Where blocks start hangs on a few
neighbours only, so equal substrings have equal names inside, whatever their
offset. Blocks hold two to eleven names, so phrases grow by about three a level.

A fingerprint is a bottom-k sketch of the names of ``LEVELS`` (phrases of about
ten characters and more): the ``KEEP`` least 32-bit hashes, eight hex digits
each, in order. Likeness is the share of phrases in common (Dice), estimated
from the least hashes of both; it is exact where the phrases are fewer.

Each document's edited text takes the end from the next one by descending id.
Rows are dealt into ranges of (id, text hash) whose bounds are rows of a bounded
sample: each range's first row is known, and is also sent to the range before
it. A task reads its ranges in order, a group of texts at a time, so neither a
range nor the table is held whole. Texts travel compressed.

Defined cases: a NULL or empty text has the empty fingerprint, which is like
itself (1) and like no other (0); rows without an id come last; rows with one id
are ordered by text hash; the last row's next is the first, a single row's next
is itself; texts of any length are read whole; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import bounded_sample, tuned

LEVELS = (2, 3)
KEEP = 64
CHUNK = 1 << 18       # names of one numpy step
GROUP = 1 << 17       # code points of the texts that are parsed together
ROUNDS = 4            # 64 bits, 128, 14, 8, 6 labels
RANGES = 4            # ranges for each shuffle partition
SAMPLE = 20           # sampled rows for each range

RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
MOVED = "part int, tail boolean, k0 int, k1 long, k2 long, doc_id long, size long, packed binary"

_ONE = np.uint64(1)
_LOWEST = np.array([0] + [(v & -v).bit_length() - 1 for v in range(1, 256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64's fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PLACE = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_RUN = np.uint64(0xD6E8FEB86659FD93)


def labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Deterministic coin tossing: one of six labels a name, neighbours differ. ``first`` marks the texts' first names."""
    other = np.empty_like(names)
    other[1:] = names[1:] ^ names[:-1]
    other[first] = _ONE
    other[0] = _ONE
    low = np.bitwise_count((other & (~other + _ONE)) - _ONE).astype(np.uint64)
    label = (low << _ONE | (names >> low & _ONE)).astype(np.uint8)
    for _ in range(ROUNDS - 1):
        differ = np.empty_like(label)
        differ[1:] = label[1:] ^ label[:-1]
        differ[first] = 1
        differ[0] = 1
        low8 = _LOWEST[differ]
        label = low8 << 1 | (label >> low8 & 1)
    return label


def without_runs(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal neighbours as one name, made of the name and their number."""
    held, counts, firsts = [], [], []
    for at in range(0, len(names), CHUNK):
        part = names[at: at + CHUNK]
        change = np.empty(len(part), bool)
        change[0] = at == 0 or part[0] != names[at - 1]
        np.not_equal(part[1:], part[:-1], out=change[1:])
        change |= first[at: at + CHUNK]
        starts = np.flatnonzero(change)
        head = starts[0] if len(starts) else len(part)
        if head:
            counts[-1][-1] += head
        if len(starts):
            held.append(part[starts].astype(np.uint64))
            counts.append(np.diff(np.append(starts, len(part))))
            firsts.append(first[at: at + CHUNK][starts])
    for part, n in zip(held, counts, strict=True):
        many = np.flatnonzero(n > 1)
        part[many] = mix(part[many] + n[many].astype(np.uint64) * _RUN)
    return np.concatenate(held), np.concatenate(firsts)


def level_up(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next level's names of texts that stand one after another, and where each text starts."""
    names, first = without_runs(names, first)
    n = len(names)
    begins = np.empty(n, bool)
    for at in range(0, n, CHUNK):
        # A label hangs on ROUNDS names to its left, a maximum on one more at each side.
        lo, hi, to = max(0, at - 2 * ROUNDS), min(n, at + CHUNK + 1), min(n, at + CHUNK)
        label = labels(names[lo:hi], first[lo:hi])
        top = np.zeros(hi - lo, bool)
        top[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~first[lo + 2: hi]
        begins[at:to] = top[at - lo: to - lo] | first[at:to]
    starts = np.flatnonzero(begins)
    out = np.empty(len(starts), np.uint64)
    step = CHUNK // 4
    for at in range(0, len(starts), step):
        own = starts[at: at + step]
        end = starts[at + step] if at + step < len(starts) else n
        place = np.arange(own[0], end) - np.repeat(own, np.diff(np.append(own, end)))
        out[at: at + step] = np.add.reduceat(mix(names[own[0]: end] ^ _PLACE[place]), own - own[0])
    return mix(out), first[starts]


def sketches(texts: list[str], levels: tuple[int, ...] = LEVELS, keep: int = KEEP) -> list[np.ndarray]:
    """The fingerprint of each text as sorted 32-bit hashes."""
    real = [i for i, t in enumerate(texts) if t]
    out = [np.zeros(0, np.uint32)] * len(texts)
    if not real:
        return out
    points = [np.frombuffer(texts[i].encode("utf-32-le", "surrogatepass"), "<u4") for i in real]
    sizes = [len(p) for p in points]
    names = np.concatenate(points) if len(points) > 1 else points[0]
    first = np.zeros(len(names), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    found = []
    for level in range(1, max(levels) + 1):
        names, first = level_up(names, first)
        if level in levels:
            hashed = mix(names + np.uint64(level)) >> np.uint64(32)
            found.append((np.cumsum(first) - 1).astype(np.uint64) << np.uint64(32) | hashed)
    every = np.unique(np.concatenate(found))
    edge = np.searchsorted(every, np.arange(len(real) + 1, dtype=np.uint64) << np.uint64(32))
    for j, i in enumerate(real):
        out[i] = every[edge[j]: min(edge[j + 1], edge[j] + keep)].astype(np.uint32)
    return out


def likeness(a: np.ndarray, b: np.ndarray, keep: int = KEEP) -> float:
    """Share of phrases in common by two sketches, 0 to 1."""
    if not len(a) and not len(b):
        return 1.0
    union, times = np.unique(np.concatenate([a, b]), return_counts=True)
    both = float(np.count_nonzero(times[:keep] == 2)) / min(keep, len(union))
    return 2 * both / (1 + both)


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def range_bounds(keyed: DataFrame, ranges: int) -> list[tuple]:
    """Keys at which ranges start, ascending: the least key and rows of a bounded sample."""
    least = keyed.agg(F.min(F.struct("k0", "k1", "k2")).alias("k")).first()["k"]
    if least is None:
        return []
    some = bounded_sample(keyed.select("k0", "k1", "k2"), F.xxhash64("k1", "k2"), ranges * SAMPLE)
    some = sorted({tuple(r) for r in some.collect()})
    return sorted({tuple(least), *some[:: max(1, len(some) // ranges)]})


def fingerprints(docs: DataFrame, levels: tuple[int, ...] = LEVELS, keep: int = KEEP, ranges: int = RANGES) -> DataFrame:
    """One row per document as in the module's text (columns of ``RESULT``)."""
    spark = tuned(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    keyed = docs.select(doc_id.isNull().cast("int").alias("k0"), F.coalesce(F.bitwise_not(doc_id), F.lit(0)).cast("long").alias("k1"),
                        F.xxhash64(text).alias("k2"), doc_id.alias("doc_id"), text.cast("binary").alias("text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(keyed, ranges * partitions)
    if not bounds:
        return spark.createDataFrame([], RESULT)
    kind = [("k0", np.int32), ("k1", np.int64), ("k2", np.int64)]
    edges = np.array(bounds, kind)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        heads: set[int] = set()
        for batch in batches:
            key = np.empty(batch.num_rows, kind)
            for i, (name, _) in enumerate(kind):
                key[name] = batch.column(i).to_numpy(zero_copy_only=False)
            part = np.searchsorted(edges, key, "right") - 1
            rows = [(int(p), False, i) for i, p in enumerate(part)]
            for i in np.flatnonzero(edges[part] == key):
                if int(part[i]) not in heads:
                    # A range's first row ends the range before it too; the table's first row ends the last range.
                    heads.add(int(part[i]))
                    rows.append(((int(part[i]) - 1) % len(edges), True, int(i)))
            take = pa.array([i for _, _, i in rows], pa.int64())
            texts = [t.as_py() for t in batch.column(4)]
            packed = [codec.compress(t, asbytes=True) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _, _ in rows], pa.int32()), pa.array([t for _, t, _ in rows]), *(batch.column(c).take(take) for c in range(4)),
                 pa.array([len(texts[i]) for _, _, i in rows], pa.int64()), pa.array([packed[i] for _, _, i in rows], pa.binary())],
                names=["part", "tail", "k0", "k1", "k2", "doc_id", "size", "packed"])

    def judged(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Rows of all texts but the last, which is the last row's next one."""
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts[:-1], texts[1:], strict=True)]
        own, changed = sketches(texts, levels, keep), sketches(edited, levels, keep)
        columns = [ids, [len(t) for t in texts[:-1]], [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in edited],
                   [as_text(s) for s in own[:-1]], [as_text(s) for s in changed],
                   [likeness(a, b, keep) for a, b in zip(own, changed, strict=False)], [likeness(a, b, keep) for a, b in zip(own[:-1], own[1:], strict=True)]]
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                          names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        ids: list = []
        texts: list[str] = []
        held, done = 0, None
        for batch in batches:
            for part, tail, doc_id, size, packed in zip(*(batch.column(c).to_pylist() for c in ("part", "tail", "doc_id", "size", "packed")), strict=True):
                if tail and part == done:
                    continue  # another task's copy of the same row
                texts.append(codec.decompress(packed, size, asbytes=True).decode("utf-8", "replace"))
                held += len(texts[-1])
                if tail:
                    yield judged(ids, texts)
                    ids, texts, held, done = [], [], 0, part
                    continue
                if held > GROUP and ids:
                    yield judged(ids, texts)
                    ids, texts, held = [], texts[-1:], len(texts[-1])
                ids.append(doc_id)

    return (keyed.mapInArrow(deal, MOVED).repartition(partitions, "part").sortWithinPartitions("part", "tail", "k0", "k1", "k2", "packed")
            .mapInArrow(read_ranges, RESULT))
