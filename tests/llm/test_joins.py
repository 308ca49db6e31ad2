"""Decontamination, SimHash, line rules, sharding and archives against brute force."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from sheaf.llm import decontaminate, line_rules, sharding, simhash, warc
from tests.llm.helpers import LONG, odd_documents, texts_of, tuples

ASCII = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(docs, items, width=13):
    cut = lambda t: WORD.findall((t or "").translate(ASCII))
    windows = {}
    for item, text in items:
        words = cut(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            windows.setdefault(tuple(words[i: i + width]), set()).add(item)
    out = []
    for doc, text in docs:
        words, hit, found = cut(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                here = windows.get(tuple(words[i: i + n]))
                if here:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in here if x is not None}
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [1 << 25, 0], ids=["broadcast", "shuffled"])
def test_decontamination(spark, limit):
    rng = random.Random(3)
    passage = " ".join(f"w{rng.randint(0, 40)}" for _ in range(40))
    texts = [passage, f"Before, {passage.upper()} after!", passage + " " + passage, " ".join(passage.split()[5:18]),
             " ".join(passage.split()[5:17]), "tiny item", "x tiny-item y", "Été é " * 9, LONG + passage]
    texts += [" ".join(f"w{rng.randint(0, 5)}" for _ in range(60)) for _ in range(20)]
    docs = odd_documents(spark, texts)
    items = [(1, passage), (2, "Tiny item."), (3, None), (4, ""), (2, "Tiny item."), (5, texts[-1]), (None, "y z"), (7, "é É " * 8), (8, "one")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = decontaminate.contamination(docs, benchmark, broadcast_bytes=limit)
    assert tuples(got, *columns) == contaminated(texts_of(docs), items)
    assert got.where("n_hit > 0").count() > 5


def test_clean_documents_keep_rows_and_columns(spark):
    docs = odd_documents(spark, ["the passage of the benchmark"])
    items = spark.createDataFrame([(1, "passage of the benchmark")], "item_id long, text string")
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert decontaminate.clean_documents(docs, items.limit(0)).count() == docs.count()
    assert decontaminate.contamination(docs.limit(0), items).count() == 0


def print_of(text, width=3):
    words = (text or "").translate(ASCII).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i: i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(points, reach):
    """Root of each point when all pairs within ``reach`` bits are linked."""
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in points:
        for b in points:
            if (a ^ b).bit_count() <= reach:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in points}


def test_simhash(spark):
    docs = odd_documents(spark, ["a b c d e", "a b  c D e", "a b", "b a", LONG + "end", LONG + "fin"])
    rows = texts_of(docs)
    prints = {t: print_of(t) for _, t in rows}
    roots = linked(set(prints.values()), 2)
    least = {}
    for doc, text in rows:
        if doc is not None:
            least[roots[prints[text]]] = min(doc, least.get(roots[prints[text]], doc))
    expected = sorted([(d, f"{prints[t]:016x}", least.get(roots[prints[t]])) for d, t in rows], key=repr)
    assert tuples(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots.values()))
    assert simhash.near_duplicates(docs.limit(0)).count() == simhash.keep_one(docs.limit(0)).count() == 0


def test_vantage_trees_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 60)
    monkeypatch.setattr(simhash, "LEAF_ROWS", 8)
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    points = set(map(int, seeds))
    for s in map(int, seeds):  # chains of near points and dense balls
        for _ in range(25):
            s ^= 1 << int(rng.integers(64))
            points.add(s)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    distinct = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r.node % 2**64: r.root % 2**64 for r in simhash.components(simhash.links(distinct, 2)).collect()}
    expected = linked(points, 2)
    groups = lambda of: sorted(sorted(p for p in points if of(p) == r) for r in {of(p) for p in points})
    assert groups(lambda p: found.get(p, p)) == groups(expected.get)
    members = np.array(sorted(points), np.uint64)
    pairs = {(int(x), int(y)) for a, b in simhash.pairs(members, members, 3) for x, y in zip(a, b, strict=True)}
    assert pairs == {(a, b) for a in points for b in points if (a ^ b).bit_count() <= 3}


def near_points(n=40):
    rng = np.random.default_rng(5)
    points = set()
    for s in map(int, rng.integers(0, 1 << 63, n, dtype=np.uint64)):
        for _ in range(25):
            points.add(s)
            s ^= 1 << int(rng.integers(64))
    return points


def test_shards_are_split_pass_by_pass(spark, monkeypatch):
    for name, value in (("SHARD_ROWS", 20), ("LEAF_ROWS", 8), ("FANOUT", 3), ("FULL", 2), ("ROUTE_ROWS", 150), ("SAMPLE", 200)):
        monkeypatch.setattr(simhash, name, value)
    points = near_points()
    distinct = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in points], "fp long").repartition(3)
    sent = simhash.shards_of(distinct, 2)
    counts = sent.groupBy("shard").agg(F.count(F.when(F.col("home"), 1)).alias("n")).collect()
    assert max(r.n for r in counts) <= 40 and sum(r.n for r in counts) == len(points) and len(counts) > 9  # more than two passes' worth
    found = {r.node % 2**64: r.root % 2**64 for r in simhash.components(simhash.links(distinct, 2)).collect()}
    expected = linked(points, 2)
    groups = lambda of: sorted(sorted(p for p in points if of(p) == r) for r in {of(p) for p in points})
    assert groups(lambda p: found.get(p, p)) == groups(expected.get)


@pytest.mark.parametrize("shards, before", [(125, 9.5), (512, 18), (4_096, 47)])
def test_copies_over_borders(shards, before):
    """Random fingerprints are the worst case; ``before`` is what sending both ways cost."""
    points = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 65_536, dtype=np.uint64) * np.uint64(2))
    tree = simhash.grow(points, shards, 2)
    index, shard, home = simhash.route(tree, points, 2)
    copies = len(index) / len(points)
    print(f"{shards} shards: {copies:.1f} copies a row, {before} before")
    assert home.sum() == len(points) and copies < 0.6 * before


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i: i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len({p for i, w in enumerate(windows) if seen[w] > 1 for p in range(i, i + 5)}))


def test_line_rules(spark):
    shared = "The menu of this very long host has many words"
    own = [f"{shared}\nA first line of document {'abcdefghij'[i % 10] * (i + 1)} with some words of its own to be kept" for i in range(30)]
    short = [f"{shared.upper()}  \n{'q' * (i + 1)}" for i in range(5)]
    cycle = ["a b c d e a b c d e f\nx\nx\n y \n y\n#$ é", "one two three four five six one two three four five"]
    docs = odd_documents(spark, own + short + cycle)
    found = line_rules.judge(docs, max_share=0.3)
    rows = [(r.doc_id, *measures(r.text)) for r in docs.collect()]
    assert tuples(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") == sorted(rows, key=repr)
    kept = line_rules.keep_documents(docs, max_share=0.3)
    assert kept.columns == docs.columns
    texts = {t for _, t in texts_of(kept)}
    assert set(own) <= texts and not set(short) & texts
    removed = {r.n_lines_removed for r in found.join(docs.where(F.col("text").isin(own)).select("doc_id"), "doc_id").collect()}
    assert removed == {1}
    # Copies of one text are one document of their host: nothing is boilerplate here.
    copies = spark.createDataFrame([(i, own[0], "h") for i in range(200)], "doc_id long, text string, source string")
    assert line_rules.judge(copies, max_share=0.3).where("kept").count() == 200
    assert line_rules.judge(docs.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [1 << 25, 0], ids=["broadcast", "shuffled"])
def test_lines_above_limits_leave_the_texts(spark, limit):
    shared = "The menu of this very long host has many words"
    own = [f"A first line of document {'abcdefghij'[i % 10] * (i + 1)} with some words of its own to be kept" for i in range(30)]
    docs = odd_documents(spark, [f"{shared}\n\n{x}\n {shared.upper()}" for x in own])
    other = spark.createDataFrame([(500, f"{shared}\n{own[0]}", "en", None, 3, 7, 1, "", "", 0, 0.5)], docs.schema)
    docs = docs.unionByName(other)
    cleaned = line_rules.clean_documents(docs, broadcast_bytes=limit, max_share=0.3)
    kept = line_rules.keep_documents(docs, max_share=0.3)
    assert cleaned.columns == docs.columns
    cut = {f"{shared}\n\n{x}\n {shared.upper()}": f"\n{x}" for x in own}
    assert texts_of(cleaned.orderBy("doc_id", "text")) == sorted(
        ((d, cut.get(t, t)) for d, t in texts_of(kept)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert set(cut.values()) <= {t for _, t in texts_of(cleaned)}
    assert cleaned.where("n_chars <> length(text)").count() == 0
    assert line_rules.clean_documents(docs.limit(0)).count() == 0


def test_line_limits_hold_for_hosts_of_every_size(spark):
    rows = [(f"menu\n{'abcdefghij'[i % 10] * (i + 1)} and ten more words of its own in this one line", "small") for i in range(12)]
    rows += [(f"{'menu' if i < 25 else 'q' * i}\n{'w' * (i + 1)} and ten more words of its own in this one line", "large") for i in range(1500)]
    rows += [(f"menu\n{'v' * (i + 1)} and ten more words of its own in this one line", "few") for i in range(line_rules.FLOOR - 1)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, source string")
    found = line_rules.judge(docs).join(docs, "doc_id").groupBy("source").agg(F.sum("n_lines_removed")).collect()
    assert {r[0]: r[1] for r in found} == {"small": 12, "large": 25, "few": 0}


def test_pipeline_drops_lines_above_limits(spark):
    shared = "The menu of this very long host has many words"
    rows = [(i, f"{shared}\nA first line of document {'abcdefghij'[i % 10] * (i + 1)} with some words of its own to be kept", "h") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert corpus_pipeline.quality_rules(spark, docs, "").where(F.col("text").contains(shared)).count() == 0


def jump(key, shards):
    bucket, to = -1, 0
    while to < shards:
        bucket, key = to, (key * 2862933555777941757 + 1) % 2**64
        to = int((bucket + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return bucket


def test_jump_hash(spark):
    keys = [0, 1, -1, 2**62, -2**63, 2**63 - 1, *range(2, 400)]
    df = spark.createDataFrame([(k,) for k in [*keys, None]], "k long")
    for n in (1, 2, 8, 9, 300):
        got = {r.k: r.s for r in df.select("k", sharding.jump(F.col("k"), n).alias("s")).collect()}
        assert got == {**{k: jump(k % 2**64, n) for k in keys}, None: jump(0, n)}


def test_sharding(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 4)
    docs = odd_documents(spark, [f"t{i}" for i in range(300)])
    out = sharding.shard(docs)
    rows = out.collect()
    assert out.count() == docs.count() and {r.law for r in rows} == {"key"}
    for s in {r.shard for r in rows}:
        own = sorted((r for r in rows if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert [r.doc_id for r in own if r.doc_id is not None] == sorted(r.doc_id for r in own if r.doc_id is not None)
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    assert sharding.shard(docs.limit(0)).count() == 0


def test_archives(spark, monkeypatch):
    for name, value in (("ARCHIVE_BYTES", 4_000), ("RANGE_ROWS", 9), ("MERGED_ROWS", 4)):
        monkeypatch.setattr(warc, name, value)
    rows = [(i, f"http://www.a.example/{i % 7}", f"x{i % 5}") for i in range(60)]
    rows += [(100, None, None), (101, "u v", ""), (102, "::", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (None, "http://q", ""),
             (101, "u v", ""), (103, "http://[bad", "é" * 100_000), (104, "http://b\r\nWARC-Type: x", "y")]
    pages = spark.createDataFrame([(*r, 1, "clash") for r in rows], "page_id long, url string, html string, size int, last string")
    best = {}
    for i, _, html in rows:
        best[html or ""] = max(best.get(html or "", -1), -1 if i is None else i)
    expected = []
    for i, _, html in rows:
        raw, last = (html or "").encode(), best[html or ""]
        expected.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                         "response" if i == last else "revisit", None if i == last else last))
    got = warc.capture_histories(pages)
    assert tuples(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(expected, key=repr)
    index = got.orderBy("shard", "place").collect()
    order = [(r.url_key, r.captured) for r in index]
    assert order == sorted(order)
    assert len({r.shard for r in index}) >= 5 and len({r.archive for r in index}) >= 10  # ranges and archives by size
    assert warc.capture_histories(pages.limit(0)).count() == 0


def test_archives_are_rolled_by_bytes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 60_000)
    rows = [(i, f"http://a/{i}", chr(65 + i % 26) * (i % 9) * 1_000 + str(i)) for i in range(200)] + [(500, "http://b", "z" * 300_000)]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), str(tmp_path / "a"))
    sizes = [len(gzip.decompress(f.read_bytes())) for f in (tmp_path / "a").glob("part-*")]
    assert len(sizes) > 10 and sorted(sizes)[-2] < 90_000 and max(sizes) > 300_000
    assert warc.read_archives(spark, str(tmp_path / "a")).count() == len(rows)


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted(rng.randint(0, 30) for _ in range(rng.randint(0, 20))) for _ in range(k)]
    assert list(warc.LoserTree(map(iter, runs), lambda e: e)) == sorted(x for r in runs for x in r)


def test_damaged_archive_raises():
    good = warc.record(1, "http://a", "text", warc.digest(b"text"), 4, None).encode() + b"\r\n\r\n"
    assert len(list(warc.parse(good, "a"))) == 1
    for bad in (good[:-3], b"junk" + good, good.replace(b"text\r\n\r\n", b"tixt\r\n\r\n")):
        with pytest.raises(ValueError):
            list(warc.parse(bad, "a"))
