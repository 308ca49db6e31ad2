"""Operator 12 against a brute-force version."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sheaf.llm import collocation
from tests.llm.helpers import odd_documents, tuples

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, min_count=10, max_share=50, limit=2000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        for phrase, a in f.items():
            if len(phrase) == 1 or a < min_count:
                continue
            if len(phrase) == 2 and any(len(p) == 3 and phrase in (p[:2], p[1:]) and n >= min_count and 100 * n >= max_share * a for p, n in f.items()):
                continue
            score, k = min((1000000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase)))
            found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        n = sum(c for p, c in f.items() if len(p) == 1)
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:limit])]
    return sorted(out, key=repr)


def some_documents(spark, n=120):
    rng = np.random.default_rng(5)
    fixed = ["a passage that many of the texts share word by word", "la la la la la", "of the", "é日 本 ZZ"]
    rows = []
    for i in range(n):
        words = [f"w{min(25, int(rng.zipf(1.5)))}" for _ in range(int(rng.integers(0, 80)))]
        for f in fixed:
            if rng.random() < 0.5:
                words.insert(int(rng.integers(0, len(words) + 1)), f)
        text = "".join(w + str(rng.choice([" ", " ", " ", "\t", ". ", ",", "\n"])) for w in words)
        rows.append((i, text, ["en", "de", None][i % 3]))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.mark.parametrize("bits", [(64,), (5, 64)])
def test_equals_brute_force_also_when_digests_are_shared(spark, bits):
    docs = some_documents(spark).repartition(4)
    want = brute([(r.lang, r.text) for r in docs.collect()], limit=40)
    assert len(want) > 60
    assert tuples(collocation.collocations(docs, limit=40, bits=bits), *COLUMNS) == want


def test_texts_in_parts_and_hot_nodes(spark, monkeypatch):
    docs = some_documents(spark, 60)
    want = brute([(r.lang, r.text) for r in docs.collect()], min_count=3)
    for name, value in (("HELD", 50), ("WAITING", 7), ("HOT", 20), ("SPREAD", 3)):
        monkeypatch.setattr(collocation, name, value)
    monkeypatch.setattr(collocation, "split_bounded", lambda data: iter(data.split(b" ")))
    monkeypatch.setattr(collocation, "_tokens", lambda text: iter([[w] for w in text.translate(collocation.PIECES).replace(b"\xff", b" \xff ").split()] + [[b"\xff"]]))
    assert tuples(collocation.collocations(docs, min_count=3), *COLUMNS) == want


def test_paths_of_the_graph(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(30, 31), (40, 41), (41, 42), (42, 40), (50, 50)], "before long, after long")
    got = {r.id: (r.path, r.place) for r in collocation.paths(None, links).collect()}
    assert {i: got[i] for i in range(21)} == {i: (0, i) for i in range(21)}
    assert got[31] == (30, 1) and all(got[i] == (i, 0) for i in (40, 41, 42, 50))
    assert collocation.paths(None, links.limit(0)).count() == 0
    docs = spark.createDataFrame([(i, "one long passage that comes again and again") for i in range(12)], "doc_id long, text string")
    docs = docs.selectExpr("*", "'en' AS lang")
    rows = sorted(collocation.collocations(docs).collect(), key=lambda r: r.place)
    assert [r.phrase.split()[0] for r in rows] == ["one", "long", "passage", "that", "comes", "again"] and len({r.path for r in rows}) == 1


def test_odd_rows(spark):
    docs = odd_documents(spark, ["x y z", ". , ;", "one.two"])
    want = brute([(r.lang, r.text) for r in docs.collect()], min_count=2)
    assert tuples(collocation.collocations(docs, min_count=2), *COLUMNS) == want
    assert collocation.collocations(docs.limit(0)).count() == 0
