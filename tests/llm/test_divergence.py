"""Operator 11 against a brute-force version."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sheaf.llm import divergence
from tests.llm.helpers import odd_documents, tuples


def brute(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")))
            for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen, sources = Counter(), defaultdict(Counter)
        for own, source, words in docs:
            if own == lang:
                seen.update(set(words))
                sources[source].update(words)
        kept = {t for t, n in seen.items() if n >= min_docs}
        total, of_lang = {s: sum(n for t, n in c.items() if t in kept) for s, c in sources.items()}, Counter()
        for c in sources.values():
            of_lang.update(c)
        everything = sum(total.values())
        share = {s: {t: 1 + 10**9 * (c[t] + 1) // (total[s] + len(kept)) for t in kept} for s, c in sources.items()}
        lang_share = {t: 1 + 10**9 * (of_lang[t] + 1) // (everything + len(kept)) for t in kept}
        for s, c in sources.items():
            pairs = [(o, sum((share[s][t] - q) ** 2 // q for t, q in share[o].items())) for o in sources if o != s]
            terms = [(t, (share[s][t] - lang_share[t]) ** 2 // lang_share[t]) for t in kept if c[t] and share[s][t] > lang_share[t]]
            for part, found, limit in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda f: (-f[1], f[0].encode()))
                out += [(lang, s, part, t, v, i + 1) for i, (t, v) in enumerate(found[:limit])]
    return sorted(out, key=repr)


def some_documents(spark, n=150, sources=9):
    rng = np.random.default_rng(3)
    words = ["w" + "abcdefghij"[i % 10] * (1 + i // 10) for i in range(90)] + ["Été", "日本", "ZZ9a"]
    rows = []
    for i in range(n):
        text = " ".join(words[min(len(words) - 1, int(rng.zipf(1.4)))] for _ in range(int(rng.integers(0, 60))))
        rows.append((i, text, ["en", "de", None][i % 3], f"s{int(rng.integers(0, sources))}"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("bits", [64, 4])
def test_equals_brute_force_also_when_digests_are_shared(spark, bits):
    docs = some_documents(spark)
    want = brute([(r.lang, r.source, r.text) for r in docs.collect()], top=7)
    assert tuples(divergence.divergence(docs, top=7, bits=bits)) == want


def test_sources_in_blocks_and_terms_in_buckets(spark, monkeypatch):
    docs = some_documents(spark, 200, 23).repartition(5)
    want = brute([(r.lang, r.source, r.text) for r in docs.collect()], min_docs=2)
    for name, value in (("BLOCK", 4), ("BUCKET_ROWS", 50), ("HELD", 30), ("WAITING", 25), ("CHUNK", 64)):
        monkeypatch.setattr(divergence, name, value)
    assert tuples(divergence.divergence(docs, min_docs=2)) == want


def test_odd_rows(spark):
    docs = odd_documents(spark, ["alpha beta", "ALPHA-BETA beta", "beta " * 50, "same"])
    want = brute([(r.lang, r.source, r.text) for r in docs.collect()])
    assert any(not source for _, source, *_ in want)
    assert tuples(divergence.divergence(docs)) == want
    assert divergence.divergence(docs.limit(0)).count() == 0


def test_long_text_is_read_in_pieces():
    from sheaf.llm.common import split_bounded
    data = b"ab c " * 1000 + b"x" * 300 + b" end"
    assert b" ".join(split_bounded(data, 64)).split() == data.split() and max(map(len, split_bounded(data, 64))) <= 364
