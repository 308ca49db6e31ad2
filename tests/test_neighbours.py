"""Exact nearest neighbours for a table of queries, against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheaf.operators import neighbours as nb


def _brute(vectors, k):
    unit = {i: v / np.linalg.norm(v) if np.linalg.norm(v) else v * 0 for i, v in vectors.items()}
    out = {}
    for q in vectors:
        if q % 20 == 0:
            scores = sorted((-round(float((unit[q] * unit[i]).sum()), 12), i) for i in vectors if i != q)
            out[q] = [(i, round(-s, 6) + 0.0) for s, i in scores[:k]]
    return out


@pytest.mark.parametrize("kind", ["clusters", "spread", "copies"])
def test_equal_to_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(nb, "BLOCK_ROWS", 30)
    rng = np.random.default_rng(len(kind))
    n, dim = 400, 8
    if kind == "clusters":
        centres = rng.normal(size=(12, dim)) * 3
        m = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * 0.05
    elif kind == "spread":
        m = rng.normal(size=(n, dim))
    else:
        m = np.repeat(rng.normal(size=(4, dim)), [250, 100, 49, 1], axis=0)  # most rows are one vector
    m = m.astype(np.float32)
    m[[3, 40, 41]] = 0
    vectors = {i: m[i].astype(float) for i in range(n)}
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors.items()] + [(9000, None)], "vec_id long, embedding array<float>").repartition(5)
    got = {}
    for r in nb.nearest(df, F.col("vec_id") % 20 == 0, 7, centres=16).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], r["score"] + 0.0))
    want = _brute(vectors, 7)
    assert got.keys() == want.keys()
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=2e-6)
        assert got[q] == want[q] or kind == "spread" and {i for i, _ in got[q]} == {i for i, _ in want[q]}
    if kind == "clusters":
        report = nb.nearest(df, F.col("vec_id") % 20 == 0, 7, centres=16, report=True)
        searched, cells = report.agg(F.sum("searched"), F.sum("cells")).first()
        print(f"searched {searched} of {cells} cells")
        assert report.count() == len(want) and searched < 0.8 * cells


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], schema)
    assert [(r["query_id"], r["id"]) for r in nb.nearest(one, F.col("vec_id") % 20 == 0, 10).collect()] == [(0, 1)]
    assert nb.nearest(one.limit(0), F.lit(True), 3).count() == 0
    assert nb.nearest(one, F.lit(False), 3).count() == 0
