from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheaf import schemas
from sheaf.operators import documents as dc
from sheaf.operators import models as md
from sheaf.operators import search as vs
from sheaf.sources import staging as stg
from sheaf.sources import xmlsplit as xs
from tests.conftest import rows


def test_single_requests_collection_and_default_id(spark):
    req = spark.createDataFrame(
        [("c", "p", "hello", {"k": "v"}, "id1", ["k"], [], None),
         ("c", "p", "hello", {}, None, None, None, ""),
         ("c", "p", "bye", {}, None, [], [], "col")], schemas.INGESTION_REQUEST)
    d = dc.request_documents(req).collect()
    assert [r["collection"] for r in d] == ["c_p", "c_", "c_col"]   # only None falls back
    assert d[0]["doc_id"] == "id1"
    import hashlib
    assert d[1]["doc_id"] == hashlib.sha256("c_\x01hello".encode()).hexdigest()
    assert d[1]["excluded_embed_keys"] == []


@pytest.mark.parametrize("n,batches", [(0, []), (1, [1]), (10, [10]), (11, [10, 1])])
def test_batches_of_ten(spark, n, batches):
    docs = [{"docId": str(i), "text": "t", "metadata": {}, "excludedEmbedMetadataKeys": [],
             "excludedLlmMetadataKeys": []} for i in range(n)]
    req = spark.createDataFrame([(1, "c", "p", None, docs)], "request_id long, " + schemas.BATCH_REQUEST)
    out = dc.batch_documents(req).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in out] == batches


def test_metadata_views(spark):
    df = spark.createDataFrame([("t", {"b": "2", "a": "1", "z": None}, ["b"])],
                               "text string, metadata map<string,string>, ex array<string>")
    r = df.select(dc.content_for("metadata", "ex", "text").alias("x")).collect()[0]
    assert r["x"] == "a: 1\n\nt"           # b excluded, null z left out, keys sorted
    df2 = spark.createDataFrame([("t", {"a": "1"}, ["a"])], "text string, metadata map<string,string>, ex array<string>")
    assert df2.select(dc.content_for("metadata", "ex", "text")).collect()[0][0] == "t"


def test_chunking_edges(spark):
    words = " ".join(f"w{i}" for i in range(1025))
    df = spark.createDataFrame([(1, words), (2, "  \n "), (3, " a  b\tc ")], "doc_id long, text string")
    got = rows(dc.chunk_documents(df, size=512), "doc_id", "chunk_no", "n_tokens")
    assert got == [(1, 0, 512), (1, 1, 512), (1, 2, 1), (3, 0, 3)]
    assert dc.chunk_documents(df.filter("doc_id = 3")).collect()[0]["chunk_text"] == "a b c"


def test_upsert_actions(spark):
    cols = "collection string, doc_id string, version bigint, content_hash string, text string"
    old = spark.createDataFrame([("c", "1", 1, "h1", "a"), ("c", "2", 1, "h2", "b"), ("c", "3", 1, "h3", "c")], cols)
    new = spark.createDataFrame([("c", "2", 2, "h2", "b"), ("c", "3", 2, "h9", "z"), ("c", "4", 2, "h4", "d"),
                                 ("c", "3", 3, "h8", "y")], cols)
    got = rows(dc.upsert(old, new), "doc_id", "version", "text", "action")
    assert got == [("1", 1, "a", "keep"), ("2", 1, "b", "unchanged"), ("3", 3, "y", "update"),
                   ("4", 2, "d", "insert")]


def test_embedding_default(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "id long, text string")
    out = {r["id"]: np.array(r["embedding"]) for r in md.embed(df, dim=16).collect()}
    assert out[1].shape == (16,) and abs(np.linalg.norm(out[1]) - 1) < 1e-6
    assert not out[2].any() and not out[3].any()


def test_embedding_holds_a_slice_of_a_batch(spark):
    """What a worker builds from a batch of 10,000 texts (words, vectors) is bounded by a slice."""
    def sizes(texts):
        return np.full((len(texts), 1), len(texts))
    df = spark.range(0, 3000, 1, 1).select("id", F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    got = [r["embedding"][0] for r in md.embed(df, fn=sizes).collect()]
    assert len(got) == 3000 and max(got) <= 256


def test_vector_search(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], "x"), (2, [0.0, 1.0], "x"), (3, [1.0, 1.0], "y"),
                                (4, [0.0, 0.0], "y")], "id long, embedding array<float>, g string")
    top = [r["id"] for r in vs.vector_search(df, [1.0, 0.2], 2, "id").orderBy("rank").collect()]
    assert top == [1, 3]
    zero = vs.vector_search(df, [0.0, 0.0], 4, "id")           # the reference's zero vector
    assert {r["score"] for r in zero.collect()} == {0.0}
    per = rows(vs.vector_search(df, [1.0, 0.0], 1, "id", keys=["g"]), "g", "id")
    assert per == [("x", 1), ("y", 3)]


def test_extractive_summary(spark):
    lines = spark.createDataFrame([("c", 1, "apple pie"), ("c", 2, "apple tart"), ("c", 3, "pear"),
                                   ("c", 4, "apple apple"), ("d", 5, "x")],
                                  "collection string, point_id long, line string")
    out = {r["collection"]: r for r in md.summarize(lines).collect()}
    assert out["c"]["summary"] == "apple pie apple tart apple apple" and out["c"]["n_lines"] == 4
    custom = md.summarize(lines, fn=lambda body: str(len(body.split("\n"))))
    assert {r["collection"]: r["summary"] for r in custom.collect()} == {"c": "4", "d": "1"}


def test_extractive_sentences_stay_in_their_row(spark, monkeypatch):
    """A text's graph of sentences needs no shuffle, whatever the slices are; blank and NULL texts give no row."""
    texts = [(1, "Ada met Bob. Bob saw Cy! Cy left? The end."), (2, "one. two. three. four."), (3, None), (4, " . "), (5, ""),
             (6, "x y. " * 11 + "q r. r s. s q.")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    want = [(1, 4, "Ada met Bob. Bob saw Cy! Cy left?"), (2, 4, "one. two. three."), (4, 1, "."), (6, 14, "q r. r s. s q.")]
    for words in (md.SLICE_WORDS, 1):
        monkeypatch.setattr(md, "SLICE_WORDS", words)
        got = md.extractive_sentences(df)
        assert rows(got) == want
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_staging_round_trip(spark, tmp_dir):
    docs = spark.createDataFrame([("1", "t", {"k": "v"}, [], [], "c1"), ("2", "u", {}, [], [], "c2")],
                                 schemas.DOCUMENTS + ", community_id string")
    key = stg.store_transformed(docs, tmp_dir, rid="run1")
    assert key.endswith("/transformed/run1")
    assert rows(stg.read_staged(spark, key), "doc_id", "community_id") == [("1", "c1"), ("2", "c2")]
    with pytest.raises(ValueError):
        stg.read_staged(spark, tmp_dir + "/missing")
    empty_key = stg.store_transformed(docs.limit(0), tmp_dir, rid="run2")
    with pytest.raises(ValueError):
        stg.read_staged(spark, empty_key)


def test_xml_level_split(spark):
    xml = '<?xml version="1.0"?><r a="1"><m><x>1</x><y>2</y></m><b>t &amp; u</b></r>'
    df = spark.createDataFrame([(1, xml)], "id long, xml string")

    def split(level):
        return [r["content"] for r in xs.split_xml(df, level=level).orderBy("node_no").collect()]
    assert split(0) == ['<r a="1"><m><x>1</x><y>2</y></m><b>t &amp; u</b></r>']
    assert split(1) == ["<m><x>1</x><y>2</y></m>", "<b>t &amp; u</b>"]
    assert split(5) == ["<x>1</x>", "<y>2</y>", "<b>t &amp; u</b>"]


def test_store_extracted(spark, tmp_dir):
    raw = spark.createDataFrame([("https://a", "t", "c1")], "url string, inner_text string, community_id string")
    key = stg.store_extracted(raw, tmp_dir, rid="r1")
    assert key.endswith("/extracted/r1")
    back = spark.read.json(key).collect()
    assert back[0]["url"] == "https://a" and back[0]["community_id"] == "c1"
    assert stg.run_id().endswith("Z") and ":" not in stg.run_id()


def test_chunking_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    words = st.lists(st.sampled_from(["a", "bb", "ç", "d.e", "\t", "\n", " ", "  "]), max_size=40)

    @settings(max_examples=25, deadline=None)
    @given(st.lists(words.map("".join), min_size=1, max_size=5), st.integers(1, 7))
    def check(texts, size):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = sorted((r["doc_id"], r["chunk_no"], r["chunk_text"])
                     for r in dc.chunk_documents(df, size=size).collect())
        want = []
        for i, t in enumerate(texts):
            toks = t.replace("\t", " ").replace("\n", " ").split()
            want += [(i, k // size, " ".join(toks[k:k + size])) for k in range(0, len(toks), size)]
        assert got == sorted(want)
    check()


def test_load_upsert_skips_unchanged(spark, tmp_dir):
    import os
    from sheaf.operators import load as ld
    cols = "collection string, doc_id string, text string"
    first = spark.createDataFrame([("c", "a", "alpha"), ("c", "b", "beta"), ("c", "d", "delta")], cols)
    second = spark.createDataFrame([("c", "a", "alpha"), ("c", "b", "beta two"), ("e", "x", "new")], cols)
    store = ld.load_documents(first, os.path.join(tmp_dir, "store"), dim=8, run="1")
    metrics = {}
    ld.load_documents(second, store, dim=8, run="2", metrics=metrics)
    assert metrics == {"chunks": 2, "embedded": 2}
    got = rows(ld.read_collection(spark, store), "collection", "doc_id", "chunk_text", "loaded_by")
    assert got == [("c", "a", "alpha", "1"), ("c", "b", "beta two", "2"), ("c", "d", "delta", "1"),
                   ("e", "x", "new", "2")]


def test_xml_files_source(spark, tmp_dir):
    import os
    for i in range(2):
        with open(os.path.join(tmp_dir, f"f{i}.xml"), "w") as f:
            f.write(f'<?xml version="1.0"?>\n<r><a>{i}</a><b>x</b></r>\n')
    nodes = xs.split_xml(xs.read_xml_files(spark, tmp_dir), level=1)
    got = sorted((os.path.basename(r["file"]), r["node_no"], r["content"]) for r in nodes.collect())
    assert got == [("f0.xml", 0, "<a>0</a>"), ("f0.xml", 1, "<b>x</b>"),
                   ("f1.xml", 0, "<a>1</a>"), ("f1.xml", 1, "<b>x</b>")]


def test_exact_upsert_against_sequential_application(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    def sequential(stored, versions):
        # Apply versions one at a time; the action is relative to the stored state.
        state = stored
        for v, h in sorted(versions):
            if state is None or h != state[1]:
                state = (v, h)
        if not versions:
            action = "keep"
        elif stored is None:
            action = "insert"
        else:
            action = "unchanged" if state == stored else "update"
        return state[0], state[1], action

    keyset = st.dictionaries(st.sampled_from("abcde"),
                             st.tuples(st.one_of(st.none(), st.sampled_from("xyz")),
                                       st.lists(st.sampled_from("xyz"), max_size=4)), min_size=1, max_size=4)

    @settings(max_examples=15, deadline=None)
    @given(keyset)
    def check(data):
        cols = "collection string, doc_id string, version bigint, content_hash string"
        old = [("c", k, 1, h) for k, (h, _) in data.items() if h is not None]
        new = [("c", k, 2 + i, h) for k, (_, hs) in data.items() for i, h in enumerate(hs)]
        if not old and not new:
            return
        got = {r["doc_id"]: (r["version"], r["content_hash"], r["action"]) for r in dc.upsert(
            spark.createDataFrame(old, cols), spark.createDataFrame(new, cols), exact_versions=True).collect()}
        want = {}
        for k, (h, hs) in data.items():
            if h is None and not hs:
                continue
            stored = (1, h) if h is not None else None
            want[k] = sequential(stored, [(2 + i, x) for i, x in enumerate(hs)])
        assert got == want
    check()
