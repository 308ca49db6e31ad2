"""Cases where an earlier version lost or mixed up rows."""

from __future__ import annotations

import json

import pytest

from sheaf.functions.payload import digest_line, is_json
from sheaf.operators import documents as dc
from sheaf.operators import load as ld
from sheaf.operators import web as wb
from sheaf.operators.search import vector_search
from sheaf.session import ensure_checkpoint_dir
from sheaf.streaming.ingest import latest_documents
from tests.conftest import rows


def test_crawl_rounds_stay_within_the_budget(spark, tmp_dir):
    links = [("s", f"p{i:05d}") for i in range(5_000)] + [("p00000", "deep"), ("t", "u0")] + [(f"u{i}", f"u{i + 1}") for i in range(30)]
    edges = spark.createDataFrame([*links, ("s", "p00001")], "src string, dst string")
    seeds = spark.createDataFrame([("s",), ("t",)], "seed string")
    got = wb.crawl_frontier(seeds, edges, budget=20, workdir=f"{tmp_dir}/crawl")
    assert rows(got.where("seed = 's'"), "url", "depth") == sorted([("s", 0), *((f"p{i:05d}", 1) for i in range(19))])
    # A chain goes as deep as the budget reaches.
    assert rows(got.where("seed = 't'"), "url", "depth") == sorted([("t", 0), *((f"u{i}", i + 1) for i in range(19))])
    assert spark.read.parquet(f"{tmp_dir}/crawl").groupBy("seed").count().where("count > 20").count() == 0


def _docs(spark, items):
    return spark.createDataFrame(items, "collection string, doc_id string, text string, seq int")


def test_second_load_keeps_other_documents(spark, tmp_dir):
    store = f"{tmp_dir}/points"
    ld.load_documents(_docs(spark, [("c", f"u{i}", f"text {i}", 0) for i in range(5)] + [("other", "x", "far", 0)]), store, dim=8, run="one")
    ld.load_documents(_docs(spark, [("c", "u9", "new", 0), ("c", "u1", "text 1", 0), ("c", "u2", "changed", 0)]), store, dim=8, run="two")
    got = rows(ld.read_collection(spark, store), "collection", "doc_id", "chunk_text", "loaded_by")
    assert got == [("c", "u0", "text 0", "one"), ("c", "u1", "text 1", "one"), ("c", "u2", "changed", "two"), ("c", "u3", "text 3", "one"),
                   ("c", "u4", "text 4", "one"), ("c", "u9", "new", "two"), ("other", "x", "far", "one")]
    ld.load_documents(_docs(spark, [("c", "u7", "only", 0)]), store, dim=8, run="three", replace=True)
    assert rows(ld.read_collection(spark, store), "collection", "doc_id") == [("c", "u7"), ("other", "x")]


def test_a_batch_loads_the_last_version_of_a_document(spark, tmp_dir):
    docs = _docs(spark, [("c", "a", "first", 1), ("c", "a", "last", 3), ("c", "a", "middle", 2), ("c", "b", "b", 1), ("c", "b", "b", 1)])
    ld.load_documents(docs, f"{tmp_dir}/points", dim=8, sequence="seq")
    got = ld.read_collection(spark, f"{tmp_dir}/points")
    assert rows(got, "doc_id", "chunk_text") == [("a", "last"), ("b", "b")]
    assert got.select("node_id").distinct().count() == 2


@pytest.mark.parametrize("text, good", [
    ('{"text":"a"}', True), (' {"text":"a"} ', True), ('{"text":"a"} xyz', False), ('{"text":"a"}{"b":1}', False), ("{'text':'a'}", False),
    ("1, 2", False), ("[]", True), ("1", True), ('"x"', True), ("", False), ("]", False), ("1], [2", False), (None, False),
    ('{"text":"a","text":"b"}', True), ('{"text":NaN}', True), ('{"text":"\\ud800"}', True), ("NaN", True), ("[" * 5000, False)])
def test_strict_json(spark, text, good):
    df = spark.createDataFrame([(text,)], "n string")
    assert df.select(is_json("n")).first()[0] is good
    if text is not None:
        try:
            json.loads(text)
        except (ValueError, RecursionError):
            assert not good


def test_payloads_as_the_service_reads_them(spark):
    from sheaf.operators.summaries import parse_summaries, summaries_payload
    nodes = ['{"text":"a","text":"b"}', '{"text":NaN,"n":[Infinity,1]}', '{"text":"\\ud800x"}', '{"text":5}', '{"text":{"k":[1]}}', '{"text":null}', '"text"']
    points = spark.createDataFrame([("c", i, "2024-01-01", 0.0, n) for i, n in enumerate(nodes)],
                                   "collection string, point_id long, date string, createdAt double, _node_content string")
    got = [(r["summary_text"], r["_reject_reason"]) for r in parse_summaries(points).orderBy("point_id").collect()]
    assert got == [("b", None), ("NaN", None), ("?x", None), ("5", None), ('{"k":[1]}', None), (None, "null_text"), ("Summary text not found", None)]
    payload = summaries_payload(points).selectExpr("point_id", "to_json(parsed_content) AS j", "parsed").orderBy("point_id").collect()
    assert payload[0]["j"] == '{"text":"b"}' and payload[1]["j"] == '{"n":[null,1],"text":null}' and all(r["parsed"] == 1 for r in payload)


def test_digest_lines_of_odd_payloads(spark):
    cases = [('{"text":"a","metadata":{"author":null}}', "a"), ('{"text":"a","metadata":{"author":"x"}}', "x: a"),
             ("{'text':'a'}", None), ('{"text":"a"} tail', None), ('{"text":"a"}', "a")]
    df = spark.createDataFrame(cases, "n string, want string")
    assert all(r.got == r.want for r in df.select("want", digest_line("n").alias("got")).collect())


def test_search_ranks_on_raw_scores(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0001]), (2, [1.0, 0.0])], "id int, embedding array<float>")
    assert rows(vector_search(df, [1.0, 0.0], 1, "id"), "id", "score") == [(2, 1.0)]


def test_upsert_applies_versions_in_order(spark):
    schema = "collection string, doc_id string, version int, content_hash string"
    stored = spark.createDataFrame([("c", "k", 1, "A")], schema)
    incoming = spark.createDataFrame([("c", "k", 2, "B"), ("c", "k", 3, "A")], schema)
    assert rows(dc.upsert(stored, incoming), "version", "content_hash", "action") == [(3, "A", "update")]


def test_latest_documents_do_not_depend_on_row_order(spark, tmp_dir):
    schema = "collection string, doc_id string, text string, metadata map<string,string>"
    items = [("c", "k", f"v{i}", {"n": str(i)}) for i in range(6)]
    seen = set()
    for n, order in enumerate((items, items[::-1], items[3:] + items[:3])):
        spark.createDataFrame(order, schema).coalesce(1).write.parquet(f"{tmp_dir}/{n}/batch_id=0")
        seen.add(latest_documents(spark, f"{tmp_dir}/{n}").first()["text"])
    assert len(seen) == 1


def test_checkpoint_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Cluster:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Cluster

    monkeypatch.delenv("SHEAF_CHECKPOINT_DIR", raising=False)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)
