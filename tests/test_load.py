"""Collections as a base and deltas: what a load writes, what readers see, and loads that end half-way."""

from __future__ import annotations

import os

import pytest

from sheaf.operators import load as ld
from tests.conftest import rows

COLS = "collection string, doc_id string, text string"


def _load(spark, store, docs, run, **more):
    return ld.load_documents(spark.createDataFrame(docs, COLS), store, dim=8, run=run, **more)


def _live(spark, store):
    return rows(ld.read_collection(spark, store), "collection", "doc_id", "chunk_text", "loaded_by")


def _files(store, kind, gen):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(f"{store}/{kind}/gen={gen}") for f in names)


def test_a_small_batch_writes_a_small_generation(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    _load(spark, store, [(f"c{i % 5}", f"d{i}", f"text {i}") for i in range(100)], "1")
    before = ld.generations(spark, store)[1]
    _load(spark, store, [("c1", "d1", "another text")], "2")
    number, names = ld.generations(spark, store)
    assert number == 2 and names[:1] == before and len(names) == 2
    assert _files(store, "points", names[1]) == 1 and _files(store, "documents", names[1]) == 1
    assert len(_live(spark, store)) == 100 and ("c1", "d1", "another text", "2") in _live(spark, store)
    # A batch that changes nothing leaves no generation.
    _load(spark, store, [("c1", "d1", "another text"), ("c2", "d2", "text 2")], "3")
    assert ld.generations(spark, store) == (number, names)
    assert sorted(os.listdir(f"{store}/points")) == sorted(f"gen={n}" for n in names)


def test_emptied_and_dropped_documents_keep_a_row(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    _load(spark, store, [("c", "a", "alpha"), ("c", "b", "beta"), ("e", "x", "far"), ("c", "n", None)], "1")
    _load(spark, store, [("c", "a", " \n\t ")], "2")
    states = {(r["collection"], r["doc_id"]): (r["state"], r["loaded_by"]) for r in ld.read_documents(spark, store).collect()}
    assert states == {("c", "a"): ("empty", "2"), ("c", "b"): ("live", "1"), ("e", "x"): ("live", "1"), ("c", "n"): ("empty", "1")}
    assert _live(spark, store) == [("c", "b", "beta", "1"), ("e", "x", "far", "1")]
    _load(spark, store, [("c", "z", "only")], "3", replace=True)
    assert _live(spark, store) == [("c", "z", "only", "3"), ("e", "x", "far", "1")]
    gone = {r["doc_id"] for r in ld.read_documents(spark, store).collect() if r["state"] == "dropped"}
    assert gone == {"a", "b", "n"}
    # A dropped document comes back, also with the text it had.
    _load(spark, store, [("c", "b", "beta")], "4")
    assert ("c", "b", "beta", "4") in _live(spark, store)


def test_compaction_keeps_what_readers_see(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    for i in range(4):
        _load(spark, store, [("c", "same", "same"), ("c", "moving", f"version {i}"), ("c", f"own{i}", f"only {i}")], str(i))
    live, states = _live(spark, store), rows(ld.read_documents(spark, store), "doc_id", "state", "content_hash")
    ld.compact(spark, store)
    assert len(ld.generations(spark, store)[1]) == 1 and len(os.listdir(f"{store}/points")) == 1
    assert _live(spark, store) == live and rows(ld.read_documents(spark, store), "doc_id", "state", "content_hash") == states
    _load(spark, store, [("c", "more", "more")], "5", compact_after=1)
    assert len(ld.generations(spark, store)[1]) == 1 and len(_live(spark, store)) == len(live) + 1


def test_a_load_that_ends_half_way_leaves_the_old_state(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    _load(spark, store, [("c", "a", "alpha"), ("c", "b", "beta")], "1")
    live = _live(spark, store)

    def broken(texts):
        raise ValueError("the model is down")

    with pytest.raises(Exception, match="the model is down"):
        _load(spark, store, [("c", "a", "changed"), ("c", "z", "new")], "2", embed_fn=broken)
    assert _live(spark, store) == live  # its documents are written, its points and its state aren't
    _load(spark, store, [("c", "a", "changed")], "3")
    assert _live(spark, store) == [("c", "a", "changed", "3"), ("c", "b", "beta", "1")]


def test_two_loads_on_one_state_cannot_both_win(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    _load(spark, store, [("c", "a", "alpha")], "1")
    number, names = ld.generations(spark, store)
    _load(spark, store, [("c", "a", "second")], "2")
    with pytest.raises(Exception, match="(?i)already exists"):
        ld._commit(spark, store, number + 1, names)
    assert _live(spark, store) == [("c", "a", "second", "2")]


def test_an_empty_batch_and_no_store(spark, tmp_dir):
    assert ld.generations(spark, f"{tmp_dir}/none") == (0, [])
    store = _load(spark, f"{tmp_dir}/store", [("c", "a", "alpha")], "1")
    ld.load_documents(spark.createDataFrame([], COLS), store, dim=8)
    assert len(_live(spark, store)) == 1
    empty = ld.load_documents(spark.createDataFrame([], COLS), f"{tmp_dir}/empty", dim=8)
    assert ld.read_collection(spark, empty).count() == 0 and ld.read_documents(spark, empty).count() == 0


def test_a_load_shuffles_texts_once(spark, tmp_dir):
    """Documents and stored hashes meet in one exchange, which also lays out the files; chunks and vectors are not shuffled."""
    store = f"{tmp_dir}/store"
    _load(spark, store, [(f"c{i % 3}", f"d{i}", f"text {i}") for i in range(30)], "1")
    batch = spark.createDataFrame([("c1", "d1", "new"), ("c1", "d1", "newer"), ("c2", "d2", "text 2"), ("c9", "d2", "x"), (None, "n", "y")], COLS)
    changed = ld._changes(batch, ld.read_documents(spark, store), False)
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert {(r["collection"], r["doc_id"]) for r in changed.collect()} == {("c1", "d1"), ("c9", "d2"), (None, "n")}


@pytest.mark.parametrize("keys", [1_000_000, 0], ids=["broadcast", "shuffled"])
@pytest.mark.parametrize("small", [0, 1 << 30], ids=["copied", "dealt out"])
def test_compaction_leaves_texts_where_they_are(spark, tmp_dir, monkeypatch, keys, small):
    """Superseded rows are found by the keys of later generations, whatever the planner's own limit is."""
    monkeypatch.setattr(ld, "BROADCAST_KEYS", keys)
    monkeypatch.setattr(ld, "SMALL_FILE", small)
    store = f"{tmp_dir}/store"
    _load(spark, store, [("c", f"d{i}", f"text {i}") for i in range(40)] + [("c", None, "null")], "1")
    _load(spark, store, [("c", f"d{i}", f"text {i}" if i % 2 else f"new {i}") for i in range(20)], "2")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ld.read_collection(spark, store)._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (keys > 0)
        live = _live_texts(spark, store)
        ld.compact(spark, store)
        assert _live_texts(spark, store) == live
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert live == {("d" + str(i), f"new {i}" if i < 20 and not i % 2 else f"text {i}") for i in range(40)} | {(None, "null")}
    # A key without an id is a key: what it holds is not loaded again.
    _load(spark, store, [("c", None, "null")], "3")
    assert len(ld.generations(spark, store)[1]) == 1


def _live_texts(spark, store):
    return {(r["doc_id"], r["chunk_text"]) for r in ld.read_collection(spark, store).collect()}
