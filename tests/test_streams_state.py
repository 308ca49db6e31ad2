"""Streams with keyed state: digests of windows and the intake of requests."""

from __future__ import annotations

import json
import os
import time
from datetime import datetime, timedelta

from sheaf.functions.payload import NO_TEXT_CONTENT
from sheaf.operators.load import generations, read_collection, read_documents
from sheaf.streaming import intake, windows
from tests.conftest import rows

POINTS = "collection string, point_id bigint, ts timestamp_ntz, _node_content string"
START = datetime(2024, 1, 1)


def _points(spark, path, data):
    spark.createDataFrame([(c, i, START + timedelta(minutes=m), node) for c, i, m, node in data], POINTS).coalesce(1).write.mode("append").parquet(path)


def _digests(spark, src, sink, ck, **more):
    windows.start_window_digests(spark, src, sink, ck, POINTS, window_size="2 hours", slide="1 hour", lateness="1 hour", state_partitions=2, **more).awaitTermination()
    return {(r["collection"], r["window_start"][11:13]): (r["n_points"], r["digest"]) for r in windows.latest_window_digests(spark, sink).collect()
            if r["window_start"] >= "2024-01-01"}


def test_window_digests_over_batches_and_restarts(spark, tmp_dir):
    src, sink, ck = (os.path.join(tmp_dir, n) for n in ("src", "sink", "ck"))
    node = lambda t: json.dumps({"text": t, "metadata": {"author": "kim"}})
    _points(spark, src, [("a", 5, 10, node("five")), ("a", 2, 70, node("two")), ("b", 1, 15, "broken")])
    first = _digests(spark, src, sink, ck, limit=2)
    assert first[("a", "00")] == (2, "kim: two\nkim: five") and first[("a", "01")] == (1, "kim: two")
    assert first[("b", "00")] == (1, NO_TEXT_CONTENT)
    # A second run goes on with the state: a smaller id pushes the largest out, an unchanged window writes nothing.
    _points(spark, src, [("a", 1, 20, node("one")), ("a", 9, 20, node("nine"))])
    second = _digests(spark, src, sink, ck, limit=2)
    assert second[("a", "00")] == (2, "kim: one\nkim: two") and second[("a", "01")] == first[("a", "01")]
    latest = sorted(int(d.split("=")[1]) for d in os.listdir(sink) if d.startswith("batch_id="))[-1]
    changed = spark.read.schema(windows.DIGEST).parquet(f"{sink}/batch_id={latest}")
    assert {r["window_start"].hour for r in changed.collect()} <= {0, 23}
    # Once the watermark has passed a window, its state is gone and late points don't open it again.
    _points(spark, src, [("a", 50, 10 * 60, node("later"))])
    _digests(spark, src, sink, ck, limit=2)
    _points(spark, src, [("a", 0, 25, node("too late")), ("a", 51, 10 * 60 + 1, node("on time"))])
    last = _digests(spark, src, sink, ck, limit=2)
    assert last[("a", "00")] == second[("a", "00")] and last[("a", "10")] == (2, "kim: later\nkim: on time")


def _line(doc, text, community="c", **more):
    return json.dumps({"communityId": community, "platformId": "p", "text": text, "metadata": {"k": "v"}, "docId": doc, **more})


def _file(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _intake(spark, src, store, ck):
    intake.start_intake(spark, src, store, ck, dim=8).awaitTermination()
    return rows(read_collection(spark, store), "collection", "doc_id", "chunk_text")


def test_intake_writes_changes_only_and_the_later_version_wins(spark, tmp_dir):
    src, store, ck = (os.path.join(tmp_dir, n) for n in ("in", "store", "ck"))
    _file(src, "a.json", [_line("1", "zz first"), _line("2", "two"), _line("1", "aa later in the file"), "not json", ""])
    assert _intake(spark, src, store, ck) == [("c_p", "1", "aa later in the file"), ("c_p", "2", "two")]
    before = generations(spark, store)
    time.sleep(1.1)
    _file(src, "b.json", [_line("2", "two"), _line("1", "aa later in the file")])
    _intake(spark, src, store, ck)
    assert generations(spark, store) == before  # unchanged repeats write nothing
    time.sleep(1.1)
    _file(src, "0-early-name.json", [_line("2", "two again")])
    time.sleep(1.1)
    _file(src, "0-earlier-name.json", [_line("2", "and the last word")])
    assert ("c_p", "2", "and the last word") in _intake(spark, src, store, ck)
    assert {(r["doc_id"], r["state"]) for r in read_documents(spark, store).collect()} == {("1", "live"), ("2", "live")}


def test_dead_letters(spark, tmp_dir):
    src, sink, ck = (os.path.join(tmp_dir, n) for n in ("in", "dead", "ck"))
    bad = {"{": "no_json", "[1]": "no_object", "7": "no_object", '{"communityId":"c"}': "missing_platformId",
           _line("1", None): "bad_text", _line("1", "t", community=5): "bad_communityId", _line("1", "t", metadata=[1]): "bad_metadata"}
    _file(src, "x.json", [_line("1", "fine"), *bad, _line(None, "fine too", extra={"a": 1})])
    intake.start_dead_letters(spark, src, sink, ck).awaitTermination()
    assert {r["value"]: r["reason"] for r in spark.read.parquet(sink).collect()} == bad
