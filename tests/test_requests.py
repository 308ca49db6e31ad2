"""Digests with a period per request, payload mode, and limits made visible."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException

from sheaf.operators import digest as dg
from sheaf.operators import summaries as sm

AS_OF = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
NOW = AS_OF.timestamp()
POINTS = "collection string, point_id long, date string, createdAt double, _node_content string"
REQUESTS = "request_id string, collection_name string, community_id string, platform_id string, period string"


def _points(spark):
    node = '{"text": "%s", "metadata": {"author": "kim"}}'
    return spark.createDataFrame([
        ("garden", 1, "2024-05-01", NOW - 60.0, node % "now"),
        ("garden", 2, "2024-05-01", NOW - 3 * 3600.0, node % "morning"),
        ("garden", 3, "2024-04-20", NOW - 11 * 86400.0, node % "april"),
        ("bare", 4, "2024-05-01", NOW - 5.0, '{"text": "no metadata"}')], POINTS)


def test_each_request_has_its_own_period(spark):
    asked = [("a", "garden", None, None, None), ("b", "garden", None, None, "4h"), ("c", "garden", None, None, "2024-04-01"),
             ("d", "garden", None, None, "2024-13-45"), ("e", "garden", None, None, "4 hours"),
             ("f", None, None, None, "1h"), ("g", "nowhere", None, None, "1h"), ("h", "garden", None, None, "4h")]
    got = {r["request_id"]: r for r in dg.digest_requests(_points(spark), spark.createDataFrame(asked, REQUESTS), AS_OF).collect()}
    assert got["a"]["digest"] == "kim: now"
    assert got["b"]["digest"] == got["h"]["digest"] == "kim: now\nkim: morning"
    assert got["c"]["n_points"] == 3
    assert [got[k]["status"] for k in "defg"] == ["bad_period", "bad_period", "no_collection", "ok"]
    assert got["d"]["digest"] is None and got["g"]["n_points"] == 0


def test_limit_holds_for_each_period(spark):
    asked = spark.createDataFrame([("b", "garden", None, None, "4h"), ("c", "garden", None, None, "2024-04-01")], REQUESTS)
    got = {r["request_id"]: r["n_points"] for r in dg.digest_requests(_points(spark), asked, AS_OF, limit=2).collect()}
    assert got == {"b": 2, "c": 2}
    left = {r["collection"]: (r["n_total"], r["n_dropped"]) for r in dg.digest_dropped(_points(spark), 0.0, limit=2).collect()}
    assert left == {"garden": (3, 1), "bare": (1, 0)}


def test_strict_digest_fails_at_a_node_without_metadata(spark):
    asked = spark.createDataFrame([("a", "bare", None, None, "1h")], REQUESTS)
    assert dg.digest_requests(_points(spark), asked, AS_OF).first()["digest"] == "no metadata"
    with pytest.raises(PySparkException):
        dg.digest_requests(_points(spark), asked, AS_OF, strict=True).collect()


def _stored(spark):
    return spark.createDataFrame([
        ("c_p_summary", 1, "2024-01-01", 1.0, '{"text": "one"}'), ("c_p_summary", 2, "2024-01-01", 2.0, "{broken"),
        ("c_p_summary", 3, "2024-01-03", 3.0, '["x"]')], POINTS)


def test_payload_keeps_every_column_of_a_bad_point(spark):
    got = {r["point_id"]: r for r in sm.summaries_payload(_stored(spark)).collect()}
    assert got[2]["_node_content"] == "{broken" and got[2]["createdAt"] == 2.0
    assert (got[2]["parsed"], got[2]["summary_text"], got[2]["parsed_content"]) == (0, None, None)
    assert got[1]["summary_text"] == "one" and got[3]["summary_text"] == "Summary text not found"


def test_payload_of_ranges_requests_and_workflow(spark):
    asked = spark.createDataFrame([("c", "p", "2024-01-01", "2024-1-3")],
                                  "community_id string, platform_id string, start_date string, end_date string")
    got = sm.summaries_range(_stored(spark), asked, extract_text_only=False).collect()
    assert sorted((r["date"], r["point_id"]) for r in got if r["point_id"]) == [
        ("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-03", 3)]
    assert [r["date"] for r in got if r["point_id"] is None] == ["2024-01-02"]
    asked = spark.createDataFrame([("x", "c", "p", "2024-01-01"), ("y", "c", "", "2024-01-01")],
                                  "request_id string, community_id string, platform_id string, date string")
    got = sm.summaries_for_requests(_stored(spark), asked, extract_text_only=False).collect()
    assert sorted((r["request_id"], r["status"], r["point_id"] or 0) for r in got) == [
        ("x", "ok", 1), ("x", "ok", 2), ("y", "no_platform", 0)]
    flow = spark.createDataFrame([("l", "c", "p", None, None), ("m", "c", "none", None, None)],
                                 "request_id string, community_id string, platform_id string, start_date string, end_date string")
    got = sm.summaries_workflow(_stored(spark), flow, extract_text_only=False).collect()
    assert sorted((r["request_id"], r["date"] or "", r["point_id"] or 0) for r in got) == [("l", "2024-01-03", 3), ("m", "", 0)]
    text = {r["request_id"]: r for r in sm.summaries_workflow(_stored(spark), flow).collect()}
    assert text["m"]["status"] == "ok" and text["m"]["date"] is None and text["m"]["summaries"] == ""
