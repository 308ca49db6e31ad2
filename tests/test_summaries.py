from __future__ import annotations

from datetime import datetime, timezone

import pytest

from sheaf.functions.dates import check_range, epoch_seconds, period_threshold
from sheaf.operators import digest as dg
from sheaf.operators import summaries as sm
from sheaf.functions.payload import NO_RECENT_DATA, NO_TEXT_CONTENT, SUMMARY_NOT_FOUND

SCHEMA = "collection string, point_id bigint, date string, createdAt double, _node_content string"


def pts(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_text_only_join_and_quarantine(spark):
    df = pts(spark, [
        ("c_p_summary", 3, "2024-01-01", 1.0, '{"text": "third"}'),
        ("c_p_summary", 1, "2024-01-01", 1.0, '{"text": "first"}'),
        ("c_p_summary", 2, "2024-01-01", 1.0, '{"text": "broken'),       # bad JSON → quarantined
        ("c_p_summary", 4, "2024-01-01", 1.0, '["a"]'),                   # JSON, not an object
        ("c_p_summary", 5, "2024-01-01", 1.0, '{"other": 1}'),            # no text key
        ("c_p_summary", 6, "2024-01-01", 1.0, None),                      # no content
    ])
    r = sm.summaries_by_date(df).collect()[0]
    assert r["summaries"] == "\n".join(["first", "third", SUMMARY_NOT_FOUND, SUMMARY_NOT_FOUND])
    assert r["n_summaries"] == 4 and r["n_rejected"] == 2
    with pytest.raises(TypeError):
        sm.summaries_by_date(df, strict=True)


def test_limit_100_per_date_by_point_id(spark):
    data = [("c", i, "2024-01-01", 0.0, f'{{"text": "t{i}"}}') for i in range(150)]
    data += [("c", 1000 + i, "2024-01-02", 0.0, f'{{"text": "u{i}"}}') for i in range(5)]
    out = {r["date"]: r for r in sm.summaries_by_date(pts(spark, data)).collect()}
    assert out["2024-01-01"]["n_summaries"] == 100
    assert out["2024-01-01"]["summaries"].split("\n")[-1] == "t99"
    assert out["2024-01-02"]["n_summaries"] == 5


def test_latest_date_and_single_request(spark):
    df = pts(spark, [
        ("com_plat_summary", 1, "2024-01-01", 0.0, '{"text": "old"}'),
        ("com_plat_summary", 2, "2024-01-03", 0.0, '{"text": "new"}'),
        ("other_summary", 3, "2024-01-05", 0.0, '{"text": "x"}'),
    ])
    r = sm.fetch_summaries_by_date(df, "com", "plat").collect()
    assert [(x["date"], x["summaries"]) for x in r] == [("2024-01-03", "new")]
    r = sm.fetch_summaries_by_date(df, "com", "plat", date="2024-01-01").collect()
    assert r[0]["summaries"] == "old"
    with pytest.raises(ValueError):
        sm.fetch_summaries_by_date(df, "com", "")
    # empty collection: no rows (decision for the unspecified case)
    assert sm.fetch_summaries_by_date(df, "none", "plat").count() == 0


def test_payload_mode_keeps_unparsed_points(spark):
    df = pts(spark, [("c", 1, "d", 0.0, '{"text": "a"}'), ("c", 2, "d", 0.0, "{bad")])
    r = {x["point_id"]: x for x in sm.summaries_payload(df).collect()}
    assert r[1]["summary_text"] == "a" and r[1]["parsed"] == 1
    assert r[2]["summary_text"] is None and r[2]["parsed"] == 0
    content = sm.summaries_payload(df).selectExpr("point_id", "variant_get(parsed_content, '$.text', 'string') AS t")
    assert {x["point_id"]: x["t"] for x in content.collect()} == {1: "a", 2: None}


def test_range_every_day_and_checks(spark):
    df = pts(spark, [("com_plat_summary", 1, "2023-05-02", 0.0, '{"text": "a"}')])
    out = sm.fetch_summaries_by_range(df, "com", "plat", "2023-5-1", "2023-05-03").collect()
    assert sorted((r["date"], r["summaries"]) for r in out) == [
        ("2023-05-01", ""), ("2023-05-02", "a"), ("2023-05-03", "")]
    with pytest.raises(ValueError):
        check_range("2023-05-03", "2023-05-01")
    with pytest.raises(ValueError):
        sm.fetch_summaries_by_range(df, "com", "", "2023-05-01", "2023-05-02")


def test_range_request_table_rejects(spark):
    df = pts(spark, [("c_p_summary", 1, "2023-05-02", 0.0, '{"text": "a"}')])
    req = spark.createDataFrame([("c", "p", "2023-05-03", "2023-05-01"), ("c", "p", "2023-13-45", "2023-05-01"),
                                 ("c", None, "2023-05-01", "2023-05-02")],
                                "community_id string, platform_id string, start_date string, end_date string")
    assert sm.summaries_range(df, req).count() == 0
    reasons = sorted(r["_reject_reason"] for r in sm.range_requests(req).collect())
    assert reasons == ["bad_date", "end_before_start", "no_platform"]


def test_period_parsing():
    now = datetime(2024, 1, 20, 12, 0, tzinfo=timezone.utc)
    assert period_threshold("4h", now) == datetime(2024, 1, 20, 8, 0, tzinfo=timezone.utc)
    assert period_threshold(None, now) == datetime(2024, 1, 20, 11, 0, tzinfo=timezone.utc)
    assert period_threshold("", now) == datetime(2024, 1, 20, 11, 0, tzinfo=timezone.utc)
    assert period_threshold("2024-01-15", now) == datetime(2024, 1, 15, tzinfo=timezone.utc)
    for bad in ("4 hours", "2024-13-45", "h"):
        with pytest.raises(ValueError):
            period_threshold(bad, now)


def test_digest_lines_sentinels_and_threshold(spark):
    df = pts(spark, [
        ("col", 1, "d", 100.0, '{"text": "hi", "metadata": {"author": "ann"}}'),
        ("col", 2, "d", 100.0, '{"text": "plain", "metadata": {}}'),
        ("col", 3, "d", 100.0, '{"text": "no meta"}'),
        ("col", 4, "d", 50.0, '{"text": "too old"}'),
        ("col", 5, "d", 60.0, '{"text": "at threshold"}'),   # strict >
        ("notext", 6, "d", 100.0, '{"metadata": {}}'),
    ])
    req = spark.createDataFrame([(1, "col", None, None), (2, "notext", None, None), (3, None, "a", "b"),
                                 (4, None, None, "b")],
                                "request_id long, collection_name string, community_id string, platform_id string")
    out = {r["request_id"]: r for r in dg.digest_text(df, req, 60.0).collect()}
    assert out[1]["digest"] == "ann: hi\nplain\nno meta"
    assert out[2]["digest"] == NO_TEXT_CONTENT
    assert out[3]["collection"] == "a_b" and out[3]["digest"] == NO_RECENT_DATA
    assert out[4]["status"] == "no_collection" and out[4]["digest"] is None
    prompts = dg.digest_prompt(dg.digest_text(df, req, 60.0)).collect()
    assert len(prompts) == 1 and prompts[0]["prompt"].endswith("\n\nContent:\nann: hi\nplain\nno meta")


def test_digest_limit_500_and_single_request(spark):
    data = [("c", i, "d", 10.0, f'{{"text": "t{i}"}}') for i in range(600)]
    r = dg.fetch_recent(pts(spark, data), period="1h", collection_name="c",
                        as_of=datetime.fromtimestamp(3600.0, tz=timezone.utc)).collect()[0]
    assert r["n_points"] == 500 and r["digest"].split("\n")[-1] == "t499"
    with pytest.raises(ValueError):
        dg.fetch_recent(pts(spark, data), period="1h")
    assert epoch_seconds(datetime(1970, 1, 1, 0, 0, 1, 500000, tzinfo=timezone.utc)) == 1.5


def test_null_text_is_quarantined(spark):
    df = pts(spark, [("c", 1, "d", 0.0, '{"text": null}'), ("c", 2, "d", 0.0, '{"text": "ok"}')])
    r = sm.summaries_by_date(df).collect()[0]
    assert (r["summaries"], r["n_rejected"]) == ("ok", 1)


def test_period_column_form_matches_scalar(spark):
    from sheaf.functions.dates import period_threshold_col
    now = datetime(2024, 1, 20, 12, 0, 0, 250000, tzinfo=timezone.utc)
    periods = ["1h", "4h", "2024-01-15", None, "", "4 hours", "2024-13-45", "h"]
    df = spark.createDataFrame([(p,) for p in periods], "period string")
    got = {r["period"]: r["t"] for r in df.select("period", period_threshold_col("period", now).alias("t")).collect()}
    for p in periods:
        try:
            want = epoch_seconds(period_threshold(p, now))
        except ValueError:
            want = None
        assert got[p] == want, p
