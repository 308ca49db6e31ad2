"""Digests for many periods, and requests answered from the stored table."""

from __future__ import annotations

import os
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from sheaf.functions.dates import period_threshold, period_threshold_col
from sheaf.operators import digest as dg
from sheaf.operators import summaries as sm
from sheaf.sources import points as ps
from tests.conftest import rows

AS_OF = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
NOW = AS_OF.timestamp()
POINTS = "collection string, point_id long, date string, createdAt double, _node_content string"
REQUESTS = "request_id string, collection_name string, community_id string, platform_id string, period string"


def test_bucket_of_a_value(spark):
    bounds = [1.0, 2.0, 2.5, 9.0]
    for n in range(1, 5):
        df = spark.createDataFrame([(v / 4, bounds[:n]) for v in range(0, 44)], "v double, b array<double>")
        for r in df.select("v", dg.bucket_of(F.col("v"), F.col("b")).alias("i")).collect():
            assert r["i"] == sum(x < r["v"] for x in bounds[:n]) - 1


@pytest.mark.parametrize("n_periods", [1, 2, 5, 37])
def test_many_periods_equal_one_request_at_a_time(spark, n_periods):
    rng = random.Random(n_periods)
    data = [(f"c{rng.randrange(3)}", i, "2024-05-01", NOW - rng.uniform(0, 40) * 3600, '{"text": "t%d"}' % i) for i in rng.sample(range(400), 300)]
    data += [("c0", 7000, "2024-05-01", NOW - 60, '{"text": "twin"}')] * 2
    asked = [(f"{c}#{h}", c, None, None, f"{h}h") for c in ("c0", "c1", "none") for h in rng.sample(range(1, 60), n_periods)]
    asked += [("ids", None, "c", "p", "3h"), ("bad", "c0", None, None, "1h\n")]
    got = {r["request_id"]: r for r in dg.digest_requests(spark.createDataFrame(data, POINTS), spark.createDataFrame(asked, REQUESTS), AS_OF, limit=6).collect()}
    assert len(got) == len(asked) and got["bad"]["status"] == "bad_period"
    for request, collection, _, _, period in asked[:-1]:
        since = NOW - int(period[:-1]) * 3600
        own = sorted((i, node[10:-2]) for c, i, _, at, node in data if c == collection and at > since)[:6]
        want = "\n".join(t for _, t in own) or "No recent data found for the specified period."
        assert got[request]["digest"] == want and got[request]["n_points"] == len(own)


def test_no_requests_and_no_points(spark):
    points = spark.createDataFrame([("c", 1, "2024-05-01", NOW, '{"text": "t"}')], POINTS)
    asked = spark.createDataFrame([("a", "c", None, None, "5h")], REQUESTS)
    assert dg.digest_requests(points, asked.limit(0), AS_OF).count() == 0
    assert dg.digest_requests(points.limit(0), asked, AS_OF).first()["n_points"] == 0
    late = dg.digest_requests(points, spark.createDataFrame([("a", "c", None, None, "x")], REQUESTS), AS_OF)
    assert late.first()["status"] == "bad_period"


@pytest.mark.parametrize("period", ["1h", "12h", "2024-01-31", "1h\n", "2024-01-31\n", "h", "01h", "١h", "", None])
def test_both_forms_of_a_period_agree(spark, period):
    got = spark.createDataFrame([(period,)], "p string").select(period_threshold_col("p", AS_OF)).first()[0]
    try:
        assert got == period_threshold(period, AS_OF).timestamp()
    except ValueError:
        assert got is None


def _store(spark, path):
    node = '{"text": "%s"}'
    data = [(f"c{c}_p_summary", 100 * c + i, f"2024-0{m}-1{i}", NOW, node % f"{c}{m}{i}") for c in range(4) for m in (1, 2, 3) for i in range(3)]
    return ps.write_points(spark.createDataFrame(data, POINTS), path)


SPANS = "request_id string, community_id string, platform_id string, start_date string, end_date string"


def test_requests_prune_the_store(spark, tmp_dir):
    path = _store(spark, f"{tmp_dir}/store")
    asked = spark.createDataFrame([("latest", "c0", "p", None, None), ("day", "c1", "p", "2024-02-11", None),
                                   ("range", "c1", "p", "2024-2-10", "2024-2-12"), ("none", "c9", "p", None, None), ("bad", "c0", "", None, None)], SPANS)
    want = rows(sm.summaries_workflow(ps.read_points(spark, path), asked))
    # Folders of other collections, and of months before those asked for, can't even be read any more.
    for folder, _, names in os.walk(path):
        keep = "c0_" in folder or "c1_" in folder and "month=2024-01" not in folder
        for name in names:
            if name.endswith(".parquet") and not keep:
                with open(os.path.join(folder, name), "wb") as f:
                    f.write(b"not a parquet file")
                crc = os.path.join(folder, f".{name}.crc")
                if os.path.exists(crc):
                    os.remove(crc)
    got = sm.stored_requests(ps.scan_points(spark, path), asked)
    assert rows(got) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    with pytest.raises(Exception):  # noqa: B017 - whatever the reader says of a file that isn't one
        rows(sm.summaries_workflow(ps.read_points(spark, path), asked))


def test_payload_of_stored_requests(spark, tmp_dir):
    path = _store(spark, f"{tmp_dir}/store")
    asked = spark.createDataFrame([("latest", "c0", "p", None, None), ("range", "c1", "p", "2024-2-10", "2024-2-12")], SPANS)
    got = rows(sm.stored_requests(ps.scan_points(spark, path), asked, extract_text_only=False), "request_id", "date", "point_id", "summary_text")
    assert got == [("latest", "2024-03-12", 2, "032"), *[("range", f"2024-02-1{i}", 100 + i, f"12{i}") for i in range(3)]]
