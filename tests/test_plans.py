"""Scale properties of the physical plans, kept as tests."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from plan_report import plan_nodes, summary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    names = ["summaries_by_date", "digest_text", "upsert", "chunks", "embed_default", "wiki_job_pages",
             "vector_topk", "stored_summaries"]
    return {n: summary(plan_nodes(E.queries()[n](spark, SF))) for n in names}


def test_per_key_limits_are_map_side(plans):
    for name in ("summaries_by_date", "digest_text", "vector_topk", "stored_summaries"):
        assert plans[name]["map-side top-k"] == 1, name
    # The limit's shuffle, and one of the rows that it leaves: payloads are parsed in Arrow batches in between.
    assert plans["summaries_by_date"]["shuffles"] == 2


@pytest.mark.parametrize("name", ["digest_text", "wiki_job_pages"])
def test_small_request_sides_are_broadcast_at_run_time(spark, name):
    df = E.queries()[name](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in final


def test_aggregations_are_partial_and_chunking_does_not_shuffle(plans):
    assert plans["upsert"]["partial aggs"] >= 1 and plans["upsert"]["shuffles"] == 1
    assert plans["chunks"]["shuffles"] == 0
    assert plans["embed_default"]["python nodes"] == 1 and plans["embed_default"]["shuffles"] == 0
