"""What the plans must and must not hold."""

from __future__ import annotations

import pytest

from docketry.queries.catalogue import queries

SF = "/root/testdata/sf0.001"
STREAMS = {"stream_ingest", "stream_insert_if_absent", "stream_upsert"}
# The user's decoder is the package's one Python stage.
PYTHON = {"decode_hook"}
NARROW = ["movements_explode", "cases_first", "decisions_first", "doc_requests", "inner_text", "clean_document"]


def plan_of(spark, name):
    return queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(queries()) - STREAMS))
def test_no_python_stage_and_no_cross_join(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert ("MapInPandas" in plan or "Python" in plan) == (name in PYTHON)


@pytest.mark.parametrize("name", NARROW)
def test_page_work_does_not_shuffle_by_key(spark, name):
    # Small tables are spread over the cores first; nothing is grouped, sorted or joined.
    assert "hashpartitioning" not in plan_of(spark, name)
    assert "SinglePartition" not in plan_of(spark, name)


def test_lookup_reaches_the_scan(spark):
    assert "EqualTo(o_custkey,77)" in plan_of(spark, "case_lookup")


def test_one_row_per_key_is_reduced_before_the_shuffle(spark):
    assert "partial_min_by" in plan_of(spark, "first_capture")
    assert "partial_max_by" in plan_of(spark, "latest_capture")
