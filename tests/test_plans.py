"""Physical-plan properties that matter at scale."""

import pytest

from plume.plans import catalog

from .conftest import SF_SMALL

# Queries that write to the scratch folder when called; their plans are
# checked through the read side only.
WRITES = {"silver_write", "gold_incremental", "lda_topics", "bronze_scan", "partition_read", "retention_keep", "delete_where", "compact", "merge_schema",
          "stream_envelope", "bronze_roundtrip", "stream_restart", "stream_count_by_source", "sql_stream",
          "stream_dedup", "stream_parse_yield", "stream_burst_alerts", "stream_trending", "stream_fanout", "medallion_e2e"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - WRITES))
def test_no_cartesian_products(spark, name):
    p = plan(catalog.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, p


def test_partition_filters_reach_the_scan(spark):
    df = catalog.queries()["partition_read"](spark, SF_SMALL)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in p and "source" in p


def test_projection_is_pruned(spark):
    df = catalog.queries()["uri_tail"](spark, SF_SMALL)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert "ReadSchema: struct<page_id:bigint,url:string>" in p


@pytest.mark.parametrize("name", ["top_posts_per_hour", "cap_per_community", "log_tail"])
def test_topk_per_group_limits_before_shuffle(spark, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in p, p


@pytest.mark.parametrize("name", ["dedup_id", "upsert_latest"])
def test_dedup_is_a_partial_aggregate(spark, name):
    p = plan(catalog.queries()[name](spark, SF_SMALL))
    assert "partial_min_by" in p or "partial_max_by" in p, p


@pytest.mark.parametrize("name, column", [("filter_source", "source"), ("filter_community", "source"), ("filter_today", "partition_date"),
                                          ("filter_yesterday", "partition_date"), ("filter_week", "partition_date"),
                                          ("filter_month", "partition_date"), ("filter_last_hours", "partition_date")])
def test_filters_prune_the_stored_view(spark, name, column):
    import re

    p = catalog.queries()[name](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*?), PushedFilters", p).group(1)
    assert column in filters and "json" not in p, p
