"""Physical plans of the registered queries."""

import re

import pytest

from flowtables.suite import QUERIES
from tests.test_oracle import FOLDER

NARROW = [
    "apply_rules_clone", "apply_rules_merge", "batch_by_duration", "edge_labels", "effective_endpoint",
    "elide_restore", "expire_by_setting", "expire_rows", "flatten_rules", "funnel_union", "group_ports",
    "keep_present", "parse_literals", "parse_rules", "position_roundtrip", "prune_empty", "render_rules",
    "set_attributes", "sparse_diff_wide",
]


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", NARROW)
def test_row_wise_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "expire_rows")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts", text)
    assert "props" not in text
    assert "PushedFilters: [IsNotNull(p_size), EqualTo(p_size,20)" in plan(spark, "build_edges")
    assert "l_extendedprice" not in plan(spark, "dangling_edges")


def test_top_k_is_limited_before_the_exchange(spark):
    text = plan(spark, "prioritized_topk")
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_rules_document_is_parsed_once(spark):
    assert plan(spark, "parse_rules").count("from_xml") == 1
    assert plan(spark, "flatten_rules").count("from_xml") == 1
