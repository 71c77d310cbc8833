"""What the plans must look like: filters and columns reach the scan, and no join is a product of rows."""

from __future__ import annotations

import os
import re

import pytest

from millrace.plans import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables aren't there")


def plan(spark, name):
    return registry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(spark, "q_duration_filter")
    assert "PushedFilters: [Or(IsNull(duration),And(GreaterThanOrEqual(duration,1.0),LessThanOrEqual(duration,10.0)))]" in p
    assert "ReadSchema: struct<entry_id:bigint,duration:double>" in p
    assert "ReadSchema: struct<text:string>" in plan(spark, "q_word_count_range")


@pytest.mark.parametrize("name", ["q_overlap_join", "q_member_join", "q_pseudo_labels", "q_many_left_joins", "q_min_count_source", "q_random_negatives", "q_wer_by_attribute", "q_stratified_split", "q_round_robin_lang", "q_sequential_packs", "p6_found"])
def test_no_products(spark, name):
    assert not re.search("CartesianProduct|NestedLoopJoin", plan(spark, name))
