"""Plan-text checks over every registered query (small tables)."""

import re

import pytest

from conftest import SF_SMALL, plan_text
from statmart.plans.suite import QUERIES

KEYS = sorted(QUERIES)
STAR = ["mart_left_star", "mart_left_star_sql", "mart_inner_star", "mart_type_prefix",
        "flatten_meta_inner", "flatten_meta_left", "dataset_group", "cbs_population_mart",
        "cbs_income_mart", "cbs_care_use_mart", "cbs_district_mart"]


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan_text(QUERIES[k](spark, SF_SMALL)) for k in KEYS}


@pytest.mark.parametrize("key", KEYS)
def test_no_cartesian_no_python(plans, key):
    plan = plans[key]
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)


@pytest.mark.parametrize("key", STAR)
def test_star_marts_broadcast_and_prune(plans, key):
    plan = plans[key]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # lineitem has 11 columns; the marts read only those they use
    for schema in re.findall(r"ReadSchema: struct<(l_[^>]*)>", plan):
        assert schema.count(":") <= 7


def test_left_star_filters_reach_scans(plans):
    plan = plans["mart_left_star"]
    assert "Not(EqualTo(p_type,PROMO))" in plan
    assert "Not(EqualTo(l_suppkey,0))" in plan      # inferred onto the fact scan


def test_partitioned_read_prunes(plans):
    assert re.search(r"PartitionFilters: \[[^\]]*jaar_bucket", plans["mart_partitioned_read"])
    assert re.search(r"PartitionFilters: \[[^\]]*jaar_bucket", plans["range_partition"])


@pytest.mark.parametrize("key", ["flatten_meta_right", "flatten_meta_full"])
def test_outer_flatten_reads_the_fact_twice_at_most(plans, key):
    assert 1 <= len(re.findall(r"Location: .*lineitem\.parquet", plans[key])) <= 2


def test_no_limited_counts():
    """A limit before a count would bring the rows of every partition to one task."""
    import pathlib
    import statmart
    root = pathlib.Path(statmart.__file__).parent / "operators"
    for p in root.glob("*.py"):
        assert not re.search(r"\.limit\([^)]*\)\.count\(", p.read_text()), p
