"""What the physical plans must and must not hold."""

import re

import pytest

from ratemill.catalog import all_queries

SF = "/root/testdata/sf0.001"
EAGER = {"kmeans_profiles", "logit_inference", "logit_fit_checks", "tree_depth_search", "tree_nodes", "wald_checks", "sensitivity_refit", "scored_grid", "sparse_cells_scored", "stream_verified", "publish_roundtrip", "publication_log", "expectation_verdicts", "load_manifest"}


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return all_queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(all_queries()) - EAGER))
def test_no_cartesian_product_and_no_python(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p
    assert not re.search(r"Python|Pandas|BatchEval", p)


def test_range_filter_reaches_the_scan(spark):
    p = plan(spark, "q5_verified_counts")
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01" in p and "LessThan(l_shipdate,1999-01-01" in p
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["l_returnflag", "l_shipdate", "l_suppkey"]


def test_status_filter_reads_three_columns(spark):
    p = plan(spark, "q8_status_rows")
    assert "EqualTo(o_orderstatus,F)" in p
    assert "o_custkey" not in re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)


def test_conditional_summary_scans_once(spark):
    from ratemill import fixed
    from ratemill.catalog import star
    from ratemill.operators.aggregates import conditional_prevalence
    p = conditional_prevalence(star.records(spark, SF), fixed.PROFILE)._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan") == 1


def test_as_of_join_does_not_shuffle_the_facts(spark):
    p = plan(spark, "asof_version_join")
    assert "BroadcastHashJoin" in p and "NestedLoop" not in p and "Exchange hashpartitioning" not in p and p.count("FileScan") == 1


def test_row_rules_share_one_scan(spark):
    from ratemill.catalog import quality
    from ratemill.operators.quality import row_issues
    p = row_issues(quality.claims(spark, SF), "claims", quality.SPEC)._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan") == 1


def test_rollup_is_read_by_pruned_partitions(spark):
    p = plan(spark, "q5_from_rollup")
    assert "PartitionFilters: [isnotnull(activity_period" in p and "lineitem" not in p
