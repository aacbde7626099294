"""Every registered query against its SQL on the smallest star tables."""

import pytest
from compare import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
SLOW = {"kmeans_profiles", "logit_inference"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, SF, queries()[name], oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - SLOW))
def test_rows_only(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
