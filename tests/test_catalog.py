"""Every registered query runs at the smallest scale factor with a stable schema."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_oracles_are_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["customer_id", "som_group_x", "som_group_y", "som_cluster"]


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_runs(spark, name):
    df = E.queries()[name](spark, SF)
    assert df.count() >= 0
    assert len(df.columns) == len(set(df.columns))
