"""Every registered query against its SQL in DuckDB."""

import pytest
from __spark_entry__ import entry
from compare import connect, differences

from spokeframe.plans.catalog import QUERIES
from spokeframe.plans.oracle import oracle_sql


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    assert differences(df, duck, oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_sql())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
