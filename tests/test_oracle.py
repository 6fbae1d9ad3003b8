"""Every named query against its SQL twin."""

import pytest
from compare import duck, duck_bag, duck_types, spark_bag, type_differences

import __spark_entry__ as entry_module
from millrace import plans

QUERIES = plans.QUERIES
ORACLES = plans.ORACLES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    assert spark_bag(df) == duck_bag(con, ORACLES[name])
    assert type_differences(df, duck_types(con, ORACLES[name])) == []


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0
