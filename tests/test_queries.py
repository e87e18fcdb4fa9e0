"""Every query of the core against its SQL, on the smallest data."""

import pytest
from foliant.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, data, same, name):
    df = catalogue.QUERIES[name](spark, data)
    if name in catalogue.ORACLES:
        same(df, catalogue.ORACLES[name], data)
    else:
        assert df.columns and df.count() >= 0


def test_every_sql_has_a_query():
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)


def test_entry(spark, data):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 6
    assert set(catalogue.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
