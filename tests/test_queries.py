"""Every core query runs, and gives the rows of its SQL."""

import pytest

from stepweave.plans import catalog
from tests.conftest import compare

SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf, name):
    compare(spark, sf, catalog.queries()[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL)))
def test_runs(spark, sf, name):
    df = catalog.queries()[name](spark, sf)
    assert df.count() >= 0 and len(set(df.columns)) == len(df.columns)


def test_entry(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
