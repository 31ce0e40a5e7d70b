import pytest

from stepweave.llm import oracle, queries
from tests.conftest import compare

SQL = oracle.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf, name):
    compare(spark, sf, queries.queries()[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(SQL)))
def test_runs(spark, sf, name):
    df = queries.queries()[name](spark, sf)
    assert df.count() >= 0 and len(set(df.columns)) == len(df.columns)


COLUMNS = {
    "p1_found": ["result_id", "defect"], "p2_found": ["head_key", "member_key"], "p3_found": ["key_a", "key_b"], "p4_found": ["origin", "keep_id", "copy_id"],
    "p6_found": ["episode_key", "start_step", "end_step"], "p10_found": ["doc_id", "kind"],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, sf, name):
    df = queries.queries()[name](spark, sf)
    assert df.columns == COLUMNS[name] and df.count() == df.distinct().count()
