"""Every registered query with an oracle agrees with DuckDB on the small tables."""

import pytest

import __spark_entry__ as E
from tests.oracle import assert_same, duck
from tests.conftest import SF_SMALL

SQLS = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    assert_same(QUERIES[name](spark, SF_SMALL), SQLS[name], con)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQLS)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0
    assert len(df.columns) > 0
