"""Every query with a SQL oracle matches DuckDB exactly on sf0.001."""

import pytest

import __spark_entry__ as E
from tests.oracle import duck, spark_rows, sql_rows

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, sf_small, con, name):
    df = E.queries()[name](spark, sf_small)
    s_cols, s_rows = spark_rows(df)
    d_cols, d_rows = sql_rows(con, SQL[name])
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["customer_id", "last_purchase", "first_purchase"]
    assert df.count() > 0


def test_every_query_has_coverage_tags():
    from basketry.plans.catalog import QUERIES
    for q in QUERIES.values():
        assert q.covers, q.name
