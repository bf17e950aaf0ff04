"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as checks

QUERIES, ORACLE = checks.queries(), checks.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLE)))
def test_same_rows_as_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = checks.entry(spark)
    assert df.columns == ["tenure_bucket", "charge_bucket", "churn_label", "n"]
    assert df.agg({"n": "sum"}).first()[0] == 1000
