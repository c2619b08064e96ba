"""Every registered query with an oracle matches DuckDB on the small tables;
queries without one (model jobs) are exercised in test_models.py."""

import pytest

from conftest import SF_SMALL
from oracle_check import compare, duck_connection

import __spark_entry__ as E

SQL = E.oracle_sql()
NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(SQL[name]).df()
    assert compare(got, want) is None


def test_every_query_has_callable():
    qs = E.queries()
    assert set(SQL) <= set(qs)
    assert len(qs) >= 100


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 96
    assert set(df.columns) == {"candidate", "slice", "n", "accuracy", "balanced_accuracy", "weighted_accuracy",
                               "errors", "weighted_errors"}
