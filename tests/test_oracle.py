"""Every query with a SQL oracle equals DuckDB on the bound test tables (sf0.001)."""

import pytest

import __spark_entry__ as E
from paths import SF001
from oracle_check import compare, duck

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    msg = compare(spark, con, key, E.queries()[key], SQL[key], SF001)
    assert msg.startswith("ok"), msg


def test_every_query_has_a_callable():
    assert set(SQL) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "row_id" and len(df.columns) == 55
