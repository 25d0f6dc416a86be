"""Every SQL-checkable query against its DuckDB oracle on the smallest data."""

import pytest

import parity
from conftest import SF001

import __spark_entry__ as E

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return parity.duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_oracle_parity(spark, con, name):
    s_tbl = E.queries()[name](spark, SF001).toArrow()
    d_tbl = parity.oracle_table(con, E.oracle_sql()[name])
    rep = parity.compare(s_tbl, d_tbl)
    assert rep["ok"], rep


def test_every_query_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0
