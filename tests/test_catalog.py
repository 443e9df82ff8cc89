"""Every catalog query: against its SQL twin where it has one, else that it gives rows."""

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry_module
from larkspur.plans import load_all

FOLDER = "/root/testdata/sf0.001"
CATALOG = load_all()
WITH_SQL = sorted(n for n, q in CATALOG.items() if q.sql)
ROWS_ONLY = sorted(set(CATALOG) - set(WITH_SQL))


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", WITH_SQL)
def test_same_as_sql(spark, con, name):
    assert compare(CATALOG[name](spark, FOLDER), con, CATALOG[name].sql) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, name):
    assert CATALOG[name](spark, FOLDER).collect()


def test_contract(spark):
    queries, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(sql) <= set(queries) and set(CATALOG) <= set(queries)
    assert entry_module.entry(spark).columns == ["n_name", "amount"]
