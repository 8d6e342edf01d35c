"""Every registered query on market data against its SQL."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__ as driver
from candlemill.oracle import oracle_sql
from candlemill.queries import registered

SF = "/root/testdata/sf0.001"
QUERIES = registered()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
        assert word not in plan
    names, sql_names, left, right = compare(df, con, SQL[name])
    assert sorted(names) == sorted(sql_names)
    assert len(left) == len(right)
    assert left == right


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() == 5
