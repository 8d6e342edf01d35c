"""The queries that SQL can express, against their SQL."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__ as driver
from candlemill.llm.queries import registered
from candlemill.llm.sql import oracle_sql

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, name):
    names, sql_names, left, right = compare(registered()[name](spark, SF), connect(SF), oracle_sql()[name])
    assert sorted(names) == sorted(sql_names)
    assert left == right


def test_queries_are_registered():
    assert set(registered()) | {"pipeline"} <= set(driver.queries())
    assert set(oracle_sql()) <= set(driver.oracle_sql())
