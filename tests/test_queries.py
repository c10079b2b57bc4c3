"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from checks.compare import connect, difference

LLM = driver.llm.queries() if driver.llm else {}
QUERIES = {name: query for name, query in driver.queries().items() if name not in LLM}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(driver.oracle_sql()) - set(LLM)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, sf_dir, connection, name):
    result = QUERIES[name](spark, sf_dir).toPandas()
    expected = connection.execute(driver.oracle_sql()[name]).df()
    assert difference(result, expected) is None
    assert len(result) > 0


def test_entry(spark):
    assert driver.entry(spark).columns == ["item_id", "window_end", "cnt", "row_num"]
