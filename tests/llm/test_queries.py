"""Queries against their SQL; those without SQL have tests of their own."""

import __spark_entry__ as contract
import pytest
from compare import connect, difference
from starmill.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", queries.SQL)
def test_query_equals_sql(spark, con, name):
    assert difference(contract.queries()[name](spark, FOLDER), con, contract.oracle_sql()[name]) == ""


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_a_row_for_each_document(spark, name):
    rows = contract.queries()[name](spark, FOLDER)
    assert rows.select("doc_id").distinct().count() == rows.count() == 200
