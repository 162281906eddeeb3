"""Every query against its SQL, row by row."""

import __spark_entry__ as contract
import pytest
import star_oracle
from compare import SMALL, connect, difference

ORACLE = star_oracle.statements()
QUERIES = {name: query for name, query in contract.queries().items() if name in contract._QUERIES}

# Row counts at the smallest scale.
GOLDEN = {
    "ods_mock_data": 6000,
    "dim_customer": 163,
    "dim_seller": 50,
    "dim_product": 149,
    "dim_store": 10,
    "dim_supplier": 10,
    "dim_pet_category": 3,
    "dim_date": 1084,
    "fact_sales": 6138,
    "mart_sales_by_product": 147,
    "mart_sales_by_customer": 163,
    "mart_sales_by_time": 80,
    "mart_sales_by_store": 10,
    "mart_sales_by_supplier": 10,
    "mart_product_quality": 149,
}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    assert difference(df, con, ORACLE[name]) == ""
    if name in GOLDEN:
        assert df.count() == GOLDEN[name]


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 80
