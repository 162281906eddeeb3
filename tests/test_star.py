from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from sales import sale, staging, star, tuples
from starmill.functions.dates import sale_day
from starmill.operators import dense_key, lookup
from starmill.plans.sql_star import build_fact_sql, raw_dimension
from starmill.plans.star import build_dimensions, build_fact
from starmill.schemas import (
    CUSTOMER,
    DATE,
    DIMENSIONS,
    PET_CATEGORY,
    dimension_schema,
    fact_schema,
)


def test_dates_that_parse(spark):
    texts = ["1/2/2021", "12/31/2021", "01/02/2021", "2021-05-06", "13/40/2021", "1/2/21",
             "1/2/2021 10:00", "", "n/a", None]
    df = spark.createDataFrame([(t,) for t in texts], "sale_date string")
    got = [r["d"] for r in df.select(sale_day("sale_date").alias("d")).collect()]
    assert got == [date(2021, 1, 2), date(2021, 12, 31), date(2021, 1, 2)] + [None] * 7


def test_schemas(ws):
    for dim in DIMENSIONS:
        assert ws.dim(dim).schema.simpleString() == dimension_schema(dim).simpleString()
    assert ws.fact.schema.simpleString() == fact_schema().simpleString()


def test_keys_are_dense(ws):
    for dim in DIMENSIONS:
        rows = ws.dim(dim).agg(
            F.count(dim.key), F.min(dim.key), F.max(dim.key), F.count_distinct(dim.key)
        ).first()
        assert rows[0] == rows[2] == rows[3] and rows[1] == 1


def test_two_spellings_of_a_day_are_one_date(spark):
    tables = star(staging(spark, sale(1, sale_date="1/2/2021"), sale(2, sale_date="01/02/2021")))
    assert tuples(tables["dim_date"], "date_id", "sale_date", "day", "month", "year") == [
        (1, date(2021, 1, 2), 2, 1, 2021)
    ]
    assert tables["fact_sales"].count() == 2


@pytest.mark.parametrize("column, value", [
    ("customer_email", None), ("seller_first_name", None), ("product_category", None),
    ("store_email", None), ("supplier_name", None), ("pet_category", None),
    ("sale_date", None), ("sale_date", "n/a"),
])
def test_sale_without_a_lookup_leaves_the_fact(spark, column, value):
    rows = staging(spark, sale(1, sale_quantity=5), sale(2, **{column: value}))
    assert tuples(star(rows)["fact_sales"], "sale_id", "sale_quantity") == [(1, 5)]


@pytest.mark.parametrize("person", ["customer", "seller"])
def test_a_person_with_two_rows_repeats_the_sales(spark, person):
    rows = staging(
        spark, sale(1, sale_quantity=3), sale(2, sale_quantity=4, **{f"{person}_country": "y"})
    )
    tables = star(rows)
    key = f"{person}_id"
    assert tuples(tables["fact_sales"], "sale_id", key, "sale_quantity") == [
        (1, 1, 3), (2, 2, 3), (3, 1, 4), (4, 2, 4)
    ]
    strict = build_fact(rows, tables, strict_grain=True)
    assert tuples(strict, "sale_id", key, "sale_quantity") == [(1, 1, 3), (2, 1, 4)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_the_lowest_id_gives_a_product_its_attributes(spark, partitions):
    rows = staging(
        spark,
        sale(8, product_price=Decimal("8.00"), product_brand="late"),
        sale(3, product_price=Decimal("3.00"), product_brand="early"),
        sale(5, product_price=None, product_brand=None),
    ).repartition(partitions)
    assert tuples(star(rows)["dim_product"], "product_id", "price", "brand") == [
        (1, Decimal("3.00"), "early")
    ]


@pytest.mark.parametrize("partitions, adaptive, rows_each", [(3, "false", 40), (5, "true", 700)])
def test_star_does_not_depend_on_partitioning(
    ws, conf, monkeypatch, partitions, adaptive, rows_each
):
    conf("spark.sql.shuffle.partitions", str(partitions))
    conf("spark.sql.adaptive.enabled", adaptive)
    # No broadcast joins either: large dimensions are joined by shuffle, hot keys cut.
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup, "SPREAD_FROM_ROWS", 0)
    monkeypatch.setattr(dense_key, "_SMALL_PARTITION_ROWS", rows_each)
    rows = ws.staging.repartition(7)
    dims = build_dimensions(rows)
    for name, df in dims.items():
        assert df.exceptAll(ws.dims[name]).isEmpty() and ws.dims[name].exceptAll(df).isEmpty()
    fact = build_fact(rows, dims)
    assert fact.exceptAll(ws.fact).isEmpty() and ws.fact.exceptAll(fact).isEmpty()


def test_sql_form_of_the_fact_is_the_same(spark):
    rows = staging(spark, sale(1), sale(2, customer_country="y"), sale(3, sale_date="n/a"))
    tables = star(rows)
    dims = {d.table: tables[d.table] for d in DIMENSIONS}
    assert tuples(build_fact_sql(rows, dims), "*") == tuples(tables["fact_sales"], "*")


def test_raw_dimensions_keep_every_row_in_order_of_id(spark):
    rows = staging(
        spark, sale(10), sale(30, customer_first_name="z"), sale(20, pet_category=None),
        sale(40, sale_date="n/a"), sale(50, sale_date=None),
    )
    customers = raw_dimension(rows, CUSTOMER)
    assert tuples(customers, "customer_id", "first_name") == [
        (1, "x"), (2, "x"), (3, "z"), (4, "x"), (5, "x")
    ]
    assert raw_dimension(rows, PET_CATEGORY).count() == 4
    days = tuples(raw_dimension(rows, DATE), "date_id", "sale_date", "year")
    assert days == [
        (1, date(2021, 1, 2), 2021), (2, date(2021, 1, 2), 2021),
        (3, date(2021, 1, 2), 2021), (4, None, None),
    ]


def test_raw_dimension_without_gaps_is_numbered_without_a_sort(spark):
    rows = staging(spark, sale(6), sale(5, customer_first_name="a"))
    df = raw_dimension(rows, CUSTOMER)
    assert tuples(df, "customer_id", "first_name") == [(1, "a"), (2, "x")]
    assert "Sort" not in df._jdf.queryExecution().executedPlan().toString()


def test_raw_dimension_of_repeated_ids_has_distinct_keys(spark):
    rows = staging(spark, sale(1, customer_first_name="b"), sale(1, customer_first_name="a"), sale(3))
    assert tuples(raw_dimension(rows, CUSTOMER), "customer_id", "first_name") == [(1, "a"), (2, "b"), (3, "x")]


def test_nothing_staged_gives_an_empty_star(spark):
    tables = star(staging(spark))
    assert {name: df.count() for name, df in tables.items()} == dict.fromkeys(tables, 0)
