from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from sales import sale, staging, star, tuples
from starmill.functions.money import rounded_average
from starmill.plans.marts import MARTS, build_mart
from starmill.schemas import mart_schema


def test_schemas(ws):
    for name in MARTS:
        assert ws.mart(name).schema.simpleString() == mart_schema(name).simpleString()


def test_totals_agree_with_the_fact(ws):
    amount, orders = ws.fact.agg(F.sum("sale_total_price"), F.count("*")).first()
    for name, total in [
        ("mart_sales_by_product", "total_revenue"), ("mart_sales_by_customer", "total_spent"),
        ("mart_sales_by_time", "total_revenue"), ("mart_sales_by_store", "total_revenue"),
        ("mart_sales_by_supplier", "total_revenue"), ("mart_product_quality", "total_revenue"),
    ]:
        got = ws.mart(name).agg(
            F.sum(F.col(total).cast("decimal(20,2)")), F.sum("orders_count")
        ).first()
        assert tuple(got) == (amount, orders), name


def test_quality_without_unsold_products_is_sales_by_product(ws):
    shared = ["product_id", "name", "category", "rating", "reviews", "total_quantity",
              "total_revenue", "orders_count"]
    sold = ws.mart("mart_product_quality").filter("orders_count > 0")
    assert tuples(sold, *shared) == tuples(ws.mart("mart_sales_by_product"), *shared)


def test_months_come_in_order(ws):
    months = [(r["year"], r["month"]) for r in ws.mart("mart_sales_by_time").collect()]
    assert months == sorted(months) and len(months) == 80


def test_unsold_product_has_no_sums_and_zero_counts(spark):
    tables = star(staging(
        spark, sale(1, sale_quantity=5), sale(2, product_name="unsold", pet_category=None)
    ))
    got = tuples(build_mart("mart_product_quality", tables), "name", "total_quantity",
                 "total_revenue", "orders_count", "unique_customers")
    assert got == [("unsold", None, None, 0, 0), ("x", 5, 10.0, 1, 1)]
    assert build_mart("mart_sales_by_product", tables).count() == 1


def test_unique_customers_counts_customer_rows(spark):
    tables = star(staging(
        spark, sale(1), sale(2), sale(3, customer_email="other"), sale(4, customer_pet_name="two")
    ))
    got = tuples(build_mart("mart_product_quality", tables), "orders_count", "unique_customers")
    # Sales 1, 2 and 4 each meet both rows of the first customer.
    assert got == [(7, 3)]


def test_average_product_price_is_weighted_by_sales(spark):
    tables = star(staging(
        spark, sale(1, product_price=Decimal("1.00")), sale(2), sale(3),
        sale(4, product_name="dear", product_price=Decimal("9.00")),
        sale(5, product_name="free", product_price=None),
    ))
    got = tuples(build_mart("mart_sales_by_supplier", tables), "supplier_name",
                 "avg_product_price", "orders_count")
    assert got == [("x", 3.0, 5)]


def test_missing_amounts_are_orders_but_not_in_the_average(spark):
    tables = star(staging(
        spark, sale(1, sale_total_price=None), sale(2, sale_total_price=Decimal("3.00"))
    ))
    got = tuples(build_mart("mart_sales_by_store", tables), "orders_count", "total_revenue",
                 "avg_order_value")
    assert got == [(2, 3.0, 3.0)]
    tables = star(staging(spark, sale(1, sale_total_price=None)))
    got = tuples(build_mart("mart_sales_by_store", tables), "orders_count", "total_revenue",
                 "avg_order_value")
    assert got == [(1, None, None)]


@pytest.mark.parametrize("total, n, expected", [
    ("0.05", 10, "0.01"),           # a tie goes up
    ("-0.05", 10, "-0.01"),         # away from zero
    ("100499.99", 100000, "1.00"),  # just below a tie that six decimals would not tell
    ("5024999999999.99", 10**12, "5.02"),
    ("1.00", 0, None),
])
def test_average_is_exact(spark, total, n, expected):
    df = spark.createDataFrame([(Decimal(total), n)], "total decimal(20,2), n long")
    got = df.select(rounded_average("total", "n")).first()[0]
    assert got == (None if expected is None else Decimal(expected))


def test_the_fact_is_aggregated_before_it_is_joined(ws):
    for name in MARTS:
        plan = ws.mart(name)._jdf.queryExecution().optimizedPlan().toString()
        joins = [i for i, line in enumerate(plan.splitlines()) if "Join " in line]
        sums = [i for i, line in enumerate(plan.splitlines()) if "Aggregate [" in line]
        # Printed top down: below the lowest join there is still an aggregate of the fact.
        assert joins and max(sums) > max(joins), name


def test_a_mart_reads_the_columns_it_needs(ws):
    plan = ws.mart("mart_sales_by_store")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    fact = next(line for line in scans if "sale_total_price" in line)
    assert "supplier_id" not in fact and "product_id" not in fact
