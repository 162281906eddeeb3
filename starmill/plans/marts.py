"""Six marts over the star.

Each mart first aggregates the fact by foreign key and joins the dimension to
the result. A dimension has one row per key, so this groups exactly as joining
first would, but the fact is never joined: what shuffles is one row per key and
task, and a key with a third of all sales is summed up where it is read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions.money import rounded_average, to_cents
from starmill.schemas import MART_ORDER, conform, mart_schema

Tables = Mapping[str, DataFrame]


def _sales_by(fact: DataFrame, *keys: str, more: tuple[Column, ...] = ()) -> DataFrame:
    """Sales per foreign key. ``priced`` counts the amounts an average runs over."""
    return fact.groupBy(*keys).agg(
        F.count("sale_id").alias("orders"),
        F.sum("sale_quantity").alias("quantity_sold"),
        F.sum("sale_total_price").alias("amount"),
        F.count("sale_total_price").alias("priced"),
        *more,
    )


def sales_by_product(tables: Tables) -> DataFrame:
    sold = _sales_by(tables["fact_sales"], "product_id")
    return tables["dim_product"].join(sold, "product_id").select(
        "product_id", "name", "category", "brand", "rating", "reviews",
        F.col("quantity_sold").alias("total_quantity"),
        to_cents("amount").alias("total_revenue"),
        F.col("orders").alias("orders_count"),
    )


def sales_by_customer(tables: Tables) -> DataFrame:
    sold = _sales_by(tables["fact_sales"], "customer_id")
    return tables["dim_customer"].join(sold, "customer_id").select(
        "customer_id", "first_name", "last_name", "country",
        F.col("orders").alias("orders_count"),
        to_cents("amount").alias("total_spent"),
        rounded_average("amount", "priced").alias("avg_order_value"),
    )


def sales_by_time(tables: Tables) -> DataFrame:
    sold = _sales_by(tables["fact_sales"], "date_id")
    months = tables["dim_date"].join(sold, "date_id").groupBy("year", "month").agg(
        *[F.sum(c).alias(c) for c in ("orders", "quantity_sold", "amount", "priced")]
    )
    return months.select(
        "year", "month",
        F.col("orders").alias("orders_count"),
        to_cents("amount").alias("total_revenue"),
        F.col("quantity_sold").alias("total_quantity"),
        rounded_average("amount", "priced").alias("avg_order_value"),
    )


def sales_by_store(tables: Tables) -> DataFrame:
    sold = _sales_by(tables["fact_sales"], "store_id")
    return tables["dim_store"].join(sold, "store_id").select(
        "store_id", "name", "city", "country",
        F.col("orders").alias("orders_count"),
        to_cents("amount").alias("total_revenue"),
        rounded_average("amount", "priced").alias("avg_order_value"),
    )


def sales_by_supplier(tables: Tables) -> DataFrame:
    """``avg_product_price`` runs over sales, not over distinct products."""
    sold = _sales_by(tables["fact_sales"], "supplier_id", "product_id")
    price = F.col("price")
    by_supplier = (
        sold.join(tables["dim_product"].select("product_id", "price"), "product_id")
        .groupBy("supplier_id")
        .agg(
            F.sum("amount").alias("amount"),
            F.sum(price * F.col("orders")).alias("prices"),
            F.sum(F.when(price.isNotNull(), F.col("orders"))).alias("prices_counted"),
            F.sum("orders").alias("orders"),
        )
    )
    return tables["dim_supplier"].join(by_supplier, "supplier_id").select(
        "supplier_id",
        F.col("name").alias("supplier_name"),
        F.col("country").alias("supplier_country"),
        to_cents("amount").alias("total_revenue"),
        rounded_average("prices", "prices_counted").alias("avg_product_price"),
        F.col("orders").alias("orders_count"),
    )


def product_quality(tables: Tables) -> DataFrame:
    """Every product, sold or not. Sums of an unsold one are NULL, counts 0."""
    sold = _sales_by(
        tables["fact_sales"], "product_id",
        more=(F.count_distinct("customer_id").alias("customers"),),
    )
    return tables["dim_product"].join(sold, "product_id", "left").select(
        "product_id", "name", "category", "rating", "reviews",
        F.col("quantity_sold").alias("total_quantity"),
        to_cents("amount").alias("total_revenue"),
        F.coalesce("orders", F.lit(0)).alias("orders_count"),
        F.coalesce("customers", F.lit(0)).alias("unique_customers"),
    )


MARTS: dict[str, Callable[[Tables], DataFrame]] = {
    "mart_sales_by_product": sales_by_product,
    "mart_sales_by_customer": sales_by_customer,
    "mart_sales_by_time": sales_by_time,
    "mart_sales_by_store": sales_by_store,
    "mart_sales_by_supplier": sales_by_supplier,
    "mart_product_quality": product_quality,
}

# The tables the marts read.
MART_SOURCES = (
    "fact_sales", "dim_customer", "dim_product", "dim_date", "dim_store", "dim_supplier"
)


def build_mart(name: str, tables: Tables) -> DataFrame:
    mart = conform(MARTS[name](tables), mart_schema(name))
    # Only the monthly mart is ordered; at most a few thousand rows.
    return mart.orderBy(*MART_ORDER[name]) if name == "mart_sales_by_time" else mart
