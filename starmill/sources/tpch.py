"""Staging rows made from order tables, one per order line.

The sales files of the domain are not public, so tests, benchmarks and checks
derive rows of the staging schema from customer, orders, lineitem, part,
supplier and nation. Each expression below reads the same in Spark SQL and in
other SQL dialects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.dense_key import with_dense_key
from starmill.operators.lookup import SPREAD_FROM_ROWS, Lookup, join_all
from starmill.schemas import STAGING_TABLE, conform, staging_schema
from starmill.sources.stage import stage

# Lines are numbered in this order. Lines that tie on all of it are copies.
LINE_ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_quantity",
)
LINE_COPY = "l_copy"

# The staging columns after id, over the joined order tables.
STAGING_EXPRESSIONS = {
    "customer_first_name": "split_part(c_name,'#',1)",
    "customer_last_name": "split_part(c_name,'#',2)",
    "customer_age": "CAST(18 + o_custkey % 60 AS INT)",
    "customer_email": "concat('c',CAST(o_custkey AS STRING),'@example.com')",
    "customer_country": "c_nation",
    "customer_postal_code": "lpad(CAST(o_custkey AS STRING),5,'0')",
    "customer_pet_type": "c_mktsegment",
    "customer_pet_name": "concat('pet',CAST(o_custkey % 7 AS STRING))",
    "customer_pet_breed":
        "CASE WHEN o_custkey % 10 = 0 AND o_orderpriority = '1-URGENT' THEN 'rush' ELSE 'std' END",
    "seller_first_name": "'Seller'",
    "seller_last_name": "CAST(l_orderkey % 50 AS STRING)",
    "seller_email": "concat('s',CAST(l_orderkey % 50 AS STRING),'@example.com')",
    "seller_country": "concat('NATION_',CAST(l_orderkey % 25 AS STRING))",
    "seller_postal_code": "lpad(CAST(l_orderkey % 50 AS STRING),5,'0')",
    "product_name": "p_name",
    "product_category": "p_type",
    "product_price": "CAST(p_retailprice AS DECIMAL(10,2))",
    "product_quantity": "p_size",
    "sale_date":
        "CASE WHEN l_tax = 0.08 AND l_linenumber = 6 THEN 'n/a' ELSE "
        "concat(CAST(month(o_orderdate) AS STRING),'/',CAST(day(o_orderdate) AS STRING),'/',"
        "CAST(year(o_orderdate) AS STRING)) END",
    "sale_customer_id": "CAST(o_custkey AS INT)",
    "sale_seller_id": "CAST(l_orderkey % 50 AS INT)",
    "sale_product_id": "CAST(l_partkey AS INT)",
    "sale_quantity": "CAST(l_quantity AS INT)",
    "sale_total_price": "CAST(l_extendedprice AS DECIMAL(10,2))",
    "store_name": "concat('Store ',CAST(l_suppkey % 20 AS STRING))",
    "store_location": "concat('Aisle ',CAST(l_linenumber AS STRING))",
    "store_city": "concat('City ',CAST(l_suppkey % 20 AS STRING))",
    "store_state": "concat('State ',CAST(l_suppkey % 5 AS STRING))",
    "store_country": "concat('NATION_',CAST(l_suppkey % 20 AS STRING))",
    "store_phone": "concat('555-',CAST(l_linenumber AS STRING))",
    "store_email": "concat('store',CAST(l_suppkey % 20 AS STRING),'@example.com')",
    "pet_category":
        "CASE WHEN (l_returnflag = 'A' AND l_linenumber = 7) "
        "OR (p_type = 'ECONOMY' AND p_name LIKE 'blue %') THEN NULL "
        "ELSE concat('cat ',l_returnflag) END",
    "product_weight": "CAST(p_size * 0.1 AS DECIMAL(10,2))",
    "product_color": "split_part(p_name,' ',1)",
    "product_size": "CAST(p_size AS STRING)",
    "product_brand": "p_brand",
    "product_material": "split_part(p_name,' ',2)",
    "product_description": "concat(p_name,', ',p_type)",
    "product_rating": "CAST(1 + (l_partkey % 41) * 0.1 AS DECIMAL(3,1))",
    "product_reviews": "CAST(l_partkey % 1000 AS INT)",
    "product_release_date": "concat('1/',CAST(1 + l_partkey % 28 AS STRING),'/2015')",
    "product_expiry_date": "concat('6/',CAST(1 + l_partkey % 28 AS STRING),'/2030')",
    "supplier_name": "s_name",
    "supplier_contact": "concat('contact ',s_name)",
    "supplier_email": "concat('sup',CAST(l_suppkey AS STRING),'@example.com')",
    "supplier_phone": "concat('556-',CAST(l_suppkey AS STRING))",
    "supplier_address": "concat(CAST(l_suppkey AS STRING),' Main St')",
    "supplier_city": "concat('City ',CAST(s_nationkey AS STRING))",
    "supplier_country": "s_nation",
}


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines joined with what the staging columns need, and no more.

    Orders meet their customers before the lines, while they are few.
    """

    def table(name: str, key: str, *columns: str) -> DataFrame:
        rows = spark.read.parquet(f"{folder}/{name}.parquet")
        # Keys take the name they have where they are looked up.
        own = {"l_partkey": "p_partkey", "l_suppkey": "s_suppkey", "l_orderkey": "o_orderkey",
               "o_custkey": "c_custkey"}[key]
        return rows.select(F.col(own).alias(key), *columns)

    def nation(side: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/nation.parquet").select(
            F.col("n_nationkey").alias(f"{side}_nationkey"), F.col("n_name").alias(f"{side}_nation")
        )

    customers = table("customer", "o_custkey", "c_name", "c_mktsegment", "c_nationkey").join(
        nation("c"), "c_nationkey"
    ).drop("c_nationkey")
    orders = join_all(
        table("orders", "l_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"),
        {"customer": Lookup(customers, ("o_custkey",))}, row_id="l_orderkey", keep_keys=True,
    )
    # The number of a line, fixed by the files, tells copies apart.
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        *LINE_ORDER, F.monotonically_increasing_id().alias(LINE_COPY)
    )
    if lines.count() < SPREAD_FROM_ROWS:
        # A short table often is one row group, which one task would read and join alone.
        lines = lines.repartition(LINE_COPY)
    part = table("part", "l_partkey", "p_name", "p_type", "p_brand", "p_size", "p_retailprice")
    supplier = table("supplier", "l_suppkey", "s_name", "s_nationkey").join(
        nation("s"), "s_nationkey"
    )
    lookups = {
        "part": Lookup(part, ("l_partkey",)),
        "supplier": Lookup(supplier, ("l_suppkey",)),
        "orders": Lookup(stage(orders, "orders")[0], ("l_orderkey",)),
    }
    return join_all(lines, lookups, row_id=LINE_COPY, keep_keys=True)


def staging_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The staging table over ``{folder}/*.parquet``.

    The narrow order lines are numbered and stored; the fifty columns are
    expressions on top, so a reader computes only those it selects.
    """
    lines = with_dense_key(
        order_lines(spark, folder), "id", (*LINE_ORDER, LINE_COPY), STAGING_TABLE
    )
    columns = [f"{sql} AS {name}" for name, sql in STAGING_EXPRESSIONS.items()]
    return conform(lines.selectExpr("id", *columns), staging_schema())
