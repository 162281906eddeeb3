"""The same results in plain SQL, for DuckDB over the order tables.

Written apart from the Spark plans; only the definition of the staging rows is
shared. Averages are taken over integer cents, rounded half-up.
"""

from __future__ import annotations

from starmill.sources.tpch import LINE_ORDER, STAGING_EXPRESSIONS

# Length limits of the staging text columns.
_TEXT_LIMITS = {
    "customer_first_name": 100, "customer_last_name": 100, "customer_email": 100,
    "customer_country": 100, "customer_postal_code": 20, "customer_pet_type": 50,
    "customer_pet_name": 100, "customer_pet_breed": 100, "seller_first_name": 100,
    "seller_last_name": 100, "seller_email": 100, "seller_country": 100, "seller_postal_code":
    20, "product_name": 100, "product_category": 100, "sale_date": 20, "store_name": 100,
    "store_location": 100, "store_city": 100, "store_state": 100, "store_country": 100,
    "store_phone": 50, "store_email": 100, "pet_category": 100, "product_color": 50,
    "product_size": 50, "product_brand": 100, "product_material": 100, "product_release_date":
    20, "product_expiry_date": 20, "supplier_name": 100, "supplier_contact": 100,
    "supplier_email": 100, "supplier_phone": 50, "supplier_address": 100, "supplier_city": 100,
    "supplier_country": 100,
}

_LINES = """
SELECT l.*, o.o_custkey, o.o_orderdate, o.o_orderpriority,
       c.c_name, c.c_mktsegment, cn.n_name AS c_nation,
       p.p_name, p.p_type, p.p_brand, p.p_size, p.p_retailprice,
       s.s_name, s.s_nationkey, sn.n_name AS s_nation
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation sn ON s.s_nationkey = sn.n_nationkey
"""

_MOCK_DATA = (
    "SELECT row_number() OVER (ORDER BY "
    + ", ".join(f"{c} NULLS FIRST" for c in LINE_ORDER)
    + ") AS id, "
    + ", ".join(f"{sql} AS {name}" for name, sql in STAGING_EXPRESSIONS.items())
    + " FROM order_lines"
)

_DAY = "CAST(try_strptime({0}, '%m/%d/%Y') AS DATE)"

_CTES = {
    "order_lines": _LINES,
    "mock_data": _MOCK_DATA,
    "dim_customer": """
        SELECT row_number() OVER (ORDER BY first_name NULLS FIRST, last_name NULLS FIRST,
                 age NULLS FIRST, email NULLS FIRST, country NULLS FIRST,
                 postal_code NULLS FIRST, pet_type NULLS FIRST, pet_name NULLS FIRST,
                 pet_breed NULLS FIRST) AS customer_id, *
        FROM (SELECT DISTINCT customer_first_name AS first_name, customer_last_name AS last_name,
                customer_age AS age, customer_email AS email, customer_country AS country,
                customer_postal_code AS postal_code, customer_pet_type AS pet_type,
                customer_pet_name AS pet_name, customer_pet_breed AS pet_breed FROM mock_data)""",
    "dim_seller": """
        SELECT row_number() OVER (ORDER BY first_name NULLS FIRST, last_name NULLS FIRST,
                 email NULLS FIRST, country NULLS FIRST, postal_code NULLS FIRST) AS seller_id, *
        FROM (SELECT DISTINCT seller_first_name AS first_name, seller_last_name AS last_name,
                seller_email AS email, seller_country AS country,
                seller_postal_code AS postal_code FROM mock_data)""",
    "dim_product": """
        SELECT row_number() OVER (ORDER BY name NULLS FIRST, category NULLS FIRST) AS product_id, *
        FROM (SELECT product_name AS name, product_category AS category, product_price AS price,
                product_quantity AS quantity, product_weight AS weight, product_color AS color,
                product_size AS size, product_brand AS brand, product_material AS material,
                product_description AS description, product_rating AS rating,
                product_reviews AS reviews, product_release_date AS release_date,
                product_expiry_date AS expiry_date FROM mock_data
              QUALIFY row_number() OVER (PARTITION BY product_name, product_category
                                         ORDER BY id) = 1)""",
    "dim_store": """
        SELECT row_number() OVER (ORDER BY name NULLS FIRST, email NULLS FIRST) AS store_id, *
        FROM (SELECT store_name AS name, store_location AS location, store_city AS city,
                store_state AS state, store_country AS country, store_phone AS phone,
                store_email AS email FROM mock_data
              QUALIFY row_number() OVER (PARTITION BY store_name, store_email ORDER BY id) = 1)""",
    "dim_supplier": """
        SELECT row_number() OVER (ORDER BY name NULLS FIRST, email NULLS FIRST) AS supplier_id, *
        FROM (SELECT supplier_name AS name, supplier_contact AS contact, supplier_email AS email,
                supplier_phone AS phone, supplier_address AS address, supplier_city AS city,
                supplier_country AS country FROM mock_data
              QUALIFY row_number() OVER (PARTITION BY supplier_name, supplier_email
                                         ORDER BY id) = 1)""",
    "dim_pet_category": """
        SELECT row_number() OVER (ORDER BY category) AS pet_category_id, category
        FROM (SELECT DISTINCT pet_category AS category FROM mock_data
              WHERE pet_category IS NOT NULL)""",
    "dim_date": f"""
        SELECT row_number() OVER (ORDER BY sale_date) AS date_id, sale_date,
               CAST(day(sale_date) AS INT) AS day, CAST(month(sale_date) AS INT) AS month,
               CAST(year(sale_date) AS INT) AS year
        FROM (SELECT DISTINCT {_DAY.format("sale_date")} AS sale_date FROM mock_data)
        WHERE sale_date IS NOT NULL""",
    "fact_sales": f"""
        SELECT row_number() OVER (ORDER BY m.id, c.customer_id, e.seller_id) AS sale_id,
               c.customer_id, e.seller_id, p.product_id, t.store_id, u.supplier_id,
               g.pet_category_id, d.date_id, m.sale_quantity, m.sale_total_price
        FROM mock_data m
        JOIN dim_customer c ON m.customer_first_name = c.first_name
          AND m.customer_last_name = c.last_name AND m.customer_email = c.email
        JOIN dim_seller e ON m.seller_first_name = e.first_name
          AND m.seller_last_name = e.last_name AND m.seller_email = e.email
        JOIN dim_product p ON m.product_name = p.name AND m.product_category = p.category
        JOIN dim_store t ON m.store_name = t.name AND m.store_email = t.email
        JOIN dim_supplier u ON m.supplier_name = u.name AND m.supplier_email = u.email
        JOIN dim_pet_category g ON m.pet_category = g.category
        JOIN dim_date d ON {_DAY.format("m.sale_date")} = d.sale_date""",
}

_STAR = [
    ("dim_customer", "customer_id"),
    ("dim_seller", "seller_id"),
    ("dim_product", "product_id"),
    ("dim_store", "store_id"),
    ("dim_supplier", "supplier_id"),
    ("dim_pet_category", "pet_category_id"),
    ("dim_date", "date_id"),
]

# Which CTEs a CTE reads.
_NEEDS = {
    "order_lines": [],
    "mock_data": ["order_lines"],
    **{dim: ["mock_data"] for dim, _ in _STAR},
    "fact_sales": ["mock_data"] + [dim for dim, _ in _STAR],
}


def _with(sql: str, *tables: str) -> str:
    wanted: set[str] = set()

    def add(table: str) -> None:
        for needed in _NEEDS[table]:
            add(needed)
        wanted.add(table)

    for table in tables:
        add(table)
    ctes = ", ".join(f"{t} AS MATERIALIZED ({_CTES[t]})" for t in _CTES if t in wanted)
    return f"WITH {ctes} {sql}"


def _average(amount: str) -> str:
    cents = f"CAST(sum(CAST({amount} * 100 AS BIGINT)) AS HUGEINT)"
    return f"CAST((2 * {cents} + count({amount})) // (2 * count({amount})) AS DOUBLE) / 100.0"


_ORDERS = "count(sale_id) AS orders_count"
_QUANTITY = "CAST(sum(sale_quantity) AS BIGINT) AS total_quantity"
_REVENUE = "CAST(sum(sale_total_price) AS DOUBLE) AS total_revenue"
_ORDER_VALUE = f"{_average('sale_total_price')} AS avg_order_value"

_MOCK_AS_DOUBLE = (
    "SELECT * REPLACE (CAST(product_price AS DOUBLE) AS product_price, "
    "CAST(sale_total_price AS DOUBLE) AS sale_total_price, "
    "CAST(product_weight AS DOUBLE) AS product_weight, "
    "CAST(product_rating AS DOUBLE) AS product_rating) FROM mock_data"
)
_PRODUCT_AS_DOUBLE = (
    "* REPLACE (CAST(price AS DOUBLE) AS price, CAST(weight AS DOUBLE) AS weight, "
    "CAST(rating AS DOUBLE) AS rating)"
)
_FACT_AS_DOUBLE = (
    "SELECT * REPLACE (CAST(sale_total_price AS DOUBLE) AS sale_total_price) FROM fact_sales"
)
_BY_PRODUCT = f"""
    SELECT product_id, name, category, brand, CAST(rating AS DOUBLE) AS rating,
           CAST(reviews AS BIGINT) AS reviews, {_QUANTITY}, {_REVENUE}, {_ORDERS}
    FROM fact_sales JOIN dim_product USING (product_id)
    GROUP BY product_id, name, category, brand, rating, reviews"""
_BY_CUSTOMER = f"""
    SELECT customer_id, first_name, last_name, country, {_ORDERS},
           CAST(sum(sale_total_price) AS DOUBLE) AS total_spent, {_ORDER_VALUE}
    FROM fact_sales JOIN dim_customer USING (customer_id)
    GROUP BY customer_id, first_name, last_name, country"""
_BY_TIME = f"""
    SELECT year, month, {_ORDERS}, {_REVENUE}, {_QUANTITY}, {_ORDER_VALUE}
    FROM fact_sales JOIN dim_date USING (date_id)
    GROUP BY year, month ORDER BY year, month"""
_BY_STORE = f"""
    SELECT store_id, name, city, country, {_ORDERS}, {_REVENUE}, {_ORDER_VALUE}
    FROM fact_sales JOIN dim_store USING (store_id)
    GROUP BY store_id, name, city, country"""
_BY_SUPPLIER = f"""
    SELECT supplier_id, u.name AS supplier_name, u.country AS supplier_country, {_REVENUE},
           {_average('p.price')} AS avg_product_price, {_ORDERS}
    FROM fact_sales JOIN dim_supplier u USING (supplier_id) JOIN dim_product p USING (product_id)
    GROUP BY supplier_id, u.name, u.country"""
_QUALITY = f"""
    SELECT product_id, name, category, CAST(rating AS DOUBLE) AS rating,
           CAST(reviews AS BIGINT) AS reviews, {_QUANTITY}, {_REVENUE}, {_ORDERS},
           count(DISTINCT customer_id) AS unique_customers
    FROM dim_product LEFT JOIN fact_sales USING (product_id)
    GROUP BY product_id, name, category, rating, reviews"""


def _raw(key: str, columns: str, where: str = "") -> str:
    return f"SELECT row_number() OVER (ORDER BY id) AS {key}, {columns} FROM mock_data {where}"


_RAW = {
    "raw_dim_customer": _raw(
        "customer_id",
        "customer_first_name AS first_name, customer_last_name AS last_name, "
        "customer_age AS age, customer_email AS email, customer_country AS country, "
        "customer_postal_code AS postal_code, customer_pet_type AS pet_type, "
        "customer_pet_name AS pet_name, customer_pet_breed AS pet_breed"),
    "raw_dim_seller": _raw(
        "seller_id",
        "seller_first_name AS first_name, seller_last_name AS last_name, seller_email AS email, "
        "seller_country AS country, seller_postal_code AS postal_code"),
    "raw_dim_product": _raw(
        "product_id",
        "product_name AS name, product_category AS category, "
        "CAST(product_price AS DOUBLE) AS price, product_quantity AS quantity, "
        "CAST(product_weight AS DOUBLE) AS weight, product_color AS color, product_size AS size, "
        "product_brand AS brand, product_material AS material, "
        "product_description AS description, CAST(product_rating AS DOUBLE) AS rating, "
        "product_reviews AS reviews, product_release_date AS release_date, "
        "product_expiry_date AS expiry_date"),
    "raw_dim_store": _raw(
        "store_id",
        "store_name AS name, store_location AS location, store_city AS city, "
        "store_state AS state, store_country AS country, store_phone AS phone, "
        "store_email AS email"),
    "raw_dim_supplier": _raw(
        "supplier_id",
        "supplier_name AS name, supplier_contact AS contact, supplier_email AS email, "
        "supplier_phone AS phone, supplier_address AS address, supplier_city AS city, "
        "supplier_country AS country"),
    "raw_dim_pet_category": _raw(
        "pet_category_id", "pet_category AS category", "WHERE pet_category IS NOT NULL"),
    "raw_dim_date": _raw(
        "date_id",
        f"{_DAY.format('sale_date')} AS sale_date, "
        + ", ".join(
            f"CAST({part}({_DAY.format('sale_date')}) AS INT) AS {part}"
            for part in ("day", "month", "year")
        ),
        "WHERE sale_date IS NOT NULL"),
}


def _primary_keys() -> str:
    unique = [("mock_data", "id"), ("fact_sales", "sale_id"), *_STAR,
              ("dim_pet_category", "category")]
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS row_count, "
        f"count(*) - count({column}) AS null_rows, "
        f"(SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1)) AS repeated_values FROM {table}"
        for table, column in unique
    )


def _foreign_keys() -> str:
    return " UNION ALL ".join(
        f"SELECT '{key}' AS foreign_key, '{dim}' AS dim_table, count({key}) AS checked_rows, "
        f"count(DISTINCT {key}) FILTER ({key} NOT IN (SELECT {key} FROM {dim})) AS orphan_keys, "
        f"count({key}) FILTER ({key} NOT IN (SELECT {key} FROM {dim})) AS orphan_rows "
        "FROM fact_sales"
        for dim, key in _STAR
    )


def _varchar_limits() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {limit} AS max_length, "
        f"CAST(max(length({name})) AS INT) AS longest, "
        f"count(*) FILTER (length({name}) > {limit}) AS too_long_rows FROM mock_data"
        for name, limit in _TEXT_LIMITS.items()
    )


def _lookup_fanout() -> str:
    lookups = {
        "dim_customer": "m.customer_first_name = d.first_name "
                        "AND m.customer_last_name = d.last_name AND m.customer_email = d.email",
        "dim_seller": "m.seller_first_name = d.first_name "
                      "AND m.seller_last_name = d.last_name AND m.seller_email = d.email",
        "dim_product": "m.product_name = d.name AND m.product_category = d.category",
        "dim_store": "m.store_name = d.name AND m.store_email = d.email",
        "dim_supplier": "m.supplier_name = d.name AND m.supplier_email = d.email",
        "dim_pet_category": "m.pet_category = d.category",
        "dim_date": f"{_DAY.format('m.sale_date')} = d.sale_date",
    }
    return " UNION ALL ".join(
        f"SELECT '{dim}' AS dim_table, count(*) FILTER (hits > 0) AS matched_sales, "
        "count(*) FILTER (hits = 0) AS unmatched_sales, CAST(sum(hits) AS BIGINT) AS output_rows, "
        "max(hits) AS max_rows_per_sale "
        f"FROM (SELECT m.id, count(d.{key}) AS hits FROM mock_data m LEFT JOIN {dim} d "
        f"ON {lookups[dim]} GROUP BY m.id)"
        for dim, key in _STAR
    )


# Digits of the staging number columns, in all and behind the point.
_NUMBER_LIMITS = {
    "id": (18, 0), "customer_age": (9, 0), "product_price": (10, 2), "product_quantity": (9, 0),
    "sale_customer_id": (9, 0), "sale_seller_id": (9, 0), "sale_product_id": (9, 0),
    "sale_quantity": (9, 0), "sale_total_price": (10, 2), "product_weight": (10, 2),
    "product_rating": (3, 1), "product_reviews": (9, 0),
}

# What is planted in three of them.
_PLANTED = (
    "SELECT CAST(id AS VARCHAR) AS id, CAST(customer_age AS VARCHAR) AS customer_age, "
    "CASE WHEN id % 97 = 0 THEN 'n/a' WHEN id % 89 = 0 THEN '123456789012.5' "
    "WHEN id % 83 = 0 THEN product_price::VARCHAR || '75' ELSE product_price::VARCHAR END AS product_price, "
    "CAST(product_quantity AS VARCHAR) AS product_quantity, CAST(sale_customer_id AS VARCHAR) AS sale_customer_id, "
    "CAST(sale_seller_id AS VARCHAR) AS sale_seller_id, CAST(sale_product_id AS VARCHAR) AS sale_product_id, "
    "CASE WHEN id % 101 = 0 THEN '9999999999' WHEN id % 103 = 0 THEN sale_quantity::VARCHAR || '.5' "
    "ELSE sale_quantity::VARCHAR END AS sale_quantity, CAST(sale_total_price AS VARCHAR) AS sale_total_price, "
    "CAST(product_weight AS VARCHAR) AS product_weight, "
    "CASE WHEN id % 107 = 0 THEN '99.96' WHEN id % 109 = 0 THEN '-0100.0' ELSE product_rating::VARCHAR END "
    "AS product_rating, CAST(product_reviews AS VARCHAR) AS product_reviews FROM mock_data"
)


def _precision() -> str:
    """By arithmetic: a value is too large if, rounded, it has more digits than the type."""
    parts = []
    for name, (digits, scale) in _NUMBER_LIMITS.items():
        value = f"try_cast({name} AS DECIMAL(38,10))"
        rules = {
            "not_a_number": f"{value} IS NULL",
            "too_large": f"abs(round({value}, {scale})) >= power(10, {digits - scale})",
            "fraction": f"round({value}, {scale}) <> {value}",
        }
        parts += [
            f"SELECT '{name}' AS column_name, {digits} AS max_digits, {scale} AS max_scale, '{rule}' AS rule, "
            f"count(*) FILTER ({name} IS NOT NULL AND {broken}) AS broken_rows, "
            f"max({name}) FILTER ({name} IS NOT NULL AND {broken}) AS example FROM planted"
            for rule, broken in rules.items()
        ]
    return f"SELECT * FROM (WITH planted AS ({_PLANTED}) {' UNION ALL '.join(parts)})"


def _rejects() -> str:
    price = "try_cast(product_price AS DECIMAL(10,2))"
    rating = "try_cast(product_rating AS DECIMAL(3,1))"
    quantity = "CASE WHEN sale_quantity NOT LIKE '%.%' THEN try_cast(sale_quantity AS INT) END"
    return (
        f"SELECT * FROM (WITH planted AS ({_PLANTED}) SELECT CAST(id AS BIGINT) AS id, CAST({price} AS DOUBLE) AS product_price, "
        f"{quantity} AS sale_quantity, CAST({rating} AS DOUBLE) AS product_rating, id AS record_begins FROM planted "
        f"WHERE {price} IS NULL OR {rating} IS NULL OR {quantity} IS NULL)"
    )


def _multiplied() -> str:
    """Every sale with the rows of each repeated dimension that it meets."""
    day = _DAY.format("sale_date")
    keys = {
        "c": ("customer_first_name", "customer_last_name", "customer_email"),
        "e": ("seller_first_name", "seller_last_name", "seller_email"),
        "p": ("product_name", "product_category"), "t": ("store_name", "store_email"),
        "u": ("supplier_name", "supplier_email"), "g": ("pet_category",), "d": ("day",),
    }
    joins = " ".join(
        f"JOIN (SELECT {', '.join(on)}, count(*) AS n FROM sales GROUP BY ALL) {a} USING ({', '.join(on)})"
        for a, on in keys.items()
    )
    copies = " * ".join(f"CAST({a}.n AS HUGEINT)" for a in keys)
    return (
        f"SELECT * FROM (WITH sales AS (SELECT *, {day} AS day FROM mock_data), "
        f"multiplied AS (SELECT day, sale_quantity, CAST(sale_total_price * 100 AS BIGINT) AS cents, {copies} AS n FROM sales {joins}) "
        "SELECT CAST(year(day) AS INT) AS year, CAST(month(day) AS INT) AS month, CAST(sum(n) AS VARCHAR) AS fact_rows, "
        "CAST(sum(n * sale_quantity) AS VARCHAR) AS total_quantity, "
        "CAST(sum(n * cents) // 100 AS VARCHAR) || '.' || lpad(CAST(sum(n * cents) % 100 AS VARCHAR), 2, '0') AS total_revenue "
        "FROM multiplied GROUP BY 1, 2)"
    )


def _sales_in_full() -> str:
    """The fact of one load, with the columns of its dimensions in place of keys."""
    prefix = {"dim_customer": "customer_", "dim_seller": "seller_", "dim_product": "product_", "dim_store": "store_",
              "dim_supplier": "supplier_", "dim_pet_category": "pet_", "dim_date": ""}
    columns = {
        "dim_customer": "first_name last_name age email country postal_code pet_type pet_name pet_breed",
        "dim_seller": "first_name last_name email country postal_code",
        "dim_product": "name category price quantity weight color size brand material rating reviews "
                       "release_date expiry_date",
        "dim_store": "name location city state country phone email",
        "dim_supplier": "name contact email phone address city country",
        "dim_pet_category": "category", "dim_date": "sale_date",
    }
    doubles = {"price", "weight", "rating"}
    shown = [
        (f"CAST({dim}.{c} AS DOUBLE)" if c in doubles else f"{dim}.{c}") + f" AS {prefix[dim]}{c}"
        for dim, _ in _STAR for c in columns[dim].split()
    ]
    joins = " ".join(f"JOIN {dim} USING ({key})" for dim, key in _STAR)
    return (f"SELECT sale_quantity, CAST(sale_total_price AS DOUBLE) AS sale_total_price, {', '.join(shown)} "
            f"FROM fact_sales {joins}")


def _row_counts() -> str:
    tables = ["mock_data", *[dim for dim, _ in _STAR], "fact_sales"]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in tables
    )


def statements() -> dict[str, str]:
    """One statement per query, under the name of the query."""
    dims = [dim for dim, _ in _STAR]
    star = {dim: _with(f"SELECT * FROM {dim}", dim) for dim in dims}
    star["dim_product"] = _with(f"SELECT {_PRODUCT_AS_DOUBLE} FROM dim_product", "dim_product")
    return {
        "ods_mock_data": _with(_MOCK_AS_DOUBLE, "mock_data"),
        "csv_roundtrip": _with(_MOCK_AS_DOUBLE, "mock_data"),
        **star,
        "fact_sales": _with(_FACT_AS_DOUBLE, "fact_sales"),
        "fact_sales_sql": _with(_FACT_AS_DOUBLE, "fact_sales"),
        "mart_sales_by_product": _with(_BY_PRODUCT, "fact_sales"),
        "mart_sales_by_customer": _with(_BY_CUSTOMER, "fact_sales"),
        "mart_sales_by_time": _with(_BY_TIME, "fact_sales"),
        "mart_sales_by_store": _with(_BY_STORE, "fact_sales"),
        "mart_sales_by_supplier": _with(_BY_SUPPLIER, "fact_sales"),
        "mart_product_quality": _with(_QUALITY, "fact_sales"),
        "mart_sorted_layout": _with(_BY_CUSTOMER, "fact_sales"),
        **{name: _with(sql, "mock_data") for name, sql in _RAW.items()},
        "preview_mock_data": _with(f"{_MOCK_AS_DOUBLE} ORDER BY id LIMIT 5", "mock_data"),
        "preview_fact_sales": _with(f"{_FACT_AS_DOUBLE} ORDER BY sale_id LIMIT 5", "fact_sales"),
        "preview_dim_customer": _with(
            "SELECT * FROM dim_customer ORDER BY customer_id LIMIT 5", "dim_customer"),
        "preview_mart_by_product": _with(
            f"{_BY_PRODUCT} ORDER BY product_id LIMIT 10", "fact_sales"),
        "audit_primary_keys": _with(_primary_keys(), "fact_sales"),
        "audit_foreign_keys": _with(_foreign_keys(), "fact_sales"),
        "audit_varchar_limits": _with(_varchar_limits(), "mock_data"),
        "audit_precision": _with(_precision(), "mock_data"),
        "csv_rejects": _with(_rejects(), "mock_data"),
        "star_appended": _with(_sales_in_full(), "fact_sales"),
        "fact_sales_multiplied": _with(_multiplied(), "mock_data"),
        "audit_lookup_fanout": _with(_lookup_fanout(), "mock_data", *dims),
        "audit_row_counts": _with(_row_counts(), "fact_sales"),
    }
