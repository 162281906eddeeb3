"""Tables of the three layers: staging, star, marts.

Every table is described once, here. Readers take their schema from these
lists and writers cast to it, so no column type is ever inferred.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

STAGING_TABLE = "mock_data"

# Names, order, types and text limits of the staging table.
STAGING_COLUMNS = [
    ("id", "bigint"),
    ("customer_first_name", "varchar(100)"),
    ("customer_last_name", "varchar(100)"),
    ("customer_age", "int"),
    ("customer_email", "varchar(100)"),
    ("customer_country", "varchar(100)"),
    ("customer_postal_code", "varchar(20)"),
    ("customer_pet_type", "varchar(50)"),
    ("customer_pet_name", "varchar(100)"),
    ("customer_pet_breed", "varchar(100)"),
    ("seller_first_name", "varchar(100)"),
    ("seller_last_name", "varchar(100)"),
    ("seller_email", "varchar(100)"),
    ("seller_country", "varchar(100)"),
    ("seller_postal_code", "varchar(20)"),
    ("product_name", "varchar(100)"),
    ("product_category", "varchar(100)"),
    ("product_price", "decimal(10,2)"),
    ("product_quantity", "int"),
    ("sale_date", "varchar(20)"),
    ("sale_customer_id", "int"),
    ("sale_seller_id", "int"),
    ("sale_product_id", "int"),
    ("sale_quantity", "int"),
    ("sale_total_price", "decimal(10,2)"),
    ("store_name", "varchar(100)"),
    ("store_location", "varchar(100)"),
    ("store_city", "varchar(100)"),
    ("store_state", "varchar(100)"),
    ("store_country", "varchar(100)"),
    ("store_phone", "varchar(50)"),
    ("store_email", "varchar(100)"),
    ("pet_category", "varchar(100)"),
    ("product_weight", "decimal(10,2)"),
    ("product_color", "varchar(50)"),
    ("product_size", "varchar(50)"),
    ("product_brand", "varchar(100)"),
    ("product_material", "varchar(100)"),
    ("product_description", "text"),
    ("product_rating", "decimal(3,1)"),
    ("product_reviews", "int"),
    ("product_release_date", "varchar(20)"),
    ("product_expiry_date", "varchar(20)"),
    ("supplier_name", "varchar(100)"),
    ("supplier_contact", "varchar(100)"),
    ("supplier_email", "varchar(100)"),
    ("supplier_phone", "varchar(50)"),
    ("supplier_address", "varchar(100)"),
    ("supplier_city", "varchar(100)"),
    ("supplier_country", "varchar(100)"),
]

# Columns of the marts, with the types they are stored in.
MART_COLUMNS = {
    "mart_sales_by_product": [
        ("product_id", "bigint"),
        ("name", "string"),
        ("category", "string"),
        ("brand", "string"),
        ("rating", "double"),
        ("reviews", "bigint"),
        ("total_quantity", "bigint"),
        ("total_revenue", "double"),
        ("orders_count", "bigint"),
    ],
    "mart_sales_by_customer": [
        ("customer_id", "bigint"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("country", "string"),
        ("orders_count", "bigint"),
        ("total_spent", "double"),
        ("avg_order_value", "double"),
    ],
    "mart_sales_by_time": [
        ("year", "int"),
        ("month", "int"),
        ("orders_count", "bigint"),
        ("total_revenue", "double"),
        ("total_quantity", "bigint"),
        ("avg_order_value", "double"),
    ],
    "mart_sales_by_store": [
        ("store_id", "bigint"),
        ("name", "string"),
        ("city", "string"),
        ("country", "string"),
        ("orders_count", "bigint"),
        ("total_revenue", "double"),
        ("avg_order_value", "double"),
    ],
    "mart_sales_by_supplier": [
        ("supplier_id", "bigint"),
        ("supplier_name", "string"),
        ("supplier_country", "string"),
        ("total_revenue", "double"),
        ("avg_product_price", "double"),
        ("orders_count", "bigint"),
    ],
    "mart_product_quality": [
        ("product_id", "bigint"),
        ("name", "string"),
        ("category", "string"),
        ("rating", "double"),
        ("reviews", "bigint"),
        ("total_quantity", "bigint"),
        ("total_revenue", "double"),
        ("orders_count", "bigint"),
        ("unique_customers", "bigint"),
    ],
}

# The columns each mart is stored sorted by.
MART_ORDER = {
    "mart_sales_by_product": ["product_id"],
    "mart_sales_by_customer": ["customer_id"],
    "mart_sales_by_time": ["year", "month"],
    "mart_sales_by_store": ["store_id"],
    "mart_sales_by_supplier": ["supplier_id"],
    "mart_product_quality": ["product_id"],
}


@dataclass(frozen=True)
class Dimension:
    """One dimension, cut from the staging columns that share a prefix.

    ``lookup`` is the natural key by which a sale finds its dimension row.
    With ``one_row_per_lookup`` the dimension keeps a single row per natural
    key; without it every distinct row is kept, and a sale can match several.
    """

    table: str
    prefix: str
    columns: tuple[str, ...]
    lookup: tuple[str, ...]
    one_row_per_lookup: bool

    @property
    def key(self) -> str:
        return self.table.removeprefix("dim_") + "_id"

    @property
    def order(self) -> tuple[str, ...]:
        """Columns that identify a row, in the order keys are numbered."""
        return self.lookup if self.one_row_per_lookup else self.columns

    def source(self, column: str) -> str:
        return self.prefix + column


# Columns and natural keys of the dimensions cut by prefix.
CUSTOMER = Dimension(
    "dim_customer",
    "customer_",
    ("first_name", "last_name", "age", "email", "country", "postal_code",
     "pet_type", "pet_name", "pet_breed"),
    ("first_name", "last_name", "email"),
    one_row_per_lookup=False,
)
SELLER = Dimension(
    "dim_seller",
    "seller_",
    ("first_name", "last_name", "email", "country", "postal_code"),
    ("first_name", "last_name", "email"),
    one_row_per_lookup=False,
)
PRODUCT = Dimension(
    "dim_product",
    "product_",
    ("name", "category", "price", "quantity", "weight", "color", "size", "brand",
     "material", "description", "rating", "reviews", "release_date", "expiry_date"),
    ("name", "category"),
    one_row_per_lookup=True,
)
STORE = Dimension(
    "dim_store",
    "store_",
    ("name", "location", "city", "state", "country", "phone", "email"),
    ("name", "email"),
    one_row_per_lookup=True,
)
SUPPLIER = Dimension(
    "dim_supplier",
    "supplier_",
    ("name", "contact", "email", "phone", "address", "city", "country"),
    ("name", "email"),
    one_row_per_lookup=True,
)
PET_CATEGORY = Dimension(
    "dim_pet_category", "pet_", ("category",), ("category",), one_row_per_lookup=False
)
# The date dimension holds the parsed date; its parts follow from it.
DATE = Dimension("dim_date", "", ("sale_date",), ("sale_date",), one_row_per_lookup=False)

DIMENSIONS = (CUSTOMER, SELLER, PRODUCT, STORE, SUPPLIER, PET_CATEGORY, DATE)

FACT_TABLE = "fact_sales"
# The largest staging id of each load of a star that is appended to.
LOADED_TABLE = "star_loads"
FACT_MEASURES = ("sale_quantity", "sale_total_price")

_TYPES = {name: kind for name, kind in STAGING_COLUMNS}


def _spark_type(kind: str) -> str:
    return "string" if kind == "text" or kind.startswith("varchar") else kind


def _schema(columns) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{name} {_spark_type(kind)}" for name, kind in columns))


def staging_schema() -> T.StructType:
    return _schema(STAGING_COLUMNS)


def dimension_schema(dim: Dimension) -> T.StructType:
    if dim is DATE:
        return _schema([(dim.key, "bigint"), ("sale_date", "date"),
                        ("day", "int"), ("month", "int"), ("year", "int")])
    return _schema([(dim.key, "bigint")] + [(c, _TYPES[dim.source(c)]) for c in dim.columns])


def fact_schema() -> T.StructType:
    keys = [("sale_id", "bigint")] + [(dim.key, "bigint") for dim in DIMENSIONS]
    return _schema(keys + [(c, _TYPES[c]) for c in FACT_MEASURES])


def mart_schema(table: str) -> T.StructType:
    return _schema(MART_COLUMNS[table])


def table_schema(table: str) -> T.StructType:
    """Schema of any table of the three layers, by name."""
    if table == STAGING_TABLE:
        return staging_schema()
    if table == FACT_TABLE:
        return fact_schema()
    if table == LOADED_TABLE:
        return _schema([("last_id", "bigint")])
    if table in MART_COLUMNS:
        return mart_schema(table)
    return dimension_schema(next(dim for dim in DIMENSIONS if dim.table == table))


def text_limits() -> dict[str, int]:
    """Staging text columns with a length limit."""
    return {
        name: int(kind.removeprefix("varchar(").removesuffix(")"))
        for name, kind in STAGING_COLUMNS
        if kind.startswith("varchar")
    }


# Digits that any integer of a type may have.
_INTEGER_DIGITS = {"int": 9, "bigint": 18}


def number_limits() -> dict[str, tuple[int, int]]:
    """Staging number columns, with the digits they may have in all and behind the point."""
    limits = {}
    for name, kind in STAGING_COLUMNS:
        if kind.startswith("decimal"):
            precision, scale = kind.removeprefix("decimal(").removesuffix(")").split(",")
            limits[name] = int(precision), int(scale)
        elif kind in _INTEGER_DIGITS:
            limits[name] = _INTEGER_DIGITS[kind], 0
    return limits


def text_schema(schema: T.StructType) -> T.StructType:
    """The same columns, all of them text."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a table's schema; the one cast before each write."""
    return df.selectExpr(
        *[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema]
    )
