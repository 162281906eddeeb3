"""The star stated in SQL.

This form differs from ``plans.star`` in the dimensions: every staging row gives
a dimension row, nothing is deduplicated. The fact is the same, as it is
resolved against the deduplicated dimensions; against the repeated ones each
sale would be multiplied seven times over, which ``audits.lookup_fanout`` sizes and
``multiplied.multiplied_totals`` sums up.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions.dates import SALE_DATE_FORMAT
from starmill.operators.dense_key import with_dense_key_along
from starmill.operators.distinct_numbers import repeated, spreads
from starmill.operators.lookup import Lookup, prepare
from starmill.plans.star import FACT_ORDER, LOOKUP_ORDER, fact_inputs
from starmill.schemas import (
    DATE,
    FACT_MEASURES,
    FACT_TABLE,
    PET_CATEGORY,
    Dimension,
    conform,
    dimension_schema,
    fact_schema,
)

_SALE_DAY = f"try_to_date(m.sale_date, '{SALE_DATE_FORMAT}')"


def raw_dimension_sql(dim: Dimension) -> str:
    if dim is DATE:
        return (
            "SELECT id, sale_date, CAST(extract(DAY FROM sale_date) AS INT) AS day, "
            "CAST(extract(MONTH FROM sale_date) AS INT) AS month, "
            "CAST(extract(YEAR FROM sale_date) AS INT) AS year "
            f"FROM (SELECT m.id, {_SALE_DAY} AS sale_date FROM {{staging}} AS m "
            "WHERE m.sale_date IS NOT NULL)"
        )
    columns = ", ".join(f"{dim.source(c)} AS {c}" for c in dim.columns)
    kept = f" WHERE {dim.source('category')} IS NOT NULL" if dim is PET_CATEGORY else ""
    return f"SELECT id, {columns} FROM {{staging}}{kept}"


def raw_dimension(staging: DataFrame, dim: Dimension) -> DataFrame:
    """A dimension with one row per staging row, numbered in staging order; rows that share
    an id are numbered by their columns."""
    rows = staging.sparkSession.sql(raw_dimension_sql(dim), staging=staging)
    whole = dim not in (DATE, PET_CATEGORY)
    first = _gap_free_start(staging) if whole else None
    if first is None:
        order = ["id", *(c for c in rows.columns if c != "id")]
        keyed = with_dense_key_along(rows, dim.key, order, f"raw_{dim.table}", staging.select("id"))
    else:
        keyed = rows.withColumn(dim.key, F.col("id") - F.lit(first - 1))
    return conform(keyed, dimension_schema(dim))


def _gap_free_start(staging: DataFrame) -> int | None:
    """The first id, if ids have no gap and none is missing or repeated. The rank of a row
    is then its id less a constant: no sort."""
    ids = spreads({"id": (staging, "id")})["id"]
    if not ids.rows or ids.nulls or ids.high - ids.low + 1 != ids.rows:
        return None
    # As many numbers as places: none is missing if none is repeated.
    return None if repeated(staging, "id", ids.lies_together).head(1) else ids.low


def fact_sql(lookups: Mapping[str, Lookup]) -> str:
    """Sales joined with seven lookups; names in braces are tables handed in."""
    keys = ", ".join(dim.key for dim in LOOKUP_ORDER)
    joins = " ".join(
        f"JOIN {{{table}}} AS {table} USING ({', '.join(lookup.on)})"
        for table, lookup in lookups.items()
    )
    return f"SELECT id, {keys}, {', '.join(FACT_MEASURES)} FROM {{sales}} AS sales {joins}"


def build_fact_sql(staging: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    sales, lookups = prepare(*fact_inputs(staging, dims), row_id="id")
    tables = {table: lookup.rows for table, lookup in lookups.items()}
    rows = staging.sparkSession.sql(fact_sql(lookups), sales=sales, **tables)
    keyed = with_dense_key_along(rows, "sale_id", FACT_ORDER, f"{FACT_TABLE}_sql", staging.select("id"))
    return conform(keyed, fact_schema())
