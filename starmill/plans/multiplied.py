"""Totals of the fact over the repeated dimensions, without building it.

Against dimensions with a row per sale, each sale appears once for every choice of seven rows
that share its natural keys: far too many to write. But its rows are all alike in what is
summed up, so their number, the product of seven counts, is all that is needed of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions.residues import remainder_sums, with_product, with_whole_numbers
from starmill.operators.lookup import Lookup, join_all
from starmill.plans.star import LOOKUP_ORDER, date_texts, lookup_columns
from starmill.schemas import DATE, Dimension
from starmill.sources.stage import stage


def _copies(dim: Dimension) -> str:
    return f"{dim.key}_copies"


def multiplicities(staging: DataFrame, dim: Dimension) -> Lookup:
    """Rows of a repeated dimension for each natural key, as the columns of a sale name it."""
    on = lookup_columns(dim)
    counted = staging.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    if dim is DATE:
        # Texts of one day lead to each other's rows.
        days = counted.join(date_texts(staging).select(F.col("text").alias("sale_date"), F.col("sale_date").alias("day")), "sale_date")
        total = days.groupBy("day").agg(F.sum("n").alias(_copies(dim)))
        rows = days.select("sale_date", "day").join(total, "day").select(
            "sale_date", _copies(dim), F.year("day").alias("year"), F.month("day").alias("month"))
    else:
        rows = counted.where(" AND ".join(f"{c} IS NOT NULL" for c in on)).withColumnRenamed("n", _copies(dim))
    return Lookup(stage(rows, f"copies-{dim.table}")[0], on)


def multiplied_totals(staging: DataFrame) -> DataFrame:
    """By month: rows, quantity and revenue of the multiplied fact, exact and in text, as they have
    more digits than a decimal holds. A month without rows is not listed."""
    lookups = {dim.table: multiplicities(staging, dim) for dim in LOOKUP_ORDER}
    wanted = [c for dim in LOOKUP_ORDER for c in lookup_columns(dim)]
    cents = (F.col("sale_total_price") * 100).cast("long").alias("cents")
    sales = join_all(staging.select("id", *wanted, "sale_quantity", cents), lookups, row_id="id")
    copies = [F.col(_copies(dim)) for dim in LOOKUP_ORDER]
    # Sales of one day whose keys are as frequent count as one, with all their measures summed up.
    alike = sales.groupBy("year", "month", *map(_copies, LOOKUP_ORDER)).agg(
        F.count(F.lit(1)).alias("sales"), F.sum("sale_quantity").alias("quantity"), F.sum("cents").alias("cents"))
    # Without a quantity or price in a month, its sum is null.
    months = with_product(alike, copies, "_r").groupBy("year", "month").agg(
        remainder_sums("_r", F.col("sales")).alias("fact_rows"),
        F.when(F.count("quantity") > 0, remainder_sums("_r", F.coalesce("quantity", F.lit(0)))).alias("total_quantity"),
        F.when(F.count("cents") > 0, remainder_sums("_r", F.coalesce("cents", F.lit(0)))).alias("total_revenue"))
    whole = with_whole_numbers(months, ["fact_rows", "total_quantity"])
    return with_whole_numbers(whole, ["total_revenue"], places=2)
