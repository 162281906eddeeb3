import random
from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F
from sales import sale, staging
from starmill.functions import residues
from starmill.plans.multiplied import multiplied_totals
from starmill.plans.sql_star import raw_dimension
from starmill.plans.star import lookup_columns
from starmill.schemas import DATE, DIMENSIONS


def really_multiplied(rows):
    """The fact over the repeated dimensions, joined row by row."""
    fact = rows.withColumn("day", F.try_to_date("sale_date", "M/d/yyyy"))
    for dim in DIMENSIONS:
        raw = raw_dimension(rows, dim)
        if dim is DATE:
            fact = fact.join(raw.select(F.col("sale_date").alias("day"), dim.key), "day")
        else:
            fact = fact.join(raw.select(dim.key, *[F.col(c).alias(dim.source(c)) for c in dim.lookup]), list(lookup_columns(dim)))
    totals = defaultdict(lambda: [0, None, None])
    for r in fact.select("day", "sale_quantity", "sale_total_price").collect():
        of = totals[r.day.year, r.day.month]
        of[0] += 1
        for k, v in ((1, r.sale_quantity), (2, r.sale_total_price)):
            if v is not None:
                of[k] = (of[k] or 0) + v
    return {(*m, str(n), None if q is None else str(q), None if p is None else str(p)) for m, (n, q, p) in totals.items()}


def test_totals_equal_those_of_the_multiplied_fact(spark):
    rng = random.Random(1)
    rows = staging(spark, *[
        sale(i, customer_email=rng.choice("ab"), customer_age=i, seller_email=rng.choice(["a", "b", None]), product_name=rng.choice("abcd"),
             store_email=rng.choice("abc"), pet_category=rng.choice(["c", "d", None]), sale_date=rng.choice(["1/2/2021", "01/02/2021", "2/3/2021", "n/a", None]),
             sale_quantity=rng.choice([1, 7, -3]), supplier_name=str(i % 5))
        for i in range(8)
    ], sale(100, sale_quantity=None, sale_total_price=None, sale_date="5/5/2022"))
    got = {tuple(r[c] for c in ("year", "month", "fact_rows", "total_quantity", "total_revenue")) for r in multiplied_totals(rows).collect()}
    assert got == really_multiplied(rows) and len(got) >= 2


def test_no_sales(spark):
    assert multiplied_totals(staging(spark)).collect() == []
    assert multiplied_totals(staging(spark, sale(1, sale_date="never"))).collect() == []


@pytest.mark.parametrize("factors", [(3, 5), (2 ** 62, 2 ** 62, 2 ** 61, 7), (-(2 ** 40), 2 ** 62, 2 ** 62), (0, 9)])
def test_sums_of_products_of_any_size(spark, factors):
    df = spark.range(1000).select(F.lit(1).alias("g"), "id", *[F.lit(f).alias(f"f{i}") for i, f in enumerate(factors)])
    df = residues.with_product(df, [F.col(f"f{i}") for i in range(len(factors))], "r")
    sums = df.groupBy("g").agg(residues.remainder_sums("r", F.col("id")).alias("n"))
    expected = 999 * 500
    for f in factors:
        expected *= f
    assert residues.with_whole_numbers(sums, ["n"]).first()["n"] == str(expected)
    cents = residues.with_whole_numbers(sums, ["n"], places=2).first()["n"]
    assert int(cents.replace(".", "")) == expected and cents[-3] == "."


def test_primes_suffice():
    ps = residues.primes()
    assert len(set(ps)) == len(ps) and max(ps) < 2 ** 31 and all(pow(2, p - 1, p) == 1 for p in ps)


def test_day_of_a_text_is_shared(spark):
    rows = staging(spark, sale(1, sale_date="1/2/2021"), sale(2, sale_date="01/02/2021"))
    assert [(r.year, r.month, r.fact_rows) for r in multiplied_totals(rows).collect()] == [
        (date(2021, 1, 2).year, 1, str(2 ** 8))]  # two sales, two rows in each of seven dimensions
