from collections import Counter
from decimal import Decimal

import __spark_entry__
import pytest
from pyspark.sql import functions as F
from sales import sale, staging
from starmill.plans.jobs import load_star
from starmill.schemas import DIMENSIONS, FACT_TABLE, STAGING_TABLE
from starmill.sources.zone import ParquetZone


def first():
    return [
        sale(1, customer_country="a"), sale(2, customer_country="b"), sale(3, customer_country="b"),
        sale(4, seller_country="c", product_price=Decimal("3.00")), sale(5, customer_email="other"),
        sale(6, customer_email=None), sale(7, sale_date="n/a"),
    ]


def second():
    return [
        sale(11, customer_country="0"), sale(12, seller_country="0", customer_country="a"), sale(13, product_price=Decimal("9.00")),
        sale(14, store_email="new", pet_category="new", sale_date="3/4/2022"), sale(15, customer_email="other", seller_country="d"),
        sale(16, customer_email=None, customer_pet_name="new"), sale(17, product_name=None), sale(18, customer_country="b"),
    ]


def loaded(spark, path, *loads, strict=False):
    zone = ParquetZone(str(path / "star"))
    for k, rows in enumerate(loads):
        source = ParquetZone(str(path / f"load-{k}"))
        source.write_tables({STAGING_TABLE: rows})
        load_star(spark, source, zone, "append" if k else "appendable", strict)
    return zone


def in_full(spark, zone):
    """The fact with rows of dimensions in place of keys, and the dimensions without keys."""
    sales, dims = zone.read(spark, FACT_TABLE), {}
    for dim in DIMENSIONS:
        rows = zone.read(spark, dim.table)
        named = rows.select(dim.key, F.struct(*rows.columns[1:]).alias(dim.table))
        sales = sales.join(named, dim.key, "left").drop(dim.key)
        dims[dim.table] = Counter(map(str, rows.drop(dim.key).collect()))
    columns = sorted(c for c in sales.columns if c != "sale_id")
    return Counter(map(str, sales.select(*columns).collect())), dims


def check_keys(spark, zone):
    for table, key in [*[(d.table, d.key) for d in DIMENSIONS], (FACT_TABLE, "sale_id")]:
        n, different, least, most = zone.read(spark, table).agg(
            F.count(key), F.count_distinct(key), F.min(key), F.max(key)).first()
        assert (n, least) == (most, 1) and different == n, table


@pytest.fixture(autouse=True)
def few_partitions(conf):
    conf("spark.sql.shuffle.partitions", "2")


def test_appended_loads_give_the_star_of_one_load(spark, tmp_path):
    rows = [first(), second()[:3], [], second()[3:]]
    zone = loaded(spark, tmp_path / "parts", *[staging(spark, *r) for r in rows])
    whole = loaded(spark, tmp_path / "whole", staging(spark, *first(), *second()))
    assert in_full(spark, zone) == in_full(spark, whole)
    check_keys(spark, zone)


def test_old_keys_stay_and_a_repeated_or_older_load_is_refused(spark, tmp_path):
    zone = loaded(spark, tmp_path, staging(spark), staging(spark, *first()))
    before = {t: zone.read(spark, t) for t in (*[d.table for d in DIMENSIONS], FACT_TABLE)}
    source = ParquetZone(str(tmp_path / "second"))
    source.write_tables({STAGING_TABLE: staging(spark, *second())})
    load_star(spark, source, zone, "append")
    for table, rows in before.items():
        assert rows.exceptAll(zone.read(spark, table)).isEmpty(), table
    count = zone.read(spark, FACT_TABLE).count()
    for k, rows in enumerate((second(), [sale(18)], [sale(9), sale(30)])):
        again = ParquetZone(str(tmp_path / f"again-{k}"))
        again.write_tables({STAGING_TABLE: staging(spark, *rows)})
        with pytest.raises(ValueError, match="up to id 18"):
            load_star(spark, again, zone, "append")
    assert zone.read(spark, FACT_TABLE).count() == count


def test_strict_grain_keeps_one_row_per_sale(spark, tmp_path):
    zone = loaded(spark, tmp_path, staging(spark, *first()), staging(spark, *second()), strict=True)
    assert zone.read(spark, FACT_TABLE).count() == len(first()) - 2 + len(second()) - 2


def test_a_star_replaced_since_is_not_appended_to(spark, tmp_path):
    zone = loaded(spark, tmp_path, staging(spark, *first()))
    source = ParquetZone(str(tmp_path / "load-0"))
    load_star(spark, source, zone)
    with pytest.raises(ValueError, match="not appendable"):
        load_star(spark, source, zone, "append")


def test_star_appended_moves_sales_for_no_small_dimension(spark, ws, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = __spark_entry__.star_appended(ws)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == len(DIMENSIONS) and "SortMergeJoin" not in plan


def test_star_appended_takes_up_large_dimensions_while_sales_are_narrow():
    shown = [(dim.table, len(__spark_entry__.shown(dim))) for dim in __spark_entry__.WIDENING]
    assert sorted(table for table, _ in shown) == sorted(dim.table for dim in DIMENSIONS)
    large = [n for table, n in shown if table in ("dim_supplier", "dim_customer", "dim_product")]
    assert [n for _, n in shown[:3]] == large == sorted(large)
