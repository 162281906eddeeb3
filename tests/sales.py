"""Hand-made staging rows: a plain sale, with the columns a test cares about changed."""

from datetime import date
from decimal import Decimal

from starmill.schemas import staging_schema

_PLAIN = {
    "int": 1,
    "bigint": 1,
    "string": "x",
    "date": date(2021, 1, 2),
    "decimal(10,2)": Decimal("10.00"),
    "decimal(3,1)": Decimal("4.5"),
}


def sale(id, **changed):
    row = {f.name: _PLAIN[f.dataType.simpleString()] for f in staging_schema()}
    unknown = set(changed) - set(row)
    assert not unknown, unknown
    return {**row, "sale_date": "1/2/2021", "id": id, **changed}


def staging(spark, *rows):
    schema = staging_schema()
    return spark.createDataFrame([tuple(row[n] for n in schema.names) for row in rows], schema)


def star(rows_df):
    from starmill.plans.star import build_dimensions, build_fact

    dims = build_dimensions(rows_df)
    return {**dims, "fact_sales": build_fact(rows_df, dims)}


def tuples(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)
