"""Row-by-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

SMALL = "/root/testdata/sf0.001"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    table = df.select(*names).toArrow()
    return names, _counted(table, names)


def duckdb_rows(con, sql: str) -> tuple[list[str], Counter]:
    table = con.sql(sql).to_arrow_table()
    names = sorted(table.column_names)
    return names, _counted(table.select(names), names)


def _counted(table, names) -> Counter:
    return Counter(zip(*[table.column(n).to_pylist() for n in names])) if names else Counter()


def difference(df, con, sql: str) -> str:
    """Empty if both have the same columns and rows, else what differs first."""
    names, ours = spark_rows(df)
    their_names, theirs = duckdb_rows(con, sql)
    if names != their_names:
        return f"columns {names} against {their_names}"
    if ours != theirs:
        extra, lacking = ours - theirs, theirs - ours
        return (f"{sum(ours.values())} rows against {sum(theirs.values())}; "
                f"only Spark {list(extra)[:2]}; only SQL {list(lacking)[:2]}")
    return ""
