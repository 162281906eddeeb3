"""Tables of a database, over Spark's JDBC source and sink.

No driver is bundled and nothing here was run against a server; what is tested
is the options handed to Spark.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from starmill.schemas import MART_ORDER, conform, table_schema
from starmill.sources.stage import observed

# URL forms of the two databases.
POSTGRES_URL = "jdbc:postgresql://{host}:{port}/{database}"
CLICKHOUSE_URL = "jdbc:ch://{host}:{port}/{database}"


@dataclass(frozen=True)
class JdbcDatabase:
    url: str
    driver: str
    user: str
    password: str = field(repr=False)
    # Connections open at a time, when reading and when writing.
    connections: int = 16
    write_options: Mapping[str, object] = field(default_factory=dict)
    # Whether an overwrite keeps the definition of a table.
    truncates: bool = True
    # Further options per table, for one that is created.
    create_options: Mapping[str, str] = field(default_factory=dict)

    def _options(self) -> dict[str, object]:
        return {"url": self.url, "driver": self.driver, "user": self.user,
                "password": self.password}

    def bounds_options(self, table: str, column: str) -> dict[str, object]:
        query = f"SELECT min({column}) AS low, max({column}) AS high FROM {table}"
        return {**self._options(), "query": query}

    def read_options(
        self, table: str, column: str | None = None, low: int | None = None, high: int | None = None
    ) -> dict[str, object]:
        options = {**self._options(), "dbtable": table, "fetchsize": 10_000}
        if column is None or low is None:
            return options
        # Bounds only set the strides; rows outside and NULLs are read as well.
        return {**options, "partitionColumn": column, "lowerBound": low, "upperBound": high + 1,
                "numPartitions": max(1, min(self.connections, high - low + 1))}

    def table_options(self, table: str) -> dict[str, object]:
        return {**self._options(), "dbtable": table, "batchsize": 10_000,
                "numPartitions": self.connections, **self.write_options,
                **({"createTableOptions": self.create_options[table]} if table in self.create_options else {})}

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """A whole table, read in parallel over ranges of its integer key."""
        schema = table_schema(table)
        column = schema.names[0]
        jdbc = spark.read.format("jdbc")
        if schema[column].dataType.simpleString() != "bigint":
            return conform(jdbc.options(**self.read_options(table)).load(), schema)
        low, high = jdbc.options(**self.bounds_options(table, column)).load().first()
        options = self.read_options(table, column, low and int(low), high and int(high))
        return conform(spark.read.format("jdbc").options(**options).load(), schema)

    def write_tables(
        self, tables: Mapping[str, DataFrame], mode: str = "overwrite"
    ) -> dict[str, int]:
        """Write tables one by one, in the order given: dimensions before the fact.

        Overwriting empties a table and keeps its definition. Where the database
        cascades, that also empties the tables that refer to it, hence the order. Where an
        overwrite would drop the table instead, it is refused.
        """
        if mode == "overwrite" and not self.truncates:
            raise ValueError("an overwrite would drop tables and their engines here: empty them and append")
        counts = {}
        for table, df in tables.items():
            rows, counted = observed(conform(df, table_schema(table)))
            writer = rows.write.format("jdbc").options(**self.table_options(table))
            writer.mode(mode).save()
            counts[table] = counted()
        return counts


def postgres(
    host: str, port: int, database: str, user: str, password: str,
    driver: str = "org.postgresql.Driver",
) -> JdbcDatabase:
    """A database that keeps table definitions on overwrite, and cascades."""
    return JdbcDatabase(
        POSTGRES_URL.format(host=host, port=port, database=database), driver, user, password,
        write_options={"truncate": True, "cascadeTruncate": True},
    )


def clickhouse(
    host: str, port: int, database: str, user: str, password: str,
    driver: str = "com.clickhouse.jdbc.Driver",
) -> JdbcDatabase:
    """A database of marts, which loads append to.

    Spark does not know that it can truncate here and would drop the table on overwrite.
    """
    return JdbcDatabase(
        CLICKHOUSE_URL.format(host=host, port=port, database=database), driver, user, password,
        truncates=False, create_options={table: merge_tree(table) for table in MART_ORDER},
    )


def merge_tree(mart: str) -> str:
    keys = MART_ORDER[mart]
    return f"ENGINE = MergeTree() ORDER BY {keys[0] if len(keys) == 1 else '(' + ', '.join(keys) + ')'}"


# Types of mart columns.
_CLICKHOUSE_TYPES = {"bigint": "Int64", "int": "Int32", "string": "String", "double": "Float64", "date": "Date"}


def clickhouse_definition(mart: str, database: str) -> str:
    """The statement that creates an empty mart with its engine and sort key."""
    def column(f) -> str:
        kind = f.dataType.simpleString()
        named = _CLICKHOUSE_TYPES.get(kind) or kind.replace("decimal", "Decimal")
        return f"{f.name} {named}" if f.name in MART_ORDER[mart] else f"{f.name} Nullable({named})"

    columns = ", ".join(column(f) for f in table_schema(mart))
    return f"CREATE TABLE IF NOT EXISTS {database}.{mart} ({columns}) {merge_tree(mart)}"
