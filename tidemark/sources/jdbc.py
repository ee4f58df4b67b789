"""Scans of MySQL, SQL Server and Oracle through Spark's JDBC source."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# JDBC address, driver class and catalogue statements per database.
URLS = {
    "mysql": "jdbc:mysql://{host}:{port}/{database}",
    "sqlserver": "jdbc:sqlserver://{host}:{port};databaseName={database}",
    "oracle": "jdbc:oracle:thin:@{host}:{port}:{database}",
}
DRIVERS = {
    "mysql": "com.mysql.cj.jdbc.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "oracle": "oracle.jdbc.OracleDriver",
}
LIST_TABLES = {
    "mysql": "SELECT table_name FROM information_schema.tables WHERE table_schema = {database}",
    "sqlserver": "SELECT name AS table_name FROM sys.tables",
    "oracle": "SELECT table_name FROM user_tables",
}
LIST_COLUMNS = {
    "mysql": (
        "SELECT table_name, ordinal_position AS ordinal, column_name AS name, column_type AS type"
        " FROM information_schema.columns WHERE table_schema = {database}"
    ),
    "sqlserver": (
        "SELECT table_name, ordinal_position AS ordinal, column_name AS name, CASE WHEN data_type IN"
        " ('decimal', 'numeric') THEN CONCAT(data_type, '(', numeric_precision, ',', numeric_scale, ')')"
        " ELSE data_type END AS type FROM information_schema.columns"
    ),
    "oracle": (
        "SELECT table_name, column_id AS ordinal, column_name AS name, CASE WHEN data_type = 'NUMBER' AND"
        " data_precision IS NOT NULL THEN data_type || '(' || data_precision || ',' || data_scale || ')'"
        " ELSE data_type END AS type FROM user_tab_columns"
    ),
}
FETCH_SIZE = 10_000
# Readers of a scan that names a split column but no number of its own.
DEFAULT_READERS = 16


@dataclass(frozen=True)
class Connection:
    """One registered database. User and password stay in the environment,
    as ``TIDEMARK_<connection_id>_USER`` and ``TIDEMARK_<connection_id>_PASSWORD``."""

    connection_id: str
    db_type: str
    host: str
    port: int
    database: str
    jdbc_extend: str = ""

    @classmethod
    def from_row(cls, row: Row) -> Connection:
        """From a registry row joined with its connection; the default database if none is named."""
        database = (row["db_name"] or "").strip() or row["default_db"]
        return cls(row["connection_id"], row["db_type"], row["host"], row["port"], database, row["jdbc_extend"] or "")

    @property
    def dialect(self) -> str:
        if self.db_type.lower() not in URLS:
            raise ValueError(f"database type {self.db_type!r} is not one of {sorted(URLS)}")
        return self.db_type.lower()

    @property
    def url(self) -> str:
        url = URLS[self.dialect].format(host=self.host, port=self.port, database=self.database)
        extras = [self.jdbc_extend] if self.jdbc_extend else []
        if self.dialect == "mysql" and "tinyInt1isBit" not in self.jdbc_extend:
            # Else tinyint(1) arrives as a boolean and loses its number.
            extras.append("tinyInt1isBit=false")
        if self.dialect == "sqlserver":
            return ";".join([url, *extras])
        return url + ("?" + "&".join(extras) if extras else "")

    def options(self) -> dict[str, str]:
        options = {"url": self.url, "driver": DRIVERS[self.dialect]}
        for key, suffix in (("user", "USER"), ("password", "PASSWORD")):
            value = os.environ.get(f"TIDEMARK_{self.connection_id}_{suffix}")
            if value is not None:
                options[key] = value
        return options


@dataclass(frozen=True)
class Split:
    """Parallel read: a numeric, date or timestamp column cut into ranges."""

    column: str
    lower: object
    upper: object
    readers: int


def relation(connection: Connection, table: str | None = None, query: str | None = None, where: str | None = None) -> str:
    """What to read: a query, a table, or the rows of a table that pass a filter.

    A query overrides table and filter. The filter is in the database's own
    dialect and is run there.
    """
    if query:
        return f"({query.strip().rstrip(';')}) src"
    if not table:
        raise ValueError("name a table or a query")
    name = table.upper() if connection.dialect == "oracle" else table
    return f"(SELECT * FROM {name} WHERE {where}) src" if where and where.strip() != "1=1" else name


def read_options(
    connection: Connection,
    table: str | None = None,
    query: str | None = None,
    where: str | None = None,
    split: Split | None = None,
    types: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of the JDBC reader for one scan."""
    options = {
        **connection.options(),
        "dbtable": relation(connection, table, query, where),
        "fetchsize": str(FETCH_SIZE),
    }
    if types:
        options["customSchema"] = ", ".join(f"{name} {kind}" for name, kind in types.items())
    if split and split.readers > 1:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.readers),
        }
    return options


def jdbc_scan(
    spark: SparkSession,
    connection: Connection,
    table: str | None = None,
    query: str | None = None,
    where: str | None = None,
    split: Split | None = None,
    types: dict[str, str] | None = None,
) -> DataFrame:
    """Read a table, a filtered table or a query, with one or more readers.

    Select columns and filter on the result: Spark fetches only those columns
    and sends plain predicates to the database.
    """
    options = read_options(connection, table, query, where, split, types)
    return spark.read.format("jdbc").options(**options).load()


def split_query(connection: Connection, column: str, table: str | None = None, query: str | None = None, where: str | None = None) -> str:
    """Statement for the bounds of a split column; one row comes back."""
    return f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {relation(connection, table, query, where)}"


def jdbc_split(
    spark: SparkSession,
    connection: Connection,
    column: str,
    readers: int,
    table: str | None = None,
    query: str | None = None,
    where: str | None = None,
) -> Split | None:
    """Ask the database for the bounds of a split column; None without rows."""
    bounds = jdbc_scan(spark, connection, query=split_query(connection, column, table, query, where)).first()
    return None if bounds is None or bounds[0] is None else Split(column, bounds[0], bounds[1], readers)


def spread_predicates(connection: Connection, column: str, readers: int) -> list[str]:
    """One filter a reader by the remainder of a whole-number key, so that no dense range falls to one reader.

    Every row passes exactly one, a NULL key the first. Each reader makes the
    database look at the whole table, or at the index of the key.
    """
    rest = f"{column} % {readers}" if connection.dialect == "sqlserver" else f"MOD({column}, {readers})"
    first = f"({rest} = 0 OR {column} IS NULL)"
    return [first, *[f"ABS({rest}) = {k}" for k in range(1, readers)]]


def spread_scan(
    spark: SparkSession,
    connection: Connection,
    column: str,
    readers: int,
    table: str | None = None,
    query: str | None = None,
    where: str | None = None,
) -> DataFrame:
    """Read a table, a filtered table or a query by :func:`spread_predicates`."""
    options = read_options(connection, table, query, where)
    url, what = options.pop("url"), options.pop("dbtable")
    return spark.read.jdbc(url, what, predicates=spread_predicates(connection, column, readers), properties=options)


def count_scan(spark: SparkSession, connection: Connection, table: str) -> DataFrame:
    """One row ``table_name, table_rows``, counted by the database."""
    query = f"SELECT COUNT(1) AS table_rows FROM {relation(connection, table)}"
    counted = jdbc_scan(spark, connection, query=query).toDF("table_rows")
    return counted.select(F.lit(table).alias("table_name"), F.col("table_rows").cast("bigint").alias("table_rows"))


def catalogue_query(connection: Connection, statements: dict[str, str]) -> str:
    """A catalogue statement of the connection's dialect, database name filled in."""
    database = "'" + connection.database.replace("'", "''") + "'"
    return statements[connection.dialect].format(database=database)


def list_source_tables(spark: SparkSession, connection: Connection) -> DataFrame:
    """Tables of the database as ``table_name``."""
    return jdbc_scan(spark, connection, query=catalogue_query(connection, LIST_TABLES)).toDF("table_name")


def source_catalogue(spark: SparkSession, connection: Connection, tables: Sequence[str] = ()) -> DataFrame:
    """Column catalogue of the whole database or of some tables, in one query, with ``connection_id`` and ``db_name``."""
    listed = jdbc_scan(spark, connection, query=catalogue_query(connection, LIST_COLUMNS))
    listed = listed.toDF("table_name", "ordinal", "name", "type")
    if tables:
        listed = listed.where(F.lower("table_name").isin(*[t.lower() for t in tables]))
    own = {"connection_id": F.lit(connection.connection_id), "db_name": F.lit(connection.database)}
    return listed.withColumns(own)


def catalog_options(connection: Connection, catalog: str, writers: int | None = None) -> dict[str, str]:
    """Session settings that mount the database as a Spark catalog.

    Exports then name their target ``<catalog>.<database>.<table>`` and create,
    rename, list and drop tables with plain SQL.
    """
    prefix = f"spark.sql.catalog.{catalog}"
    settings = {prefix: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"}
    settings |= {f"{prefix}.{key}": value for key, value in connection.options().items()}
    if writers:
        settings[f"{prefix}.numPartitions"] = str(writers)
    return settings
