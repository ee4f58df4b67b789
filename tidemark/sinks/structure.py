"""Keys, indexes and defaults of a database table, rebuilt for a table that is to take its place.

A Spark catalogue shows columns only. The database's own catalogue is read as
rows, and the statements that rebuild the structure are made from them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..sources.jdbc import Connection, catalogue_query, jdbc_scan
from .batches import Database

# Catalogue statements per database.
LIST_INDEXES = {
    "mysql": (
        "SELECT table_name, index_name, CASE WHEN index_name = 'PRIMARY' THEN 'P' WHEN non_unique = 0 THEN 'U' ELSE 'N' END"
        " AS kind, seq_in_index AS ordinal, column_name, CASE WHEN collation = 'D' THEN 1 ELSE 0 END AS descending,"
        " sub_part AS prefix FROM information_schema.statistics WHERE table_schema = {database}"
    ),
    "sqlserver": (
        "SELECT t.name AS table_name, i.name AS index_name, CASE WHEN i.is_primary_key = 1 THEN 'P' WHEN i.is_unique = 1"
        " THEN 'U' ELSE 'N' END AS kind, ic.key_ordinal AS ordinal, c.name AS column_name, ic.is_descending_key AS descending,"
        " NULL AS prefix FROM sys.indexes i JOIN sys.tables t ON t.object_id = i.object_id"
        " JOIN sys.index_columns ic ON ic.object_id = i.object_id AND ic.index_id = i.index_id AND ic.key_ordinal > 0"
        " JOIN sys.columns c ON c.object_id = ic.object_id AND c.column_id = ic.column_id"
    ),
    "oracle": (
        "SELECT i.table_name, i.index_name, CASE WHEN k.constraint_type = 'P' THEN 'P' WHEN i.uniqueness = 'UNIQUE' THEN 'U'"
        " ELSE 'N' END AS kind, ic.column_position AS ordinal, ic.column_name, CASE WHEN ic.descend = 'DESC' THEN 1 ELSE 0 END"
        " AS descending, NULL AS prefix FROM user_indexes i JOIN user_ind_columns ic ON ic.index_name = i.index_name"
        " LEFT JOIN user_constraints k ON k.index_name = i.index_name AND k.constraint_type = 'P'"
    ),
}
LIST_DETAILS = {
    "mysql": (
        "SELECT table_name, ordinal_position AS ordinal, column_name, column_type, CASE WHEN is_nullable = 'YES' THEN 1 ELSE 0"
        " END AS nullable, column_default AS default_text, extra FROM information_schema.columns WHERE table_schema = {database}"
    ),
    "sqlserver": (
        "SELECT t.name AS table_name, c.column_id AS ordinal, c.name AS column_name, CASE WHEN y.name IN ('decimal', 'numeric')"
        " THEN CONCAT(y.name, '(', c.precision, ',', c.scale, ')') WHEN y.name IN ('varchar', 'char', 'varbinary', 'binary')"
        " THEN CONCAT(y.name, '(', CASE WHEN c.max_length < 0 THEN 'max' ELSE CAST(c.max_length AS varchar(9)) END, ')')"
        " WHEN y.name IN ('nvarchar', 'nchar') THEN CONCAT(y.name, '(', CASE WHEN c.max_length < 0 THEN 'max'"
        " ELSE CAST(c.max_length / 2 AS varchar(9)) END, ')') ELSE y.name END AS column_type, c.is_nullable AS nullable,"
        " d.definition AS default_text, '' AS extra FROM sys.columns c JOIN sys.tables t ON t.object_id = c.object_id"
        " JOIN sys.types y ON y.user_type_id = c.user_type_id LEFT JOIN sys.default_constraints d"
        " ON d.object_id = c.default_object_id"
    ),
    "oracle": (
        "SELECT table_name, column_id AS ordinal, column_name, CASE WHEN data_type = 'NUMBER' AND data_precision IS NOT NULL"
        " THEN data_type || '(' || data_precision || ',' || data_scale || ')' WHEN data_type LIKE '%CHAR%' OR data_type = 'RAW'"
        " THEN data_type || '(' || CASE WHEN char_used = 'C' THEN char_length || ' CHAR' ELSE TO_CHAR(data_length) END || ')'"
        " ELSE data_type END AS column_type, CASE WHEN nullable = 'Y' THEN 1 ELSE 0 END AS nullable,"
        " data_default AS default_text, '' AS extra FROM user_tab_columns"
    ),
}
# Longest name of an index, where names are shared by all tables.
ORACLE_NAME = 30


@dataclass(frozen=True)
class IndexPart:
    """One column of an index; ``kind`` is P (primary key), U (unique) or N."""

    index_name: str
    kind: str
    ordinal: int
    column_name: str
    descending: bool = False
    prefix: int | None = None


@dataclass(frozen=True)
class Detail:
    """One column with what the catalogue says of it."""

    ordinal: int
    column_name: str
    column_type: str
    nullable: bool = True
    default_text: str | None = None
    extra: str = ""


def default_clause(detail: Detail, dialect: str) -> str:
    """`` DEFAULT ...`` of a column, empty without one.

    MySQL tells literals without quotes and marks expressions; the others tell
    the text of the clause.
    """
    text = detail.default_text
    if text is None or not text.strip() or text.strip().upper() == "NULL":
        return ""
    if dialect != "mysql":
        return f" DEFAULT {text.strip()}"
    if re.match(r"(?i)current_timestamp", text):
        moved = re.search(r"(?i)on update current_timestamp(\(\d\))?", detail.extra)
        return f" DEFAULT {text}" + (f" {moved[0].upper()}" if moved else "")
    if "DEFAULT_GENERATED" in detail.extra.upper():
        return f" DEFAULT ({text})"
    if re.match(r"b'[01]+'$", text):
        return f" DEFAULT {text}"
    return " DEFAULT '{}'".format(text.replace("\\", "\\\\").replace("'", "''"))


def structure_statements(
    details: Iterable[Detail], parts: Iterable[IndexPart], table: str, database: Database, suffix: str = ""
) -> list[str]:
    """Statements that create an empty ``table`` with columns, defaults, primary key and indexes.

    ``suffix`` makes index names new where the database wants them to differ
    over all tables. A column that numbers itself stays so on MySQL, which takes
    given values for it; elsewhere it becomes a plain one, for the rows bring
    theirs. An index on an expression, which has no column, is left out.
    """
    dialect, name = database.dialect, database.name(*table.split("."))
    lines = []
    for detail in sorted(details, key=lambda d: d.ordinal):
        clause = default_clause(detail, dialect)
        null = "" if detail.nullable else " NOT NULL"
        numbered = " AUTO_INCREMENT" if dialect == "mysql" and "auto_increment" in detail.extra.lower() else ""
        # Oracle wants the default before NOT NULL, the others take either order.
        lines.append(f"{database.name(detail.column_name)} {detail.column_type}{clause}{null}{numbered}")
    if not lines:
        raise ValueError(f"no columns are told for {table}")
    indexes: dict[str, list[IndexPart]] = {}
    for part in parts:
        if part.column_name:
            indexes.setdefault(part.index_name, []).append(part)
    made = []
    for index, columns in sorted(indexes.items()):
        columns.sort(key=lambda p: p.ordinal)
        named = ", ".join(_index_column(p, database) for p in columns)
        if columns[0].kind == "P":
            lines.append(f"PRIMARY KEY ({named})")
            continue
        unique = "UNIQUE " if columns[0].kind == "U" else ""
        made.append(f"CREATE {unique}INDEX {database.name(_index_name(index, suffix, dialect))} ON {name} ({named})")
    return [f"CREATE TABLE {name} ({', '.join(lines)})", *made]


def _index_column(part: IndexPart, database: Database) -> str:
    length = f"({part.prefix})" if part.prefix and database.dialect == "mysql" else ""
    down = " DESC" if part.descending and part.kind != "P" else ""
    return f"{database.name(part.column_name)}{length}{down}"


def _index_name(index: str, suffix: str, dialect: str) -> str:
    if dialect != "oracle" or not suffix:
        return index
    base = re.sub(r"_\d{8}$", "", index)  # the suffix of an earlier day goes
    return f"{base[: ORACLE_NAME - len(suffix) - 1]}_{suffix}"


def read_structure(spark: SparkSession, connection: Connection, table: str) -> tuple[list[Detail], list[IndexPart]]:
    """Columns and index columns of one table, from the database's catalogue; as many rows as it has of these."""
    details, parts = [], []
    for row in jdbc_scan(spark, connection, query=catalogue_query(connection, LIST_DETAILS)).collect():
        if row[0].lower() == table.lower():
            details.append(Detail(int(row[1]), row[2], row[3], bool(row[4]), row[5], row[6] or ""))
    for row in jdbc_scan(spark, connection, query=catalogue_query(connection, LIST_INDEXES)).collect():
        if row[0].lower() == table.lower():
            parts.append(IndexPart(row[1], row[2], int(row[3]), row[4], bool(row[5]), None if row[6] is None else int(row[6])))
    return details, parts


def run_statements(database: Database, statements: Sequence[str]) -> None:
    """Run statements in order over one connection."""
    connection = database.connect()
    try:
        cursor = connection.cursor()
        for statement in statements:
            cursor.execute(statement)
        connection.commit()
    finally:
        connection.close()


def stage_like(spark: SparkSession, connection: Connection, database: Database, table: str, today: str) -> str:
    """Create ``<table>_<today>`` empty, with the keys, indexes and defaults of ``table``; returns its name.

    An older one of that name goes. For ``staging_like`` of
    :func:`export.export_rename`, after the catalogue's part of the name.
    """
    staging = f"{table}_{today}"
    details, parts = read_structure(spark, connection, table.split(".")[-1])
    exists, _ = read_structure(spark, connection, staging.split(".")[-1])
    drop = [f"DROP TABLE {database.name(*staging.split('.'))}"] if exists else []
    run_statements(database, [*drop, *structure_statements(details, parts, staging, database, today)])
    return staging
