"""Warehouse tables: scans, descriptions and high-water marks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import quoted


def warehouse_scan(spark: SparkSession, table: str) -> DataFrame:
    """A whole warehouse table."""
    return spark.table(table)


def partition_scan(df: DataFrame, key: str | Column, value: str) -> DataFrame:
    """One partition's rows; on a stored partition column only its files are read."""
    return df.where((F.col(key) if isinstance(key, str) else key) == value)


def day_scan(df: DataFrame, column: str, day: str) -> DataFrame:
    """Rows of one day, ``yyyyMMdd``, as a time range, which reaches the scan."""
    start = F.to_timestamp(F.lit(day), "yyyyMMdd").cast("timestamp_ntz")
    end = start + F.expr("INTERVAL 1 DAY")
    return df.where((F.col(column) >= start) & (F.col(column) < end))


def table_exists(spark: SparkSession, table: str) -> bool:
    """True if the table is there, in whichever catalog its name gives."""
    return spark.catalog.tableExists(table)


def describe_columns(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    """Names and types in order, without partition columns; empty if the table is missing.

    The catalog tells partition columns apart; DESCRIBE gives the declared
    type, with the length of a varchar.
    """
    if not table_exists(spark, table):
        return []
    names = [c.name for c in spark.catalog.listColumns(table) if not c.isPartition]
    described = spark.sql(f"DESCRIBE TABLE {quoted(table)}").collect()
    kinds = {r["col_name"]: r["data_type"] for r in reversed(described)}
    return [(name, kinds[name]) for name in names]


def list_source_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """Tables of ``catalog.database`` as ``table_name``."""
    listed = spark.sql(f"SHOW TABLES IN {quoted(namespace)}")
    return listed.where(~F.col("isTemporary")).select(F.col("tableName").alias("table_name"))


def filter_name_prefix(names: DataFrame, prefix: str, column: str = "table_name") -> DataFrame:
    """Names that start with a prefix."""
    return names.where(F.col(column).startswith(prefix))


def first_mark(kind: str, start: object = 0) -> object:
    """Where an empty target starts: ``start``, or 1970-01-01 for a date or time that names none."""
    timed = re.match(r"(?i)(small)?(date|time)", kind.strip()) is not None
    return "1970-01-01" if start == 0 and timed else start


def high_water_mark(target: DataFrame, max_value: str, start: object = 0) -> DataFrame:
    """One row with the value of a stored aggregate expression as ``max_value``.

    An empty target gives :func:`first_mark` of the expression's type instead of NULL.
    """
    marked = target.agg(F.expr(max_value).alias("max_value"))
    kind = marked.schema["max_value"].dataType
    start = first_mark(kind.simpleString(), start)
    return marked.select(F.coalesce("max_value", F.lit(start).cast(kind)).alias("max_value"))


def read_mark(spark: SparkSession, table: str, max_value: str, start: object = 0, kind: str = "") -> object:
    """High-water mark as a driver-side scalar.

    A missing or empty table gives :func:`first_mark`. Stamps are stored as
    text, so ``kind`` is the marked column's type at the source.
    """
    start = first_mark(kind, start)
    if not table_exists(spark, table):
        return start
    value = spark.table(table).agg(F.expr(max_value).alias("max_value")).first()["max_value"]
    return start if value is None else value


def fill_filter(template: str, mark: object) -> str:
    """Put the high-water mark into a filter such as ``id > {max_value}``."""
    return template.replace("{max_value}", str(mark))


def incremental_filter(source: DataFrame, target: DataFrame, template: str, max_value: str, start: object = 0) -> DataFrame:
    """Rows of the source beyond the target's mark.

    The mark is fetched first and becomes a literal, so the filter reaches the
    scan, be it files or a database.
    """
    mark = high_water_mark(target, max_value, start).first()["max_value"]
    return source.where(fill_filter(template, mark))
