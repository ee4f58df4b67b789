"""Positional schema comparison, for any number of tables at once.

A column catalogue is a DataFrame of ``table_name, ordinal, name, type``.
Findings carry a flag: ``same``, ``diff`` (type differs), ``drift`` (another
name at that position), ``add`` (new trailing column) or ``create`` (the target
table is missing).
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.types import DEFAULT_EXPORT_TYPE, base_type, map_types_export, map_types_import, type_name

CATALOGUE_SCHEMA = "table_name string, ordinal int, name string, type string"


def column_catalogue(spark: SparkSession, tables: dict[str, Iterable[tuple[str, str]]]) -> DataFrame:
    """Catalogue of described tables: ``{table: [(name, type), ...]}``."""
    rows = [(t, i, n, k) for t, columns in tables.items() for i, (n, k) in enumerate(columns, 1)]
    # An Arrow table becomes a local relation, whose size Spark knows.
    kinds = pa.schema([("table_name", pa.string()), ("ordinal", pa.int32()), ("name", pa.string()), ("type", pa.string())])
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(kinds.names, row)) for row in rows], kinds))


def schema_diff_import(
    source: DataFrame, target: DataFrame, db_type: str = "", exact_decimals: bool = False
) -> DataFrame:
    """Source database columns against warehouse columns; names ignore case."""
    named = source.withColumn("_type_name", type_name("type"))
    wanted = map_types_import("_type_name", db_type, exact_decimals, "type")
    typed = named.withColumn("wanted_type", wanted).drop("_type_name")
    return _diff(
        typed,
        target,
        same_name=F.lower("source_name") == F.lower("target_name"),
        same_type=base_type("wanted_type") == base_type("target_type"),
    )


def schema_diff_export(source: DataFrame, target: DataFrame, text_type: str = DEFAULT_EXPORT_TYPE) -> DataFrame:
    """Warehouse columns against database columns; names must match exactly.

    Text of any kind in the database satisfies the text type.
    """
    wanted = base_type("wanted_type")
    return _diff(
        source.withColumn("wanted_type", map_types_export("type", text_type)),
        target,
        same_name=F.col("source_name") == F.col("target_name"),
        same_type=(wanted == base_type("target_type"))
        | ((F.col("wanted_type") == text_type) & F.col("target_type").rlike("(?i)char|text|clob|string")),
    )


def evolve_add_columns(diff: DataFrame) -> DataFrame:
    """New trailing columns to add; none for a table with any drift."""
    drifted = F.max(F.col("flag") == "drift").over(Window.partitionBy("table_name"))
    added = diff.withColumn("_drifted", drifted).where("flag = 'add' AND NOT _drifted")
    return added.select("table_name", "ordinal", F.col("source_name").alias("name"), F.col("wanted_type").alias("type"))


def alter_statements(diff: DataFrame) -> DataFrame:
    """Statement that adds each new trailing column, also for drifted tables.

    The drift alert shows them; only those of :func:`evolve_add_columns` are to
    be run.
    """
    statement = F.concat(
        F.lit("ALTER TABLE "), "table_name", F.lit(" ADD COLUMNS ("), "source_name", F.lit(" "), "wanted_type", F.lit(")")
    )
    return diff.where("flag = 'add'").select("table_name", "ordinal", statement.alias("statement"))


def schema_drift_report(diff: DataFrame) -> DataFrame:
    """One row per table with new, retyped or drifted columns and what follows."""

    def count(flag: str) -> Column:
        return F.count(F.when(F.col("flag") == flag, 1))

    counted = diff.groupBy("table_name").agg(
        count("add").alias("added"), count("diff").alias("retyped"), count("drift").alias("drifted")
    )
    action = F.when(F.col("drifted") > 0, "no alter: columns out of order").when(F.col("added") > 0, "add columns")
    return counted.where("added + retyped + drifted > 0").withColumn("action", F.coalesce(action, F.lit("report only")))


def common_column_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of the left catalogue that the right one has under the same name."""
    there = right.select("table_name", F.lower("name").alias("_name")).distinct()
    same = (left["table_name"] == there["table_name"]) & (F.lower(left["name"]) == F.col("_name"))
    return left.join(there, same, "left_semi")


def ordinal_schema_join(source: DataFrame, target: DataFrame) -> DataFrame:
    """Each source column beside the target column at the same position.

    Columns only the target has are not looked at, so the source side leads.
    """
    kept = [c for c in source.columns if c not in ("name", "type")]
    left = source.select(*kept, F.col("name").alias("source_name"), F.col("type").alias("source_type"))
    right = target.select("table_name", "ordinal", F.col("name").alias("target_name"), F.col("type").alias("target_type"))
    return left.join(right, ["table_name", "ordinal"], "left")


def missing_sources(registered: DataFrame, source: DataFrame) -> DataFrame:
    """Registered tables of which the source shows no column."""
    return registered.select("table_name").join(source.select("table_name").distinct(), "table_name", "left_anti")


def _diff(source: DataFrame, target: DataFrame, same_name: Column, same_type: Column) -> DataFrame:
    """Pair both catalogues by position in one exchange: side by side, partitioned by table."""
    left = source.select(
        "table_name", "ordinal", F.col("name").alias("source_name"), F.col("type").alias("source_type"), "wanted_type",
        F.lit(None).cast("string").alias("target_name"), F.lit(None).cast("string").alias("target_type"),
    )
    right = target.select(
        "table_name", "ordinal", F.lit(None).cast("string").alias("source_name"),
        F.lit(None).cast("string").alias("source_type"), F.lit(None).cast("string").alias("wanted_type"),
        F.col("name").alias("target_name"), F.col("type").alias("target_type"),
    )
    marked = left.withColumn("_side", F.lit(0)).unionByName(right.withColumn("_side", F.lit(1)))
    table = Window.partitionBy("table_name")
    # A target position holds one column, and its row sorts last.
    place = Window.partitionBy("table_name").orderBy("ordinal").rangeBetween(0, 0)
    paired = marked.select(
        "table_name",
        "ordinal",
        "source_name",
        "source_type",
        "wanted_type",
        F.max("target_name").over(place).alias("target_name"),
        F.max("target_type").over(place).alias("target_type"),
        "_side",
        (F.max("_side").over(table) == 1).alias("_known"),
    ).where("_side = 0")
    flag = (
        F.when(F.col("target_name").isNull(), F.when(F.col("_known"), "add").otherwise("create"))
        .when(~same_name, "drift")
        .when(same_type, "same")
        .otherwise("diff")
    )
    columns = ("table_name", "ordinal", "source_name", "source_type", "wanted_type", "target_name", "target_type")
    return paired.select(*columns, flag.alias("flag"))
