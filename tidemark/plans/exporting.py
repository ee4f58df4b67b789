"""Export of one table: compare schemas, load by mode, drop old backups."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, Row, SparkSession

from ..functions.dates import day_string
from ..functions.types import DEFAULT_EXPORT_TYPE
from ..operators.schema import column_catalogue, evolve_add_columns, schema_diff_export
from ..sinks import export as sink
from ..sinks import tables
from ..sinks.batches import Database, Inserted, insert_once
from ..sources.tables import describe_columns
from .importing import registered_task

MODES = ("rename", "overwrite", "append")


@dataclass(frozen=True)
class Exported:
    """What an export did: rows loaded, and the findings on the target's columns."""

    rows: int
    findings: DataFrame


@dataclass(frozen=True)
class ExportTask:
    """The columns of an export registry row that drive a load."""

    hive_database: str
    hive_table: str
    db_name: str
    table_name: str
    mode: str | None = None
    m: int | None = None
    text_type: str = DEFAULT_EXPORT_TYPE

    @classmethod
    def from_row(cls, row: Row) -> ExportTask:
        """Take the known columns of a registry row."""
        known = row.asDict()
        return cls(**{f.name: known[f.name] for f in fields(cls) if f.name in known})

    def run(self, spark: SparkSession, catalog: str, day: dt.date | None = None) -> Exported:
        """Export to the catalog that the connection is mounted as; ``rename`` by default."""
        source = f"{self.hive_database}.{self.hive_table}".lower()
        target = f"{catalog}.{self.db_name}.{self.table_name}"
        return export_table(spark, source, target, (self.mode or "").strip() or MODES[0], self.m or sink.DEFAULT_WRITERS, day, self.text_type)


def prepare_export(
    spark: SparkSession, df: DataFrame, target: str, text_type: str = DEFAULT_EXPORT_TYPE
) -> DataFrame:
    """Create the target or add its missing columns; returns the findings."""
    diff = schema_diff_export(
        column_catalogue(spark, {target: df.dtypes}),
        column_catalogue(spark, {target: describe_columns(spark, target)}),
        text_type,
    )
    if not sink.ensure_target(spark, df, target, text_type):
        added = evolve_add_columns(diff).orderBy("ordinal").collect()
        tables.add_columns(spark, target, [(r["name"], r["type"]) for r in added])
    return diff


def export_table(
    spark: SparkSession,
    source: str,
    target: str,
    mode: str = "rename",
    writers: int | None = sink.DEFAULT_WRITERS,
    day: dt.date | None = None,
    text_type: str = DEFAULT_EXPORT_TYPE,
) -> Exported:
    """Export a warehouse table to ``catalog.database.table``: rows loaded and schema findings."""
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is not one of {MODES}")
    day = day or dt.date.today()
    today, yesterday = day_string(day), day_string(day, back=1)
    df = spark.table(source)
    findings = prepare_export(spark, df, target, text_type)
    if mode == "append":
        loaded = sink.export_append(df, target, writers)
    elif mode == "overwrite":
        loaded = sink.export_overwrite(df, target, writers)
    else:
        loaded = sink.export_rename(df, target, today, yesterday, writers)
        sink.backup_retention(spark, target, yesterday)
    return Exported(loaded, findings)


def export_once(
    spark: SparkSession,
    source: str,
    database: Database,
    table: str,
    day: dt.date | None = None,
    writers: int = sink.DEFAULT_WRITERS,
    batches: int | None = None,
) -> Inserted:
    """Append a warehouse table to a table of a database, each row once however often tasks or the call run again.

    The load is named by source and day: a second call of the day inserts what
    is missing of the first, so the source must not change in between. The
    target is there already, with columns of the source's names.
    """
    load_id = f"{source}@{day_string(day or dt.date.today())}"
    return insert_once(spark.table(source), database, table, load_id, writers, batches)


def export_registered(
    spark: SparkSession,
    connections: DataFrame,
    registry: DataFrame,
    connection_name: str,
    db_name: str,
    table_name: str,
    catalog: str,
    day: dt.date | None = None,
) -> Exported:
    """Export one registered table to the catalog that its connection is mounted as."""
    row = registered_task(connections, registry, connection_name, db_name, table_name)
    return ExportTask.from_row(row).run(spark, catalog, day)
