"""Writes and DDL on warehouse tables of any Spark catalog."""

from __future__ import annotations

import threading
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import quoted

WAREHOUSE_FORMAT = "orc"


def ctas_replace(
    df: DataFrame,
    table: str,
    fmt: str = WAREHOUSE_FORMAT,
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Replace a table by a query result, swapping only after a whole write.

    The rows go to ``<table>__incoming`` first, so a lost job leaves the old
    table alone and a query may read the table it replaces. The old table is
    kept as ``<table>__previous`` during the swap and put back by the next call
    if the program ended in between. The swap renames managed tables, which on
    HDFS moves no data. ``bucket_by`` stores the rows bucketed and
    sorted for later joins on those columns.
    """
    spark = df.sparkSession
    incoming, previous = f"{table}__incoming", f"{table}__previous"
    if spark.catalog.tableExists(previous):
        if spark.catalog.tableExists(table):
            drop_table(spark, previous)
        else:
            rename_table(spark, previous, table)
    drop_table(spark, incoming)
    writer = df.write.format(fmt)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(incoming)
    if spark.catalog.tableExists(table):
        rename_table(spark, table, previous)
    rename_table(spark, incoming, table)
    drop_table(spark, previous)


def ctas_passthrough(spark: SparkSession, source: str, target: str) -> None:
    """Copy a table unchanged."""
    ctas_replace(spark.table(source), target)


def create_table(
    spark: SparkSession,
    table: str,
    columns: Iterable[tuple[str, str]],
    partition_key: str | None = None,
    fmt: str | None = WAREHOUSE_FORMAT,
    options: dict[str, str] | None = None,
) -> None:
    """Create a table if missing, names in lower case, one optional string partition.

    ``fmt=None`` leaves the format to the catalog, as a database needs;
    ``options`` are those of the format.
    """
    body = ", ".join(f"`{name.lower()}` {kind}" for name, kind in columns)
    using = f" USING {fmt}" if fmt else ""
    if options:
        using += f" OPTIONS ({', '.join(f'{_text(key)} {_text(value)}' for key, value in options.items())})"
    if partition_key:
        body += f", `{partition_key.lower()}` string"
        using += f" PARTITIONED BY (`{partition_key.lower()}`)"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({body}){using}")


def add_columns(spark: SparkSession, table: str, columns: Iterable[tuple[str, str]]) -> None:
    """Append columns to a table; rows already there read NULL."""
    body = ", ".join(f"`{name.lower()}` {kind}" for name, kind in columns)
    if body:
        spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({body})")


def match_columns(df: DataFrame, table: str, without: Iterable[str] = ()) -> DataFrame:
    """Order and cast columns by name to fit a table; absent ones become NULL."""
    here = {c.lower(): c for c in df.columns}
    skip = {c.lower() for c in without}
    fields = [f for f in df.sparkSession.table(table).schema.fields if f.name.lower() not in skip]
    unknown = set(here) - {f.name.lower() for f in fields} - skip
    if unknown:
        raise ValueError(f"{table} has no column {sorted(unknown)}")
    return df.select(
        *[
            (F.col(f"`{here[f.name.lower()]}`") if f.name.lower() in here else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in fields
        ]
    )


def append_table(df: DataFrame, table: str) -> None:
    """Append rows, matched by column name."""
    match_columns(df, table).write.insertInto(table, overwrite=False)


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace all rows, of every partition, and keep the table's definition."""
    spark = df.sparkSession
    rows = match_columns(df, table)
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        with _session_setting(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
            rows.write.insertInto(table, overwrite=True)
    else:
        rows.write.insertInto(table, overwrite=True)


def overwrite_partition(df: DataFrame, table: str, key: str, value: str, append: bool = False) -> None:
    """Replace (or append to) one partition; an empty load empties it.

    The partition is named in the statement, so no other one is touched and
    its rows need no shuffle.
    """
    rows = match_columns(df, table, without=[key])
    verb = "INTO" if append else "OVERWRITE"
    place = _partition(key, value).replace("{", "{{").replace("}", "}}")
    df.sparkSession.sql(f"INSERT {verb} TABLE {quoted(table)} {place} SELECT * FROM {{rows}}", rows=rows)


def overwrite_partitions(df: DataFrame, table: str, key: str, append: bool = False) -> None:
    """Replace (or append to) every partition that occurs in the rows; others stay.

    The rebalance hint gathers a partition's rows into files of a fair size
    and lets AQE split a partition that is too large for one task.
    """
    rows = match_columns(df, table).hint("rebalance", key)
    with _session_setting(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rows.write.insertInto(table, overwrite=not append)


def drop_partition(spark: SparkSession, table: str, key: str, value: str) -> None:
    """Drop one partition with its rows, if there."""
    spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS {_partition(key, value)}")


def add_partition(spark: SparkSession, table: str, key: str, value: str) -> None:
    """Register one partition, if not there."""
    spark.sql(f"ALTER TABLE {quoted(table)} ADD IF NOT EXISTS {_partition(key, value)}")


def truncate_table(spark: SparkSession, table: str) -> None:
    """Remove all rows."""
    spark.sql(f"TRUNCATE TABLE {quoted(table)}")


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table, if there."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")


def rename_table(spark: SparkSession, table: str, new_name: str) -> None:
    """Rename within a catalog; the new name is given in full as well."""
    target = new_name.split(".")[-2:]
    spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted('.'.join(target))}")


# Two loads in threads of one session would see each other's setting.
_SETTING = threading.RLock()


@contextmanager
def _session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    # insertInto takes this from the session only; a writer option is ignored.
    with _SETTING:
        before = spark.conf.get(key)
        spark.conf.set(key, value)
        try:
            yield
        finally:
            spark.conf.set(key, before)


def _partition(key: str, value: str) -> str:
    return f"PARTITION (`{key}` = {_text(value)})"


def _text(value: str) -> str:
    """A string literal of a statement."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r")
    return f"'{escaped}'"
