"""Loading warehouse rows into a relational target.

Targets are named ``catalog.database.table``. A database is reached through a
JDBC catalog (see ``sources.jdbc.catalog_options``), and the same statements
work on a warehouse catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.types import DEFAULT_EXPORT_TYPE, export_type
from ..sources.tables import describe_columns, list_source_tables, table_exists
from . import tables


# Connections that an export opens unless told otherwise.
DEFAULT_WRITERS = 8


def export_create_target(
    spark: SparkSession, df: DataFrame, target: str, text_type: str = DEFAULT_EXPORT_TYPE
) -> None:
    """Create a missing target from the warehouse schema; what has no type of its own becomes ``text_type``."""
    columns = [(name, export_type(kind, text_type)) for name, kind in df.dtypes]
    tables.create_table(spark, target, columns, fmt=None)


def create_target_like(spark: SparkSession, table: str, like: str) -> None:
    """Create an empty table with the columns of another; keys and indexes are not copied."""
    tables.create_table(spark, table, describe_columns(spark, like), fmt=None)


def jdbc_export_insert(
    df: DataFrame, target: str, writers: int | None = DEFAULT_WRITERS, overwrite: bool = False
) -> None:
    """Insert rows, matched by name, over at most ``writers`` connections.

    With None every task writes; the JDBC catalog's ``numPartitions`` then
    protects the database. ``coalesce`` keeps the read and the insert in the
    same tasks, without a shuffle.
    """
    rows = df.coalesce(writers) if writers else df
    if overwrite:
        tables.overwrite_table(rows, target)
    else:
        tables.append_table(rows, target)


def load_checked(
    df: DataFrame, target: str, writers: int | None = DEFAULT_WRITERS, overwrite: bool = False, own: bool = False
) -> int:
    """Insert and return the rows sent, which are counted on their way.

    A database insert is not atomic over tasks: one that is lost after its
    commit runs again and inserts twice. An ``own`` target, which no one else
    writes, is counted afterwards, so that this shows up as an error.
    """
    sent = Observation()
    jdbc_export_insert(df.observe(sent, F.count(F.lit(1)).alias("rows")), target, writers, overwrite)
    rows = sent.get["rows"]
    if own:
        arrived = df.sparkSession.table(target).count()
        if arrived != rows:
            raise RuntimeError(f"{target}: {rows} rows sent, {arrived} rows arrived")
    return rows


def export_append(df: DataFrame, target: str, writers: int | None = DEFAULT_WRITERS) -> int:
    """Mode ``append``: insert only."""
    return load_checked(df, target, writers)


def export_overwrite(df: DataFrame, target: str, writers: int | None = DEFAULT_WRITERS) -> int:
    """Mode ``overwrite``: truncate, then insert; the definition stays."""
    return load_checked(df, target, writers, overwrite=True)


def export_rename(
    df: DataFrame,
    target: str,
    today: str,
    yesterday: str,
    writers: int | None = DEFAULT_WRITERS,
    staging_like: str | None = None,
) -> int:
    """Mode ``rename``: load ``t_<today>``, then swap, keeping ``t_<yesterday>_bak``.

    The loaded table has the target's columns, but not its keys and indexes,
    which a catalog does not show. A caller that needs them prepares the
    staging table in the database and names it as ``staging_like``; it must be
    ``t_<today>`` and empty.

    The two renames are separate statements. If the second fails, the first is
    undone and the error passed on.
    """
    spark = df.sparkSession
    staging, backup = f"{target}_{today}", f"{target}_{yesterday}_bak"
    if staging_like is None:
        tables.drop_table(spark, staging)
        create_target_like(spark, staging, target)
    elif staging_like != staging or not spark.table(staging).isEmpty():
        raise ValueError(f"{staging_like} is not the empty table {staging}")
    loaded = load_checked(df, staging, writers, own=True)
    tables.drop_table(spark, backup)
    tables.rename_table(spark, target, backup)
    try:
        tables.rename_table(spark, staging, target)
    except Exception:
        tables.rename_table(spark, backup, target)
        raise
    return loaded


def expired_backups(names: DataFrame, table: str, cutoff: str, column: str = "table_name") -> DataFrame:
    """Backups of one table that are older than the cut-off day.

    Only ``<table>_<yyyyMMdd>_bak`` with a real date counts, so neither a table
    with a longer name nor its backups are touched.
    """
    listed = names.where(F.col(column).startswith(f"{table}_"))
    day = F.substring(column, len(table) + 2, 8)
    shape = F.col(column) == F.concat(F.lit(f"{table}_"), day, F.lit("_bak"))
    return listed.where(shape & parse_date(day).isNotNull() & (day < cutoff))


def backup_retention(spark: SparkSession, target: str, cutoff: str) -> list[str]:
    """Drop the expired backups of a target; returns what was dropped."""
    *namespace, table = target.split(".")
    listed = list_source_tables(spark, ".".join(namespace))
    dropped = [row["table_name"] for row in expired_backups(listed, table, cutoff).collect()]
    for name in dropped:
        tables.drop_table(spark, ".".join([*namespace, name]))
    return dropped


def ensure_target(spark: SparkSession, df: DataFrame, target: str, text_type: str = DEFAULT_EXPORT_TYPE) -> bool:
    """Create the target if missing; True when it was created."""
    if table_exists(spark, target):
        return False
    export_create_target(spark, df, target, text_type)
    return True
