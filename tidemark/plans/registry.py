"""Registry, task plan and run ledger as ordinary tables."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import concat_name, database_part, quoted, same_text
from ..operators.numbering import number_rows
from ..operators.schema import column_catalogue, schema_diff_import
from ..sinks.tables import append_table
from ..sources.jdbc import Connection, count_scan
from ..sources.tables import describe_columns
from .merge import MERGE_TABLES
from .unique import TOMBSTONE_TABLE, WAREHOUSE

logger = logging.getLogger(__name__)

ACTIVE = "1"
# What names a registered table.
KEY = ("connection_id", "db_name", "table_name")
# Tables counted at the same time.
COUNTERS = 4
SUCCEEDED, FAILED, CANCELLED = "SUCCEEDED", "FAILED", "CANCELLED"

# Column layouts of the registry tables. Secrets have no column.
CONNECTIONS = (
    "connection_id string, connection_name string, db_type string, host string, default_db string, port int,"
    " jdbc_extend string, status string"
)
IMPORT_REGISTRY = (
    "id int, connection_id string, db_name string, table_name string, hive_database string, hive_table string,"
    " exec_engine string, is_overwrite string, query_sql string, columns string, filter string, max_value string,"
    " map_column_hive string, hive_partition_key string, hive_partition_value string, fields_terminated_by string,"
    " line_terminated_by string, use_raw_null string, split_by string, m tinyint, last_exec_date string,"
    " task_order int, table_rows int, rows_updatetime string, status string"
)
EXPORT_REGISTRY = (
    "id int, hive_database string, hive_table string, connection_id string, db_name string, table_name string,"
    " columns string, m tinyint, mode string, last_exec_date string, task_order int, table_rows int, status string"
)
LEDGER = "id int, run_date string, started timestamp, ended timestamp, status string"


def registry_scan(connections: DataFrame, registry: DataFrame) -> DataFrame:
    """Every connection with its registry rows, if any."""
    return connections.withColumnRenamed("status", "connection_status").join(registry, "connection_id", "left")


def registry_inner_join(connections: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry rows with their connection."""
    return connections.withColumnRenamed("status", "connection_status").join(registry, "connection_id")


def filter_active(connections: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry rows that are active on an active connection."""
    active = connections.where(F.col("status") == ACTIVE).drop("status")
    return active.join(registry.where(F.col("status") == ACTIVE), "connection_id")


def filter_lookup(registry: DataFrame, connection_id: str, db_name: str, table_name: str) -> DataFrame:
    """The registry row of one table, names in any case; at most one row."""
    return registry.where(
        (F.col("connection_id") == connection_id)
        & same_text("db_name", F.lit(db_name))
        & same_text("table_name", F.lit(table_name))
    ).limit(1)


def distinct_keep_first(df: DataFrame, names: Sequence[str], order: str = "id") -> DataFrame:
    """One row per name, the one that comes first."""
    held = df.withColumn("_first", F.struct(order, *[c for c in df.columns if c != order]))
    return held.groupBy(*names).agg(F.min("_first").alias("_first")).select(*[F.col(f"_first.{c}").alias(c) for c in df.columns])


def task_order(*unique: str) -> list[Column]:
    """Order of the plan: task order, empty ones last, then connection."""
    return [F.col("task_order").asc_nulls_last(), F.col("connection_id").asc(), *[F.col(c).asc() for c in unique]]


def order_task_plan(tasks: DataFrame) -> DataFrame:
    """Tasks sorted for execution."""
    return tasks.orderBy(*task_order("id"))


def order_by_key(df: DataFrame, key: str = "connection_id") -> DataFrame:
    """Rows sorted by one key."""
    return df.orderBy(key)


def reverse_list_order(df: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Last listed first."""
    return df.orderBy(F.col(ordinal).desc())


def number_tasks(tasks: DataFrame) -> DataFrame:
    """Number tasks 1..n in plan order; tombstone tables get 0 to run first."""
    numbered = number_rows(tasks, task_order("id"))
    first = F.lower("table_name") == TOMBSTONE_TABLE
    return numbered.withColumn("no", F.when(first, F.lit(0).cast("bigint")).otherwise(F.col("no")))


def filter_due_today(tasks: DataFrame, today: str | Column) -> DataFrame:
    """Tasks not yet done today."""
    return tasks.where(F.col("last_exec_date").isNull() | (F.col("last_exec_date") != today))


def sync_plan(connections: DataFrame, registry: DataFrame, today: str | Column) -> DataFrame:
    """Active tasks with their number, without those done today.

    Numbers are given before the finished ones go, so they do not shift in
    the course of a day.
    """
    return filter_due_today(number_tasks(filter_active(connections, registry)), today)


def export_plan(connections: DataFrame, registry: DataFrame, today: str | Column) -> DataFrame:
    """As :func:`sync_plan` for exports, which have no tombstone tables."""
    return filter_due_today(number_rows(filter_active(connections, registry), task_order("id")), today)


def filter_redo(connections: DataFrame, registry: DataFrame, connection_ids: Sequence[str]) -> DataFrame:
    """Tables that ran before, on the given connections."""
    chosen = connections.where(F.col("connection_id").isin(*connection_ids)).drop("status")
    return chosen.join(registry.where(F.col("last_exec_date") != ""), "connection_id")


def merge_plan(spark: SparkSession) -> DataFrame:
    """Tables to merge with their number, large ones first."""
    listed = spark.createDataFrame(list(enumerate(MERGE_TABLES, 1)), "ordinal int, table_name string")
    return reverse_list_order(listed.select((F.lit(len(MERGE_TABLES) + 1) - F.col("ordinal")).alias("no"), "table_name", "ordinal"))


def latest_runs(ledger: DataFrame, run_date: str | Column | None = None) -> DataFrame:
    """Last run per task, of one day if given; a run without an end comes before all others.

    A maximum of whole rows, combined on the map side, so one row a task is shuffled.
    """
    if run_date is not None:
        ledger = ledger.where(F.col("run_date") == run_date)
    order = ["ended", "started", "status"]
    rest = [c for c in ledger.columns if c not in (*order, "id")]
    last = ledger.groupBy("id").agg(F.max(F.struct(*order, *rest)).alias("_last"))
    return last.select(*[F.col("id") if c == "id" else F.col(f"_last.{c}") for c in ledger.columns])


def failed_tasks(ledger: DataFrame, run_date: str | Column | None = None) -> DataFrame:
    """Tasks whose last run failed, with the seconds it took."""
    seconds = F.timestamp_diff("SECOND", F.col("started"), F.col("ended"))
    return latest_runs(ledger, run_date).where(F.col("status") == FAILED).withColumn("seconds", seconds)


def sync_ledger(registry: DataFrame, ledger: DataFrame) -> DataFrame:
    """Registry with ``last_exec_date`` brought up to the last success in the ledger."""
    done = ledger.where(F.col("status") == SUCCEEDED).groupBy("id").agg(F.max("run_date").alias("_done"))
    brought = registry.join(done, "id", "left").withColumn("last_exec_date", F.coalesce("_done", "last_exec_date"))
    return brought.select(*registry.columns)


def record_run(spark: SparkSession, ledger_table: str, rows: Iterable[tuple]) -> None:
    """Append finished runs to the ledger table."""
    spark.createDataFrame(list(rows), LEDGER).write.insertInto(ledger_table)


def table_rowcounts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """Row count per table; NULL for a table that cannot be opened or read.

    One scalar a table, several at a time, so that one failure loses no other count.
    """
    if not tables:
        raise ValueError("no table to count")

    def counted(name: str) -> tuple[str, int | None]:
        try:
            return name, None if tables[name] is None else tables[name].count()
        except Exception as error:  # noqa: BLE001 - whatever the reader raises
            logger.warning("%s cannot be counted: %s", name, error)
            return name, None

    with ThreadPoolExecutor(COUNTERS) as pool:
        rows = list(pool.map(counted, tables))
    return SparkSession.active().createDataFrame(rows, "table_name string, table_rows bigint")


# Formats whose files tell their rows, and settings under which a count is taken from there.
FOOTER_FORMATS = ("orc", "parquet")
FOOTER_SETTINGS = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.orc.aggregatePushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def footer_count(spark: SparkSession, table: str) -> DataFrame:
    """One row ``table_rows``; of ORC and Parquet tables from the files' footers, without reading a row.

    Views and tables of other formats are scanned. The settings are those of a
    session of its own, so they touch nothing else.
    """
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect()}
    fmt, place = (about.get("Provider") or "").lower(), about.get("Location")
    if about.get("Type") == "VIEW" or fmt not in FOOTER_FORMATS or not place:
        return spark.table(table).agg(F.count(F.lit(1)).alias("table_rows"))
    own = spark.newSession()
    for key, value in FOOTER_SETTINGS.items():
        own.conf.set(key, value)
    return own.read.format(fmt).load(place).agg(F.count("*").alias("table_rows"))


def warehouse_rowcounts(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Row count per warehouse table by :func:`footer_count`; NULL for one that cannot be opened or read."""

    def counted(name: str) -> tuple[str, int | None]:
        try:
            return name, footer_count(spark, name).first()["table_rows"]
        except Exception as error:  # noqa: BLE001 - whatever the reader raises
            logger.warning("%s cannot be counted: %s", name, error)
            return name, None

    with ThreadPoolExecutor(COUNTERS) as pool:
        rows = list(pool.map(counted, names))
    return spark.createDataFrame(rows, "table_name string, table_rows bigint")


def source_rowcounts(spark: SparkSession, connection: Connection, tables: Iterable[str]) -> DataFrame:
    """Row count per table of a database, which does the counting, as :func:`store_rowcounts` takes it.

    NULL for a table that the database does not let us read.
    """
    opened = {}
    for table in tables:
        try:
            opened[table] = count_scan(spark, connection, table)
        except Exception as error:  # noqa: BLE001 - whatever the driver raises
            logger.warning("%s.%s cannot be counted: %s", connection.database, table, error)
            opened[table] = None

    def counted(table: str) -> tuple:
        try:
            rows = None if opened[table] is None else opened[table].first()["table_rows"]
        except Exception as error:  # noqa: BLE001
            logger.warning("%s.%s cannot be counted: %s", connection.database, table, error)
            rows = None
        return connection.connection_id, connection.database, table, rows

    with ThreadPoolExecutor(COUNTERS) as pool:
        rows = list(pool.map(counted, opened))
    return spark.createDataFrame(rows, "connection_id string, db_name string, table_name string, table_rows bigint")


def open_tables(spark: SparkSession, names: Iterable[str]) -> dict[str, DataFrame | None]:
    """Lazy table per name; None where it cannot be resolved."""
    opened: dict[str, DataFrame | None] = {}
    for name in names:
        try:
            opened[name] = spark.table(name)
        except AnalysisException:
            opened[name] = None
    return opened


def store_rowcounts(registry: DataFrame, counts: DataFrame, at: Column | None = None) -> DataFrame:
    """Registry with fresh row counts; a failed count keeps the old values.

    ``counts`` holds ``connection_id, db_name, table_name, table_rows``, a table
    once; a table that is counted twice is an error.
    """
    fresh = counts.where(F.col("table_rows").isNotNull()).groupBy(*KEY)
    fresh = fresh.agg(F.max("table_rows").alias("_rows"), F.count("*").alias("_times"))
    twice = F.raise_error(F.concat(F.lit("counted twice: "), F.concat_ws(".", *KEY)))
    fresh = fresh.select(*KEY, F.when(F.col("_times") > 1, twice.cast("bigint")).otherwise(F.col("_rows")).alias("_rows"))
    at = (F.current_timestamp() if at is None else at).cast("string")
    joined = registry.join(fresh, list(KEY), "left")
    return joined.withColumns(
        {
            "rows_updatetime": F.when(F.col("_rows").isNotNull(), at).otherwise(F.col("rows_updatetime")),
            "table_rows": F.coalesce("_rows", "table_rows"),
        }
    ).select(*registry.columns)


def seed_registry(
    tables: DataFrame,
    connection_id: str | Column,
    db_name: str | Column,
    target_db: str | Column | None = None,
    warehouse: str = WAREHOUSE,
    exec_engine: str | None = None,
) -> DataFrame:
    """Inactive registry rows for the tables of a source database; with their engine if one is named."""
    engine = [] if exec_engine is None else [F.lit(exec_engine).alias("exec_engine")]
    db_name = F.lit(db_name)
    return tables.select(
        F.lit(connection_id).alias("connection_id"),
        db_name.alias("db_name"),
        "table_name",
        F.lit(warehouse).alias("hive_database"),
        concat_name(db_name if target_db is None else F.lit(target_db), F.col("table_name")).alias("hive_table"),
        *engine,
        F.lit("1").alias("is_overwrite"),
        F.lit("0").alias("status"),
    )


def register_tables(seeded: DataFrame, registry_table: str) -> None:
    """Append seeded rows to the registry table with the next free ids.

    A table that is registered already is an error, and so is a source without
    tables; nothing is appended then.
    """
    if seeded.isEmpty():
        raise ValueError("the source has no tables to register")
    registry = seeded.sparkSession.table(registry_table)
    keys = list(KEY)
    again = seeded.select(*keys).join(registry, keys, "left_semi").limit(3).collect()
    if again:
        raise ValueError(f"registered already: {[tuple(row) for row in again]}")
    top = registry.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).first()["top"]
    numbered = number_rows(seeded, [F.col(k).asc() for k in keys], "id")
    append_table(numbered.withColumn("id", F.col("id") + top), registry_table)


def distinct_db_map(registry: DataFrame) -> DataFrame:
    """Source database names and the names they go by in the warehouse."""
    return registry.select("db_name", database_part("hive_table").alias("hive_db_name")).distinct()


def check_schemas(
    registry: DataFrame, source: DataFrame, target: DataFrame, db_type: str = "", exact_decimals: bool = False
) -> DataFrame:
    """Schema findings for all registered tables at once.

    ``source`` is a column catalogue with ``connection_id`` and ``db_name``
    besides, as ``source_catalogue`` delivers it, ``target`` one whose tables
    are named ``<hive_database>.<hive_table>``. Feed the result to
    ``schema_drift_report``.
    """
    registered = registry.select(
        F.col("connection_id").alias("_connection"),
        F.lower("db_name").alias("_db"),
        F.lower("table_name").alias("_table"),
        F.lower(F.concat_ws(".", "hive_database", "hive_table")).alias("_target"),
    )
    same = (
        (F.col("connection_id") == F.col("_connection"))
        & (F.lower("db_name") == F.col("_db"))
        & (F.lower("table_name") == F.col("_table"))
    )
    renamed = source.join(registered, same).select(F.col("_target").alias("table_name"), "ordinal", "name", "type")
    return schema_diff_import(renamed, target.withColumn("table_name", F.lower("table_name")), db_type, exact_decimals)


def warehouse_catalogue(spark: SparkSession, registry: DataFrame) -> DataFrame:
    """Column catalogue of the registered warehouse tables.

    Descriptions come from the catalog, one table at a time, so this is for
    registries of hundreds of tables.
    """
    named = registry.select(F.lower(F.concat_ws(".", "hive_database", "hive_table")).alias("name")).distinct()
    return column_catalogue(spark, {r["name"]: describe_columns(spark, r["name"]) for r in named.collect()})
