"""Import of one table: compare schemas, prepare the target, load, deduplicate."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day_string, partition_value
from ..functions.names import same_text, split_name
from ..functions.text import drop_delims, on_strings, sanitize_text
from ..functions.types import cast_columns, described, parse_overrides, wanted_types
from ..operators.projections import project_listed
from ..operators.schema import column_catalogue, evolve_add_columns, schema_diff_import
from ..session import ensure_checkpoint_dir
from ..sinks import tables as sink
from ..sinks.text import clean_delimited, delimiter, table_options
from ..sources.jdbc import DEFAULT_READERS, Connection, jdbc_scan, jdbc_split, source_catalogue, spread_scan
from ..sources.marks import Mark, read_composite_mark, unseen
from ..sources.splits import even_scan
from ..sources.tables import describe_columns, fill_filter, read_mark, table_exists
from .registry import filter_lookup, registry_scan
from .unique import UniqueRule, current_name, is_incremental, unique_dispatch, unique_table

NO_FILTER = "1=1"
# What becomes of line breaks in text: dropped as the bulk loader does, turned
# into spaces as the copying engine does, or kept.
TEXT_POLICIES = {"drop": drop_delims, "space": sanitize_text, "keep": None}
# The registry's engines and their text policy.
ENGINE_POLICIES = {"sqoop": "drop", "datax": "space"}


@dataclass(frozen=True)
class ImportTask:
    """The columns of an import registry row that drive a load."""

    db_name: str
    table_name: str
    hive_database: str
    hive_table: str
    is_overwrite: str = "0"
    query_sql: str | None = None
    columns: str | None = None
    filter: str | None = None
    max_value: str | None = None
    map_column_hive: str | None = None
    hive_partition_key: str | None = None
    hive_partition_value: str | None = None
    split_by: str | None = None
    m: int | None = None
    exec_engine: str | None = None
    fields_terminated_by: str | None = None
    line_terminated_by: str | None = None
    use_raw_null: str | None = None
    # How far an incremental load goes back behind its mark, and the columns that tell its rows apart.
    overlap: str | None = None
    seen_by: str | None = None

    @classmethod
    def from_row(cls, row: Row) -> ImportTask:
        """Take the known columns of a registry row."""
        known = row.asDict()
        return cls(**{f.name: known[f.name] for f in fields(cls) if f.name in known})

    @property
    def text_policy(self) -> str:
        """Policy of the task's engine; text is kept where no engine is named."""
        return ENGINE_POLICIES.get((self.exec_engine or "").strip().lower(), "keep")

    @property
    def target(self) -> str:
        return f"{self.hive_database}.{self.hive_table}".lower()

    @property
    def incremental(self) -> bool:
        return _filled(self.filter) and _filled(self.max_value)

    @property
    def delimited(self) -> dict[str, str] | None:
        """Options of the target's text files; None without a field or line mark, which leaves the warehouse's format."""
        field_mark, line = delimiter(self.fields_terminated_by), delimiter(self.line_terminated_by)
        if not field_mark and not line:
            return None
        return table_options(field_mark, line, str(self.use_raw_null or "0").strip() == "1")

    @property
    def stamp(self) -> str | None:
        """The column whose maximum is the mark, as in ``max(updatestamp)``."""
        marked = re.search(r"(\w+)\W*$", self.max_value or "")
        return marked[1].lower() if marked else None

    @property
    def partition(self) -> str | None:
        has_both = _filled(self.hive_partition_key) and _filled(self.hive_partition_value)
        return self.hive_partition_key if has_both else None


def jdbc_source(
    spark: SparkSession, connection: Connection, task: ImportTask, spread: bool = False, even: bool = False
) -> Callable[[str], DataFrame]:
    """Scan of the task's table or query for :func:`import_table`.

    With a split column the read runs in ``m`` ranges between the bounds that
    the database reports, or, ``spread``, by the remainder of a whole-number
    key, which holds for skewed ones too, or, ``even``, in ranges of equal row
    counts, which the database counts first. A query overrides table and filter. Several readers
    without a split column are refused, as one task would read everything.
    """
    if (task.m or 1) > 1 and not _filled(task.split_by):
        raise ValueError(f"{task.db_name}.{task.table_name}: {task.m} readers need a split column")

    def scan(where: str) -> DataFrame:
        what = {"table": task.table_name, "query": task.query_sql if _filled(task.query_sql) else None, "where": where}
        split = None
        if _filled(task.split_by) and even:
            return even_scan(spark, connection, task.split_by, task.m or DEFAULT_READERS, **what)
        if _filled(task.split_by) and spread:
            return spread_scan(spark, connection, task.split_by, task.m or DEFAULT_READERS, **what)
        if _filled(task.split_by):
            split = jdbc_split(spark, connection, task.split_by, task.m or DEFAULT_READERS, **what)
        return jdbc_scan(spark, connection, split=split, **what)

    return scan


def import_filter(
    spark: SparkSession, task: ImportTask, start: object = 0, source_columns: Iterable[tuple[str, str]] = ()
) -> str:
    """Filter text for this run: newer rows for an incremental task, else all.

    A first load, with no target yet, takes everything. So does a task with its
    own query, which says itself what to read. The marked column's source type
    says where an empty target starts. With an overlap the filter's
    ``{max_value}`` is the mark less the overlap, so the filter should use ``>=``.
    """
    if not task.incremental or _filled(task.query_sql) or not table_exists(spark, task.target):
        return NO_FILTER
    mark = _overlap_mark(spark, task)
    if mark is not None:
        return fill_filter(task.filter, mark.low)
    kinds = {name.lower(): kind for name, kind in source_columns}
    kind = kinds.get(task.stamp, "")
    return fill_filter(task.filter, read_mark(spark, task.target, task.max_value, start, kind))


def _overlap_mark(spark: SparkSession, task: ImportTask) -> Mark | None:
    """The mark of a task with an overlap; None without one, or if the target holds no stamp."""
    if not _filled(task.overlap) or not task.incremental or not table_exists(spark, task.target):
        return None
    return read_composite_mark(spark.table(task.target), task.stamp, (), task.overlap)


def _without_seen(spark: SparkSession, task: ImportTask, rows: DataFrame, mark: Mark, value: str, overwrite: bool) -> DataFrame:
    """Rows that the target lacks in the window of an overlapping load.

    A partition that the load replaces counts as empty, and the rows are fixed
    before it goes.
    """
    held = spark.table(task.target).where(F.col(task.stamp) >= F.lit(mark.low))
    if task.partition and overwrite:
        held = held.where(~F.col(task.partition).eqNullSafe(F.lit(value)))
    by = [c.strip().lower() for c in task.seen_by.split(",")] if _filled(task.seen_by) else []
    by = [c for c in by if c != task.stamp] + [task.stamp] if by else [c.lower() for c in rows.columns]
    new = unseen(rows.toDF(*[c.lower() for c in rows.columns]), held.select(*by), by)
    if overwrite:
        ensure_checkpoint_dir(spark)
        new = new.checkpoint()
    return new


def prepare_target(
    spark: SparkSession,
    task: ImportTask,
    source_columns: list[tuple[str, str]],
    exact_decimals: bool = False,
    db_type: str = "",
) -> DataFrame:
    """Create the target or add its new columns; returns the schema findings.

    No column is added when any position drifted, nor for a task with its own
    query or column list.
    """
    if not source_columns:
        raise ValueError(f"{task.db_name}.{task.table_name} does not exist")
    overrides = parse_overrides(task.map_column_hive)
    diff = schema_diff_import(
        column_catalogue(spark, {task.target: source_columns}),
        column_catalogue(spark, {task.target: describe_columns(spark, task.target)}),
        db_type,
        exact_decimals,
    )
    if not table_exists(spark, task.target):
        wanted = wanted_types(source_columns, overrides, exact_decimals, db_type)
        fmt = "csv" if task.delimited else sink.WAREHOUSE_FORMAT
        sink.create_table(spark, task.target, wanted, task.partition, fmt, task.delimited)
    elif not _filled(task.query_sql) and not _filled(task.columns):
        added = evolve_add_columns(diff).orderBy("ordinal").collect()
        sink.add_columns(spark, task.target, [(r["name"], overrides.get(r["name"].lower()) or r["type"]) for r in added])
    return diff


def import_table(
    spark: SparkSession,
    task: ImportTask,
    scan: Callable[[str], DataFrame],
    source_columns: list[tuple[str, str]] | None = None,
    day: dt.date | None = None,
    start: object = 0,
    unique: bool = True,
    exact_decimals: bool = False,
    etl_time: Column | None = None,
    db_type: str = "",
    text_policy: str | None = None,
    replace: Callable[[DataFrame, str], object] = sink.ctas_replace,
) -> DataFrame:
    """Run one import and, unless told not to, rebuild the current table.

    ``scan`` takes the filter text and returns the lazy source: for a database
    :func:`jdbc_source`, for any DataFrame its ``where``. The column descriptors
    default to the scan's schema. The warehouse types are decided once, from the
    descriptors, for the target, the rows and the comparison. What can be
    refused is refused before the first write; that a snapshot's partition holds
    no rows shows after it, and then a current table with rows is not replaced.

    A task with field or line marks is stored as text with them. A task with an
    overlap reads again behind its mark and leaves out what the target has, so
    rows that were committed late are neither lost nor doubled. ``replace``
    says how the current table is replaced, by
    :func:`versions.replace_versioned` without a moment in which it is missing.
    Returns the schema findings.
    """
    day = day or dt.date.today()
    overwrite = str(task.is_overwrite) == "1"
    if overwrite and task.incremental and not task.partition and not _filled(task.query_sql):
        raise ValueError(f"{task.target}: an incremental load that overwrites would keep the last increment only")
    clean = TEXT_POLICIES[text_policy or task.text_policy]
    rule = checked_rule(spark, task.target, task.incremental) if unique else None
    if source_columns is None:
        source_columns = described(scan(NO_FILTER))
    mark = _overlap_mark(spark, task)
    source = scan(import_filter(spark, task, start, source_columns))
    if _filled(task.columns) and not _filled(task.query_sql):
        source = project_listed(source, task.columns.split(","))
    kept = {c.lower() for c in source.columns}
    source_columns = [(n, t) for n, t in source_columns if n.lower() in kept]
    if _filled(task.query_sql):
        by_name = {n.lower(): (n, t) for n, t in source_columns}
        source_columns = [by_name.get(n.lower(), (n, t)) for n, t in described(source)]
    diff = prepare_target(spark, task, source_columns, exact_decimals, db_type)
    overrides = parse_overrides(task.map_column_hive)
    rows = cast_columns(source, wanted_types(source_columns, overrides, exact_decimals, db_type))
    if clean:
        rows = on_strings(rows, clean)
    if task.delimited:
        rows = clean_delimited(rows, delimiter(task.line_terminated_by))
    value = partition_value(task.hive_partition_value, day)
    if mark is not None and not _filled(task.query_sql):
        rows = _without_seen(spark, task, rows, mark, value, overwrite)
    if task.partition:
        sink.overwrite_partition(rows, task.target, task.partition, value, append=not overwrite)
    elif overwrite:
        sink.overwrite_table(rows, task.target)
    else:
        sink.append_table(rows, task.target)
    if rule:
        _rebuild(spark, task.target, rule, task.partition, value, etl_time, replace)
    return diff


def checked_rule(spark: SparkSession, table: str, incremental: bool) -> UniqueRule:
    """The rule of ``<db>.src_<t>``; unknown names and a missing tombstone table are refused."""
    rule = unique_dispatch(table, incremental, warehouse=split_name(table)[0])
    if rule.tombstone_table and not table_exists(spark, rule.tombstone_table):
        raise ValueError(f"{table} needs {rule.tombstone_table}, which does not exist")
    return rule


def refresh_current(spark: SparkSession, task: ImportTask, day: dt.date, etl_time: Column | None = None) -> str | None:
    """Rebuild the current table of an imported one; returns its name."""
    rule = checked_rule(spark, task.target, task.incremental)
    value = partition_value(task.hive_partition_value, day)
    return _rebuild(spark, task.target, rule, task.partition, value, etl_time)


def refresh_table(
    spark: SparkSession,
    table: str,
    incremental: bool,
    partition_key: str | None = None,
    day: dt.date | None = None,
    etl_time: Column | None = None,
) -> str | None:
    """Rebuild the current table of ``<db>.src_<t>``; None if it is to be skipped.

    A table copied as it is takes yesterday's partition when it has a key; if
    that holds no rows, a current table with rows is not replaced.
    """
    rule = checked_rule(spark, table, incremental)
    yesterday = day_string(day or dt.date.today(), back=1)
    return _rebuild(spark, table, rule, partition_key, yesterday, etl_time)


def _rebuild(
    spark: SparkSession,
    table: str,
    rule: UniqueRule,
    partition_key: str | None,
    value: str | None,
    etl_time: Column | None,
    replace: Callable[[DataFrame, str], object] = sink.ctas_replace,
) -> str | None:
    """Replace the current table; a snapshot of a partition without rows does not replace one that has some."""
    if rule.strategy == "snapshot" and partition_key and table_exists(spark, current_name(table)):
        nothing = spark.table(table).where(F.col(partition_key) == value).isEmpty()
        if nothing and not spark.table(current_name(table)).isEmpty():
            raise ValueError(f"{table} has no rows of {partition_key}={value}; {current_name(table)} stays")
    tombstones = spark.table(rule.tombstone_table) if rule.tombstone_table else None
    current = unique_table(spark.table(table), rule, tombstones, partition_key, value, etl_time)
    if current is None:
        return None
    replace(current, current_name(table))
    return current_name(table)


def registered_incremental(registry: DataFrame, table: str) -> bool:
    """Whether the registry marks a warehouse table as incremental."""
    database, name = split_name(table)
    row = registry.where(same_text("hive_database", F.lit(database)) & same_text("hive_table", F.lit(name)))
    return not row.limit(1).where(is_incremental()).isEmpty()


def registered_task(connections: DataFrame, registry: DataFrame, connection_name: str, db_name: str, table_name: str) -> Row:
    """The registry row of a table with its connection; unknown names are refused."""
    known = connections.where(F.col("connection_name") == connection_name)
    found = known.first()
    if found is None:
        raise ValueError(f"no connection is named {connection_name!r}")
    row = filter_lookup(registry_scan(known, registry), found["connection_id"], db_name, table_name).first()
    if row is None:
        raise ValueError(f"{db_name}.{table_name} is not registered on {connection_name!r}")
    return row


def import_registered(
    spark: SparkSession,
    connections: DataFrame,
    registry: DataFrame,
    connection_name: str,
    db_name: str,
    table_name: str,
    day: dt.date | None = None,
    start: object = 0,
    exact_decimals: bool = False,
) -> DataFrame:
    """Import one registered table from its database."""
    row = registered_task(connections, registry, connection_name, db_name, table_name)
    connection, task = Connection.from_row(row), ImportTask.from_row(row)
    described = source_catalogue(spark, connection, [task.table_name]).orderBy("ordinal").collect()
    columns = [(r["name"], r["type"]) for r in described]
    return import_table(
        spark, task, jdbc_source(spark, connection, task), columns, day, start,
        exact_decimals=exact_decimals, db_type=connection.db_type,
    )


def _filled(text: str | None) -> bool:
    return text is not None and text.strip() != ""
