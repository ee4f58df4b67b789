"""Tables that are replaced without a moment in which they are missing.

Every content lies in a folder of its own; the catalogue's location of the table
is the pointer to the one that counts. A replacement writes a new folder, then
moves the pointer, which is one change of one entry. Readers that have planned
before go on with the old folder, which stays until newer ones push it out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import quoted, split_name
from ..session import remove_folder
from ..sources.tables import table_exists
from .tables import WAREHOUSE_FORMAT, add_columns

# Folders kept: the one that counts and those before it.
KEEP = 2
_DONE = "_SUCCESS"


def versions_folder(spark: SparkSession, table: str) -> str:
    """Folder that holds the versions of ``database.table``, beside the database's tables."""
    database, name = split_name(table)
    described = spark.sql(f"DESCRIBE DATABASE {quoted(database)}").where(F.col("info_name") == "Location").first()
    return f"{described['info_value'].rstrip('/')}/{name.lower()}__versions"


def _path(spark: SparkSession, folder: str):
    return spark._jvm.org.apache.hadoop.fs.Path(folder)


def _files(spark: SparkSession, folder: str):
    return _path(spark, folder).getFileSystem(spark._jsc.hadoopConfiguration())


def stored_versions(spark: SparkSession, table: str) -> dict[int, bool]:
    """Numbers of the folders that are there, and whether each was written to its end."""
    folder = versions_folder(spark, table)
    files = _files(spark, folder)
    if not files.exists(_path(spark, folder)):
        return {}
    names = [status.getPath().getName() for status in files.listStatus(_path(spark, folder))]
    return {int(n): files.exists(_path(spark, f"{folder}/{n}/{_DONE}")) for n in sorted(names) if n.isdigit()}


def current_version(spark: SparkSession, table: str) -> int | None:
    """Number of the folder that the table points to; None if it is no table of versions."""
    if not table_exists(spark, table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").where("col_name = 'Location'").collect()
    parent, _, name = (rows[0]["data_type"] if rows else "").rstrip("/").rpartition("/")
    own = parent.rpartition("/")[2] == versions_folder(spark, table).rpartition("/")[2]
    return int(name) if own and name.isdigit() else None


def write_version(df: DataFrame, table: str, fmt: str = WAREHOUSE_FORMAT) -> int:
    """Write a new folder; the table does not change yet. A query may read the table it replaces."""
    spark = df.sparkSession
    number = max(stored_versions(spark, table), default=0) + 1
    df.write.format(fmt).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").save(
        f"{versions_folder(spark, table)}/{number:08d}"
    )
    return number


def point_to(spark: SparkSession, table: str, number: int, fmt: str = WAREHOUSE_FORMAT) -> None:
    """Make a version the table's content, an older one too; creates the table if missing.

    New columns at the end are added first, which old rows read as NULL. Other
    changes of the columns are refused: they need a new table.
    """
    if not stored_versions(spark, table).get(number):
        raise ValueError(f"{table} has no whole version {number}")
    place = f"{versions_folder(spark, table)}/{number:08d}"
    if not table_exists(spark, table):
        spark.sql(f"CREATE TABLE {quoted(table)} USING {fmt} LOCATION '{place}'")
        return
    have = [(f.name.lower(), f.dataType) for f in spark.table(table).schema.fields]
    want = [(f.name.lower(), f.dataType) for f in spark.read.format(fmt).load(place).schema.fields]
    short = min(len(have), len(want))
    if have[:short] != want[:short]:
        raise ValueError(f"{table}: version {number} has other columns than the table")
    add_columns(spark, table, [(name, kind.simpleString()) for name, kind in want[short:]])
    spark.sql(f"ALTER TABLE {quoted(table)} SET LOCATION '{place}'")
    spark.catalog.refreshTable(quoted(table))


def expire_versions(spark: SparkSession, table: str, keep: int = KEEP) -> list[int]:
    """Remove older folders than the ``keep`` that end with the current one, and what was left half written."""
    current, stored = current_version(spark, table), stored_versions(spark, table)
    if current is None:
        return []
    whole = [n for n, done in stored.items() if done and n <= current]
    gone = [n for n, done in stored.items() if n < current and (not done or n not in whole[-max(1, keep) :])]
    folder = versions_folder(spark, table)
    for number in gone:
        remove_folder(spark, f"{folder}/{number:08d}")
    return gone


def replace_versioned(df: DataFrame, table: str, fmt: str = WAREHOUSE_FORMAT, keep: int = KEEP) -> int:
    """Replace a table's rows; returns the version. Whenever the program ends, the table holds all old or all new rows.

    Can stand where :func:`tables.ctas_replace` does. A table that was made
    otherwise moves over with its first replacement. One program replaces a
    table at a time.
    """
    spark = df.sparkSession
    number = write_version(df, table, fmt)
    point_to(spark, table, number, fmt)
    expire_versions(spark, table, keep)
    return number


def drop_versioned(spark: SparkSession, table: str) -> None:
    """Drop a table with all its versions."""
    folder = versions_folder(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
    remove_folder(spark, folder)
