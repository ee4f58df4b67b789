"""Inserts into a database that hold each row once, however often a task runs.

A database insert is not atomic over Spark's tasks: a task that is lost after
its commit runs again and inserts again. Here rows are dealt into batches by
their content. A batch is one transaction, which also writes a line into a
ledger beside the target; its key is the load and the batch. A task that comes
to a batch with a line passes it over, and one that comes while another attempt
still writes fails on the key and undoes its own rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH = "insert_batch"
# Rows of a batch, about, and rows sent at a time.
ROWS, SLICE = 100_000, 1_000
LEDGER_SUFFIX = "__batches"

# How a database marks a parameter and quotes a name.
MARKS = {"mysql": "%s", "sqlserver": "?", "oracle": ":{n}"}
QUOTES = {"mysql": ("`", "`"), "sqlserver": ("[", "]"), "oracle": ('"', '"')}


@dataclass(frozen=True)
class Database:
    """A database as tasks reach it: ``connect`` opens a DB-API connection and travels to the executors.

    User and password belong into ``connect``, best read from the environment there.
    """

    dialect: str
    connect: Callable[[], Any]

    def name(self, *parts: str) -> str:
        left, right = QUOTES[self.dialect]
        return ".".join(f"{left}{part.replace(right, right * 2)}{right}" for part in parts)

    def marks(self, count: int, first: int = 1) -> str:
        return ", ".join(MARKS[self.dialect].format(n=first + k) for k in range(count))

    def mark(self, n: int) -> str:
        return self.marks(1, n)


@dataclass(frozen=True)
class Inserted:
    """What a load did: rows it inserted, and rows of batches that were there already."""

    rows: int
    skipped: int


class _Statements:
    def __init__(self, database: Database, table: str, columns: list[str]):
        parts = table.split(".")
        ledger = database.name(*parts[:-1], parts[-1] + LEDGER_SUFFIX)
        names = ", ".join(database.name(c) for c in columns)
        by = f"load_id = {database.mark(1)} AND batch_no = {database.mark(2)}"
        self.look = f"SELECT row_count FROM {ledger} WHERE {by}"
        self.claim = f"INSERT INTO {ledger} (load_id, batch_no, row_count) VALUES ({database.marks(3)})"
        told = f"load_id = {database.mark(2)} AND batch_no = {database.mark(3)}"
        self.told = f"UPDATE {ledger} SET row_count = {database.mark(1)} WHERE {told}"
        self.insert = f"INSERT INTO {database.name(*parts)} ({names}) VALUES ({database.marks(len(columns))})"
        self.probe = f"SELECT COUNT(*) FROM {ledger}"
        self.create = (
            f"CREATE TABLE {ledger} (load_id VARCHAR(64) NOT NULL, batch_no INTEGER NOT NULL,"
            " row_count BIGINT NOT NULL, PRIMARY KEY (load_id, batch_no))"
        ).replace("BIGINT", "NUMBER(19)" if database.dialect == "oracle" else "BIGINT")


class _Batch:
    """One batch in a transaction of its own."""

    def __init__(self, database: Database, statements: _Statements, load_id: str, number: int):
        self.statements, self.key, self.rows = statements, (load_id, number), 0
        self.connection = database.connect()
        self.cursor = self.connection.cursor()
        self.cursor.execute(statements.look, self.key)
        self.skip = self.cursor.fetchone() is not None
        if not self.skip:
            self.cursor.execute(statements.claim, (*self.key, 0))

    def add(self, rows: list[tuple]) -> None:
        self.rows += len(rows)
        if not self.skip:
            self.cursor.executemany(self.statements.insert, rows)

    def end(self) -> dict:
        if not self.skip:
            self.cursor.execute(self.statements.told, (self.rows, *self.key))
        self.connection.commit()
        self.connection.close()
        return {"batch": self.key[1], "rows": self.rows, "skipped": self.skip}

    def undo(self) -> None:
        try:
            self.connection.rollback()
        finally:
            self.connection.close()


def create_ledger(database: Database, table: str) -> None:
    """Create the ledger beside a table, if missing."""
    statements = _Statements(database, table, [])
    connection = database.connect()
    try:
        cursor = connection.cursor()
        try:
            cursor.execute(statements.probe)
            cursor.fetchone()
        except Exception:  # noqa: BLE001 - every driver has an error of its own for a missing table
            connection.rollback()
            cursor.execute(statements.create)
        connection.commit()
    finally:
        connection.close()


def dealt(df: DataFrame, batches: int, writers: int) -> DataFrame:
    """Rows with their batch, sorted by it, over at most ``writers`` tasks.

    The batch is a hash of the whole row, so it is the same in every attempt and
    no hot key makes one batch large.
    """
    number = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(batches)).cast("int")
    return df.withColumn(BATCH, number).repartition(writers, BATCH).sortWithinPartitions(BATCH)


def insert_once(
    df: DataFrame,
    database: Database,
    table: str,
    load_id: str,
    writers: int = 8,
    batches: int | None = None,
) -> Inserted:
    """Insert rows in batches that are there once, even if tasks or the whole call run again.

    ``load_id`` names the rows: a call with the same id must bring the same rows
    and number of batches, and inserts only what is missing. With None the rows
    are counted first, for batches of about ``ROWS``.
    """
    if not re.fullmatch(r"[\w.:@-]{1,64}", load_id):
        raise ValueError(f"load id {load_id!r} is no word of 1 to 64 characters")
    if BATCH in df.columns:
        raise ValueError(f"{BATCH} is the name of a column of the insert's own")
    batches = batches or max(writers, -(-df.count() // ROWS))
    create_ledger(database, table)
    columns = df.columns
    statements = _Statements(database, table, columns)

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: _Batch | None = None
        try:
            for part in parts:
                for at in range(0, part.num_rows, SLICE):
                    some = part.slice(at, SLICE)
                    numbers = some.column(BATCH).to_pylist()
                    rows = list(zip(*[some.column(c).to_pylist() for c in columns], strict=True))
                    start = 0
                    for k in range(1, len(rows) + 1):
                        if k < len(rows) and numbers[k] == numbers[start]:
                            continue
                        if open_ is None or open_.key[1] != numbers[start]:
                            if open_:
                                yield pa.RecordBatch.from_pylist([open_.end()], schema=done)
                            open_ = None
                            open_ = _Batch(database, statements, load_id, numbers[start])
                        open_.add(rows[start:k])
                        start = k
            if open_:
                last, open_ = open_.end(), None
                yield pa.RecordBatch.from_pylist([last], schema=done)
        except BaseException:
            if open_:
                open_.undo()
            raise

    done = pa.schema([("batch", pa.int32()), ("rows", pa.int64()), ("skipped", pa.bool_())])
    told = dealt(df, batches, writers).mapInArrow(write, "batch int, rows long, skipped boolean").collect()  # a row a batch
    return Inserted(
        sum(r["rows"] for r in told if not r["skipped"]), sum(r["rows"] for r in told if r["skipped"])
    )
