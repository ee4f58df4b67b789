"""Inserts that hold each row once. The database is a small stand-in that keeps its rows in a file."""

import collections
import datetime as dt
import decimal

import pytest

from tidemark.sinks import batches


def stand_in(folder, lose=None):
    """A database whose commits replace one file; ``lose`` names a batch whose task ends right after its commit."""

    def connect():
        import fcntl
        import os
        import pickle

        class Connection:
            def __init__(self):
                self.lock = open(f"{folder}/lock", "w")
                fcntl.flock(self.lock, fcntl.LOCK_EX)  # one transaction at a time
                self.rollback()

            def rollback(self):
                path = f"{folder}/rows"
                self.tables = pickle.load(open(path, "rb")) if os.path.exists(path) else {"`d`.`t`": []}

            def cursor(self):
                return self

            def execute(self, text, values=()):
                words = text.split()
                if words[0] == "CREATE":
                    self.tables[words[2]] = {}
                    return
                ledger = self.tables["`d`.`t__batches`"]
                if text.startswith("SELECT COUNT"):
                    self.found = (len(ledger),)
                elif words[0] == "SELECT":
                    self.found = ledger.get(values)
                elif words[0] == "INSERT":
                    if values[:2] in ledger:
                        raise RuntimeError("duplicate key")
                    ledger[values[:2]] = (values[2],)
                else:
                    self.last = values[1:]
                    ledger[values[1:]] = (values[0],)

            def executemany(self, text, rows):
                self.tables[text.split()[2]] += rows

            def fetchone(self):
                return self.found

            def commit(self):
                with open(f"{folder}/new", "wb") as file:
                    pickle.dump(self.tables, file)
                os.replace(f"{folder}/new", f"{folder}/rows")
                once = f"{folder}/lost"
                if lose is not None and getattr(self, "last", ("", None))[1] == lose and not os.path.exists(once):
                    open(once, "w").close()
                    raise RuntimeError("lost after its commit")

            def close(self):
                self.lock.close()

        return Connection()

    return batches.Database("mysql", connect)


def stored(database):
    connection = database.connect()
    connection.close()
    return connection.tables


ROWS = [(k % 70, f"name {k % 70}", decimal.Decimal(k % 70), dt.date(2024, 1, 1 + k % 28) if k % 5 else None) for k in range(300)]
SCHEMA = "id int, name string, price decimal(9,2), day date"


def test_a_task_lost_after_its_commit(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    database = stand_in(str(tmp_path), lose=5)
    with pytest.raises(Exception, match="lost after its commit"):
        batches.insert_once(df, database, "d.t", "day-1", writers=3, batches=12)
    held = len(stored(database)["`d`.`t`"])
    done = batches.insert_once(df, database, "d.t", "day-1", writers=3, batches=12)
    assert held > 0 and done == batches.Inserted(300 - held, held)
    want = collections.Counter((*r[:2], r[2].quantize(decimal.Decimal("0.01")), r[3]) for r in ROWS)
    assert collections.Counter(stored(database)["`d`.`t`"]) == want
    assert sum(n for (n,) in stored(database)["`d`.`t__batches`"].values()) == 300
    assert batches.insert_once(df, database, "d.t", "day-1", writers=2, batches=12) == batches.Inserted(0, 300)
    assert batches.insert_once(df.limit(0), database, "d.t", "day-2") == batches.Inserted(0, 0)
    assert batches.insert_once(df.where("id = 3"), database, "d.t", "day-2").rows == 5  # another load


def test_slices_and_many_batches_in_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batches, "SLICE", 7)
    database = stand_in(str(tmp_path))
    assert batches.insert_once(spark.createDataFrame(ROWS, SCHEMA), database, "d.t", "x", writers=1, batches=9).rows == 300
    assert len(stored(database)["`d`.`t`"]) == 300


def test_statements_and_refusals(spark):
    texts = {}
    for dialect in batches.MARKS:
        made = batches._Statements(batches.Database(dialect, None), "d.t", ["id", "na`me"])
        texts[dialect] = made.insert, made.told
    assert texts["mysql"][0] == "INSERT INTO `d`.`t` (`id`, `na``me`) VALUES (%s, %s)"
    assert texts["oracle"][0] == 'INSERT INTO "d"."t" ("id", "na`me") VALUES (:1, :2)'
    assert texts["sqlserver"][1] == "UPDATE [d].[t__batches] SET row_count = ? WHERE load_id = ? AND batch_no = ?"
    assert texts["oracle"][1].endswith("SET row_count = :1 WHERE load_id = :2 AND batch_no = :3")
    df = spark.createDataFrame([(1,)], f"{batches.BATCH} int")
    with pytest.raises(ValueError, match="no word"):
        batches.insert_once(df, batches.Database("mysql", None), "d.t", "a b")
    with pytest.raises(ValueError, match="own"):
        batches.insert_once(df, batches.Database("mysql", None), "d.t", "a")
