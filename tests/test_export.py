import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans.exporting import ExportTask, export_table
from tidemark.session import scratch_database
from tidemark.sinks import export as sink
from tidemark.sinks import tables
from tidemark.sources.tables import describe_columns, list_source_tables


@pytest.fixture()
def db(spark):
    return scratch_database(spark, "exp")


@pytest.fixture()
def target(spark, db):
    spark.createDataFrame([(1, "a")], "id int, name string").write.format("orc").saveAsTable(f"{db}.final_t")
    return f"spark_catalog.{db}.t"


def ids(spark, table):
    return sorted(r["id"] for r in spark.table(table).collect())


def names(spark, db):
    return {r["table_name"] for r in list_source_tables(spark, db).collect()} - {"final_t"}


def refill(spark, db, *values):
    tables.ctas_replace(spark.createDataFrame([(v, str(v)) for v in values], "id int, name string"), f"{db}.final_t")


def test_target_is_created_with_database_types(spark, db, target):
    export_table(spark, f"{db}.final_t", target, "append")
    assert describe_columns(spark, target) == [("id", "int"), ("name", "varchar(255)")]
    sink.create_target_like(spark, f"{target}_like", target)
    assert describe_columns(spark, f"{target}_like") == describe_columns(spark, target)
    assert spark.table(f"{target}_like").count() == 0


def test_modes(spark, db, target):
    assert export_table(spark, f"{db}.final_t", target, "append").rows == 1
    refill(spark, db, 2, 3)
    assert export_table(spark, f"{db}.final_t", target, "append").rows == 2
    assert ids(spark, target) == [1, 2, 3]
    refill(spark, db, 4)
    assert export_table(spark, f"{db}.final_t", target, "overwrite", writers=1).rows == 1
    assert ids(spark, target) == [4]
    with pytest.raises(ValueError):
        export_table(spark, f"{db}.final_t", target, "upsert")


def test_rename_keeps_one_backup(spark, db, target):
    for day in (1, 2, 3, 5):
        refill(spark, db, day)
        export_table(spark, f"{db}.final_t", target, "rename", day=dt.date(2024, 1, day))
    assert ids(spark, target) == [5]
    assert names(spark, db) == {"t", "t_20240104_bak"} and ids(spark, f"{target}_20240104_bak") == [3]


def test_rename_again_on_the_same_day(spark, db, target):
    for value in (1, 2, 3):
        refill(spark, db, value)
        export_table(spark, f"{db}.final_t", target, "rename", day=dt.date(2024, 1, 2))
    assert ids(spark, target) == [3] and ids(spark, f"{target}_20240101_bak") == [2]


def test_failed_swap_is_undone(spark, db, target, monkeypatch):
    refill(spark, db, 1)
    export_table(spark, f"{db}.final_t", target, "append")
    refill(spark, db, 2)
    rename = tables.rename_table

    def failing(session, table, new_name):
        if new_name == target and table.endswith("20240102"):
            raise RuntimeError("lost connection")
        rename(session, table, new_name)

    monkeypatch.setattr(sink.tables, "rename_table", failing)
    with pytest.raises(RuntimeError, match="lost connection"):
        sink.export_rename(spark.table(f"{db}.final_t"), target, "20240102", "20240101")
    assert ids(spark, target) == [1]


def test_repeated_rows_are_noticed(spark, db, target, monkeypatch):
    export_table(spark, f"{db}.final_t", target, "append")
    insert = sink.jdbc_export_insert

    def twice(df, name, writers=None, overwrite=False):
        insert(df, name, writers, overwrite)
        insert(spark.table(f"{db}.final_t"), name, writers)

    monkeypatch.setattr(sink, "jdbc_export_insert", twice)
    with pytest.raises(RuntimeError, match="1 rows sent, 2 rows arrived"):
        sink.export_rename(spark.table(f"{db}.final_t"), target, "20240102", "20240101")
    assert ids(spark, target) == [1]


def test_missing_columns_are_added(spark, db, target):
    export_table(spark, f"{db}.final_t", target, "append")
    grown = spark.table(f"{db}.final_t").withColumn("paid", F.lit(1.5)).withColumn("note", F.lit("n"))
    tables.ctas_replace(grown, f"{db}.final_t")
    export_table(spark, f"{db}.final_t", target, "append")
    assert {(r["id"], r["paid"], r["note"]) for r in spark.table(target).collect()} == {(1, None, None), (1, 1.5, "n")}
    assert describe_columns(spark, target)[-1] == ("note", "varchar(255)")


def test_retention_spares_other_tables(spark, db, target):
    export_table(spark, f"{db}.final_t", target, "append")
    others = ["t_20240101_bak", "t_20240105_bak", "t_x_bak", "t2_20240101_bak", "t_20241399_bak", "t_t_20240101_bak"]
    for name in others:
        spark.range(1).write.format("orc").saveAsTable(f"{db}.{name}")
    assert sink.backup_retention(spark, target, "20240105") == ["t_20240101_bak"]
    assert names(spark, db) == {"t", *others[1:]}


def test_task_from_registry_row(spark, db, target):
    row = spark.createDataFrame([(db, "FINAL_t", db, "t", " ", None)], "hive_database string, hive_table string, db_name string, table_name string, mode string, m int").first()
    assert ExportTask.from_row(row).run(spark, "spark_catalog", dt.date(2024, 1, 2)).rows == 1
    assert ids(spark, target) == [1] and names(spark, db) == {"t", "t_20240101_bak"}
