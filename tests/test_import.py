import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import importing
from tidemark.plans.importing import (
    ImportTask,
    import_filter,
    import_registered,
    import_table,
    refresh_table,
    registered_incremental,
    registered_task,
)
from tidemark.session import scratch_database

DAY = dt.date(2024, 1, 2)


@pytest.fixture()
def db(spark):
    return scratch_database(spark, "imp")


def visits(spark, *rows):
    df = spark.createDataFrame(list(rows), "id int, orgid int, updatestamp string, paid int")
    return df.withColumn("paid", F.col("paid").cast("decimal(10,2)"))


def task(db, **more):
    more = {"filter": "updatestamp > '{max_value}'", "max_value": "max(updatestamp)", **more}
    return ImportTask("pms", "visits", db, "src_pms_visits", **more)


def held(spark, table):
    return sorted((r["id"], r["updatestamp"]) for r in spark.table(table).collect())


def deletes(spark, db, *rows):
    df = spark.createDataFrame(list(rows), "tablename string, p_id int, p_orgid int, updatestamp string")
    import_table(spark, ImportTask("pms", "warm_deleted", db, "src_pms_warm_deleted", is_overwrite="1"), df.where, day=DAY)


def test_incremental_import(spark, db):
    deletes(spark, db, ("VISITS", 2, 1, "2024-01-03"), ("other", 1, 1, "2025-01-01"))
    assert not spark.catalog.tableExists(f"{db}.ods_pms_warm_deleted")
    first = visits(spark, (1, 1, "2024-01-01", 1), (2, 1, "2024-01-02", 2))
    assert import_filter(spark, task(db)) == "1=1"
    import_table(spark, task(db), first.where, day=DAY)
    assert held(spark, f"{db}.ods_pms_visits") == [(1, "2024-01-01")]
    later = first.union(visits(spark, (1, 1, "2024-01-04", 3), (3, 1, "2024-01-02", 4)))
    assert import_filter(spark, task(db)) == "updatestamp > '2024-01-02'"
    import_table(spark, task(db), later.where, day=DAY)
    assert held(spark, f"{db}.src_pms_visits") == [(1, "2024-01-01"), (1, "2024-01-04"), (2, "2024-01-02")]
    assert held(spark, f"{db}.ods_pms_visits") == [(1, "2024-01-04")]
    import_table(spark, task(db), later.where, day=DAY)
    assert spark.table(f"{db}.src_pms_visits").count() == 3
    assert spark.table(f"{db}.src_pms_visits").dtypes[-1] == ("paid", "double")


def test_full_import_replaces(spark, db):
    full = task(db, filter=None, max_value=None, is_overwrite="1")
    import_table(spark, full, visits(spark, (1, 1, "a", 1), (2, 1, "a", 1)).where, day=DAY)
    import_table(spark, full, visits(spark, (3, 1, "b", 1)).where, day=DAY)
    assert held(spark, f"{db}.src_pms_visits") == held(spark, f"{db}.ods_pms_visits") == [(3, "b")]


def test_partitioned_import(spark, db):
    daily = task(db, filter=None, max_value=None, is_overwrite="1", hive_partition_key="date", hive_partition_value="$yesterday")
    import_table(spark, daily, visits(spark, (1, 1, "a", 1)).where, day=DAY)
    import_table(spark, daily, visits(spark, (2, 1, "b", 1)).where, day=dt.date(2024, 1, 3))
    import_table(spark, daily, visits(spark, (3, 1, "c", 1)).where, day=dt.date(2024, 1, 3))
    rows = {(r["id"], r["date"]) for r in spark.table(f"{db}.src_pms_visits").collect()}
    assert rows == {(1, "20240101"), (3, "20240102")}
    assert held(spark, f"{db}.ods_pms_visits") == [(3, "c")]


def test_new_source_column_is_added(spark, db):
    plain = task(db, filter=None, max_value=None)
    import_table(spark, plain, visits(spark, (1, 1, "a", 1)).where, day=DAY, unique=False)
    grown = visits(spark, (2, 1, "b", 1)).withColumn("Note", F.lit("x"))
    diff = import_table(spark, plain, grown.where, day=DAY, unique=False)
    assert [r["source_name"] for r in diff.where("flag = 'add'").collect()] == ["Note"]
    assert {(r["id"], r["note"]) for r in spark.table(f"{db}.src_pms_visits").collect()} == {(1, None), (2, "x")}


def test_drifted_source_adds_nothing(spark, db):
    plain = task(db, filter=None, max_value=None)
    import_table(spark, plain, visits(spark, (1, 1, "a", 1)).where, day=DAY, unique=False)
    moved = visits(spark, (2, 1, "b", 1)).select("orgid", "id", "updatestamp", "paid", F.lit(1).alias("more"))
    with pytest.raises(ValueError, match="no column"):
        import_table(spark, plain, moved.where, day=DAY, unique=False)
    assert "more" not in spark.table(f"{db}.src_pms_visits").columns
    import_table(spark, plain, moved.drop("more").where, day=DAY, unique=False)
    assert held(spark, f"{db}.src_pms_visits") == [(1, "a"), (2, "b")]


def test_listed_columns_keep_source_order(spark, db):
    few = task(db, filter=None, max_value=None, columns="PAID, id", map_column_hive="id=string")
    import_table(spark, few, visits(spark, (1, 1, "a", 1)).where, day=DAY, unique=False)
    assert spark.table(f"{db}.src_pms_visits").dtypes == [("id", "string"), ("paid", "double")]


def test_query_fixes_the_column_order(spark, db):
    chosen = task(db, filter=None, max_value=None, query_sql="select paid, id from visits")
    source = visits(spark, (1, 1, "a", 1)).select("paid", "id")
    descriptors = [("id", "int(11)"), ("orgid", "int(11)"), ("paid", "decimal(10,2)")]
    import_table(spark, chosen, source.where, descriptors, day=DAY, unique=False)
    assert spark.table(f"{db}.src_pms_visits").columns == ["paid", "id"]


def test_missing_source(spark, db):
    with pytest.raises(ValueError, match="does not exist"):
        import_table(spark, task(db), visits(spark, (1, 1, "a", 1)).where, source_columns=[], day=DAY)


def test_task_from_registry_row(spark, db):
    row = spark.createDataFrame([("pms", "visits", db, "SRC_x", "id", 4)], "db_name string, table_name string, hive_database string, hive_table string, split_by string, m int").first()
    made = ImportTask.from_row(row)
    assert made.target == f"{db}.src_x" and made.m == 4 and not made.incremental and made.partition is None


@pytest.fixture()
def registered(spark, db):
    connections = spark.createDataFrame(
        [("01", "clinic", "mysql", "h", "fallback", 1, None, "1"), ("02", "other", "oracle", "h", "orcl", 1, None, "1")],
        "connection_id string, connection_name string, db_type string, host string, default_db string, port int,"
        " jdbc_extend string, status string",
    )
    registry = spark.createDataFrame(
        [("01", "pms", "Visits", db, "src_pms_visits", "1", "updatestamp > '{max_value}'", "max(updatestamp)"),
         ("02", "orcl", "visits", db, "src_x_visits", "1", " ", None)],
        "connection_id string, db_name string, table_name string, hive_database string, hive_table string, status string,"
        " filter string, max_value string",
    )
    return connections, registry


def test_lookup_by_name(db, registered):
    connections, registry = registered
    assert registered_task(*registered, "clinic", "PMS", "visits")["hive_table"] == "src_pms_visits"
    with pytest.raises(ValueError, match="no connection"):
        registered_task(*registered, "nowhere", "pms", "visits")
    with pytest.raises(ValueError, match="not registered"):
        registered_task(*registered, "other", "pms", "visits")
    assert registered_incremental(registry, f"{db.upper()}.SRC_pms_visits")
    assert not registered_incremental(registry, f"{db}.src_x_visits")
    assert not registered_incremental(registry, f"{db}.src_unknown")


def test_import_of_a_registered_table(spark, db, registered, monkeypatch):
    deletes(spark, db, ("visits", 9, 9, "2024-01-03"))
    asked = []

    def scan(session, connection, table=None, query=None, where=None, split=None, types=None):
        asked.append((connection.url, table, where))
        return visits(spark, (1, 1, "2024-01-01", 1))

    def catalogue(session, connection, tables):
        rows = [(tables[0], 2, "orgid", "int unsigned"), (tables[0], 1, "id", "int(11)"),
                (tables[0], 3, "updatestamp", "datetime"), (tables[0], 4, "paid", "decimal(10,2)")]
        return spark.createDataFrame(rows, "table_name string, ordinal int, name string, type string")

    monkeypatch.setattr(importing, "jdbc_scan", scan)
    monkeypatch.setattr(importing, "source_catalogue", catalogue)
    for _ in range(2):
        import_registered(spark, *registered, "clinic", "pms", "visits", DAY)
    url = "jdbc:mysql://h:1/pms?tinyInt1isBit=false"
    assert asked == [(url, "Visits", "1=1"), (url, "Visits", "updatestamp > '2024-01-01'")]
    assert spark.table(f"{db}.src_pms_visits").dtypes[:3] == [("id", "int"), ("orgid", "bigint"), ("updatestamp", "string")]
    assert held(spark, f"{db}.ods_pms_visits") == [(1, "2024-01-01")]


def test_refresh_by_name(spark, db):
    rows = visits(spark, (1, 1, "a", 1)).withColumn("date", F.lit("20240101"))
    rows.union(visits(spark, (2, 1, "b", 1)).withColumn("date", F.lit("20240102"))).write.saveAsTable(f"{db}.src_erp_x")
    assert refresh_table(spark, f"{db}.src_erp_x", False, "date", DAY) == f"{db}.ods_erp_x"
    assert held(spark, f"{db}.ods_erp_x") == [(1, "a")]
    refresh_table(spark, f"{db}.src_erp_x", False)
    assert spark.table(f"{db}.ods_erp_x").count() == 2
