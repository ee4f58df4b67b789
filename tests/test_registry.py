import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.numbering import number_rows
from tidemark.plans import registry as plan
from tidemark.session import scratch_database
from tidemark.sinks import tables as sink
from tidemark.sinks.export import expired_backups
from tidemark.sources.tables import filter_name_prefix

TODAY = "2024-01-05"


@pytest.fixture(scope="module")
def connections(spark):
    rows = [("01", "one", "1"), ("02", "two", "1"), ("03", "off", "0")]
    return spark.createDataFrame(rows, "connection_id string, connection_name string, status string")


@pytest.fixture(scope="module")
def tasks(spark):
    rows = [
        (1, "02", "a", "second", 2, None, "1"),
        (2, "01", "a", "unordered", None, "2024-01-04", "1"),
        (3, "01", "a", "first", 1, "", "1"),
        (4, "01", "a", "Warm_Deleted", 5, None, "1"),
        (5, "01", "a", "done", 3, TODAY, "1"),
        (6, "01", "a", "inactive", 1, None, "0"),
        (7, "03", "a", "on inactive", 1, "2024-01-04", "1"),
    ]
    return spark.createDataFrame(
        rows,
        "id int, connection_id string, db_name string, table_name string, task_order int, last_exec_date string, status string",
    )


def test_sync_plan(connections, tasks):
    plan_rows = plan.sync_plan(connections, tasks, TODAY).orderBy("no").collect()
    assert [(r["no"], r["table_name"]) for r in plan_rows] == [(0, "Warm_Deleted"), (1, "first"), (2, "second"), (5, "unordered")]
    exports = plan.export_plan(connections, tasks, TODAY).orderBy("no").collect()
    assert [(r["no"], r["table_name"]) for r in exports] == [(1, "first"), (2, "second"), (4, "Warm_Deleted"), (5, "unordered")]


def test_order_and_redo(connections, tasks):
    assert [r["id"] for r in plan.order_task_plan(tasks).collect()] == [3, 6, 7, 1, 5, 4, 2]
    assert sorted(r["id"] for r in plan.filter_redo(connections, tasks, ["01", "03"]).collect()) == [2, 5, 7]


def test_registry_scan_and_lookup(connections, tasks):
    scanned = plan.registry_scan(connections, tasks.where("connection_id = '01'"))
    assert scanned.where("id is null").count() == 2
    assert plan.filter_lookup(tasks, "01", "A", "FIRST").first()["id"] == 3
    assert plan.filter_lookup(tasks, "02", "A", "FIRST").count() == 0


def test_distinct_keep_first(tasks):
    kept = plan.distinct_keep_first(tasks, ["connection_id"])
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 7] and kept.columns == tasks.columns


def test_number_rows_over_many_partitions(spark):
    df = spark.range(5000, numPartitions=7).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 4).alias("k"))
    order = [F.col("k").asc_nulls_last(), F.col("id").asc()]
    numbered = number_rows(df, order).collect()
    assert [r["no"] for r in sorted(numbered, key=lambda r: (r["k"] is None, r["k"] or 0, r["id"]))] == list(range(1, 5001))
    assert number_rows(df.where("id < 0"), order).count() == 0


def test_ledger(spark, tasks):
    db = scratch_database(spark, "ledger")
    sink.create_table(spark, f"{db}.runs", [tuple(c.strip().split(" ")) for c in plan.LEDGER.split(",")])
    at = dt.datetime(2024, 1, 5, 1)

    def run(task, minutes, status, day=TODAY):
        return (task, day, at, at + dt.timedelta(minutes=minutes), status)

    plan.record_run(spark, f"{db}.runs", [run(1, 1, "FAILED"), run(1, 2, "SUCCEEDED"), run(2, 1, "FAILED")])
    plan.record_run(spark, f"{db}.runs", [run(2, 3, "FAILED"), run(3, 1, "SUCCEEDED", "2024-01-03")])
    ledger = spark.table(f"{db}.runs")
    assert [(r["id"], r["seconds"]) for r in plan.failed_tasks(ledger, TODAY).collect()] == [(2, 180)]
    synced = {r["id"]: r["last_exec_date"] for r in plan.sync_ledger(tasks, ledger).collect()}
    assert (synced[1], synced[2], synced[3], synced[4]) == (TODAY, "2024-01-04", "2024-01-03", None)


def test_row_counts(spark, tasks):
    spark.range(7).write.saveAsTable(f"{scratch_database(spark, 'n')}.seven")
    spark.range(3).createOrReplaceTempView("three")
    counts = plan.table_rowcounts(plan.open_tables(spark, ["three", "missing_table"]))
    assert {tuple(r) for r in counts.collect()} == {("three", 3), ("missing_table", None)}
    stored = tasks.select("id", "connection_id", "db_name", "table_name", F.lit(1).cast("bigint").alias("table_rows"), F.lit("old").alias("rows_updatetime"))
    layout = "connection_id string, db_name string, table_name string, table_rows bigint"
    own = {r["table_name"]: r["connection_id"] for r in tasks.collect()}
    fresh = spark.createDataFrame([(own["first"], "a", "first", 9), (own["second"], "a", "second", None), ("?", "a", "done", 5)], layout)
    out = {r["table_name"]: (r["table_rows"], r["rows_updatetime"]) for r in plan.store_rowcounts(stored, fresh, F.lit("now")).collect()}
    assert out["first"] == (9, "now") and out["second"] == (1, "old") and out["done"] == (1, "old")
    with pytest.raises(ValueError):
        plan.table_rowcounts({})


def test_seed_registry(spark):
    listed = spark.createDataFrame([("PPets",), ("CReg",)], "table_name string")
    seeded = plan.seed_registry(listed, "01", "clinicdb", "pms")
    rows = {tuple(r) for r in seeded.collect()}
    assert ("01", "clinicdb", "PPets", "pet_medical", "src_pms_PPets", "1", "0") in rows and len(rows) == 2
    assert [tuple(r) for r in plan.distinct_db_map(seeded).collect()] == [("clinicdb", "pms")]
    assert plan.seed_registry(listed, "01", "clinicdb").first()["hive_table"] == "src_clinicdb_PPets"


def test_register_tables(spark):
    table = f"{scratch_database(spark, 'reg')}.meta_import"
    sink.create_table(spark, table, [tuple(c.strip().split(" ")) for c in plan.IMPORT_REGISTRY.split(",")])
    listed = spark.createDataFrame([("b",), ("a",)], "table_name string")
    plan.register_tables(plan.seed_registry(listed, "01", "pms"), table)
    plan.register_tables(plan.seed_registry(listed, "02", "pms"), table)
    rows = spark.table(table).orderBy("id").collect()
    assert [(r["id"], r["connection_id"], r["table_name"], r["filter"]) for r in rows] == [
        (1, "01", "a", None), (2, "01", "b", None), (3, "02", "a", None), (4, "02", "b", None),
    ]
    with pytest.raises(ValueError, match="registered already"):
        plan.register_tables(plan.seed_registry(listed, "02", "pms"), table)
    assert spark.table(table).count() == 4


def test_merge_plan(spark):
    rows = plan.merge_plan(spark).collect()
    assert len(rows) == 39 and (rows[0]["no"], rows[0]["table_name"]) == (1, "T_OutStore")
    assert rows[-1]["table_name"] == "PClientManagement"


def test_expired_backups(spark):
    names = ["t_20240101_bak", "t_20240105_bak", "t_x_bak", "t", "t2_20240101_bak", "t_20241399_bak", "t_t_20240101_bak",
             "t_20240101_bak2", "t_20240101"]
    listed = spark.createDataFrame([(n,) for n in names], "table_name string")
    assert [r[0] for r in expired_backups(listed, "t", "20240105").collect()] == ["t_20240101_bak"]
    assert filter_name_prefix(listed, "t_").count() == 7


def test_layouts_hold_no_secret(spark):
    for layout in (plan.CONNECTIONS, plan.IMPORT_REGISTRY, plan.EXPORT_REGISTRY):
        assert "password" not in layout
        assert spark.createDataFrame([], layout).count() == 0


def test_check_schemas(spark):
    db = scratch_database(spark, "chk")
    spark.sql(f"CREATE TABLE {db}.src_pms_visits (id int, name string) USING orc")
    registry = spark.createDataFrame(
        [("PMS", "Visits", db, "SRC_pms_visits"), ("pms", "fresh", db, "src_pms_fresh")],
        "db_name string, table_name string, hive_database string, hive_table string",
    ).withColumn("connection_id", F.lit("01"))
    source = spark.createDataFrame(
        [("pms", "VISITS", 1, "ID", "int"), ("pms", "VISITS", 2, "name", "text"), ("pms", "VISITS", 3, "day", "date"),
         ("pms", "fresh", 1, "id", "int"), ("hr", "visits", 1, "other", "int")],
        "db_name string, table_name string, ordinal int, name string, type string",
    ).withColumn("connection_id", F.lit("01"))
    diff = plan.check_schemas(registry, source, plan.warehouse_catalogue(spark, registry))
    assert sorted((r["table_name"], r["ordinal"], r["flag"]) for r in diff.collect()) == [
        (f"{db}.src_pms_fresh", 1, "create"),
        (f"{db}.src_pms_visits", 1, "same"),
        (f"{db}.src_pms_visits", 2, "same"),
        (f"{db}.src_pms_visits", 3, "add"),
    ]
