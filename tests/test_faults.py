"""Cases that once lost rows, and refusals that must come before the first write."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.types import import_type, map_types_import, type_name
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.schema import column_catalogue, evolve_add_columns, schema_diff_import
from tidemark.plans import importing, refresh, registry, running
from tidemark.plans.exporting import export_table
from tidemark.plans.unique import unique_incremental
from tidemark.session import scratch_database
from tidemark.sinks import tables as sink
from tidemark.sources.jdbc import Connection
from tidemark.sources.tables import day_scan, high_water_mark, read_mark

DAY = dt.date(2024, 1, 2)


def task(db, table="src_erp_x", **more):
    return importing.ImportTask("erp", "x", db, table, **more)


def test_types_are_decided_once(spark):
    db = scratch_database(spark, "wide")
    rows = spark.createDataFrame([("18446744073709551615",), ("9007199254740993",)], "id string").select(F.col("id").cast("decimal(20,0)"))
    importing.import_table(spark, task(db), rows.where, [("id", "bigint unsigned")], unique=False)
    importing.import_table(spark, task(db, "src_erp_y"), rows.where, unique=False)
    for name in ("src_erp_x", "src_erp_y"):
        assert {str(r[0]) for r in spark.table(f"{db}.{name}").collect()} == {"18446744073709551615", "9007199254740993"}


@pytest.mark.parametrize("db_type", ["", "sqlserver", "oracle"])
@pytest.mark.parametrize("exact", [False, True])
def test_column_form_follows_the_rules(spark, db_type, exact):
    kinds = ["tinyint", "tinyint unsigned", "NUMBER(15,2)", "number", "decimal(38,0)", "numeric(40,2)", "money", "bit", "text",
             "decimal(10)", "NUMBER(9,-2)", "bigint(20) unsigned"]
    df = spark.createDataFrame([(k,) for k in kinds], "t string").withColumn("n", type_name("t"))
    found = {r["t"]: r["w"] for r in df.select("t", map_types_import("n", db_type, exact, "t").alias("w")).collect()}
    assert found == {k: import_type(k, exact, db_type) for k in kinds}


def test_refusals_leave_the_target_alone(spark):
    db = scratch_database(spark, "refuse")
    rows = spark.createDataFrame([(1, 2, "a")], "id int, orgid int, updatestamp string")
    marked = {"filter": "id > {max_value}", "max_value": "max(id)"}
    with pytest.raises(ValueError, match="warm_deleted"):
        importing.import_table(spark, task(db, "src_pms_x", **marked), rows.where)
    with pytest.raises(ValueError, match="src_"):
        importing.import_table(spark, task(db, "erp_x"), rows.where)
    with pytest.raises(ValueError, match="last increment"):
        importing.import_table(spark, task(db, is_overwrite="1", **marked), rows.where)
    assert spark.sql(f"SHOW TABLES IN {db}").count() == 0
    with pytest.raises(ValueError, match="split column"):
        importing.jdbc_source(spark, Connection("1", "mysql", "h", 1, "d"), task(db, m=4))


def test_overwrite_replaces_every_partition(spark):
    table = f"{scratch_database(spark, 'dyn')}.t"
    sink.create_table(spark, table, [("id", "int")], "day")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, day string")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sink.overwrite_table(rows, table)
        sink.overwrite_table(rows.where("id = 2"), table)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r["id"] for r in spark.table(table).collect()] == [2]


def test_snapshot_of_a_missing_partition_keeps_the_current_table(spark):
    db = scratch_database(spark, "snap")
    rows = spark.createDataFrame([(1,), (2,)], "id int")
    own = task(db, is_overwrite="1", hive_partition_key="part", hive_partition_value="first")
    importing.import_table(spark, own, rows.where, day=DAY)
    assert spark.table(f"{db}.ods_erp_x").count() == 2
    with pytest.raises(ValueError, match="no rows"):
        importing.refresh_table(spark, f"{db}.src_erp_x", False, "part", DAY)
    assert spark.table(f"{db}.ods_erp_x").count() == 2


def test_an_import_without_rows_keeps_the_current_table(spark):
    db = scratch_database(spark, "norows")
    rows = spark.createDataFrame([(1,), (2,)], "id int")
    own = task(db, is_overwrite="1", hive_partition_key="part", hive_partition_value="$yesterday")
    importing.import_table(spark, own, rows.where, day=DAY)
    later = DAY + dt.timedelta(days=1)
    with pytest.raises(ValueError, match="no rows of part=20240102"):
        importing.import_table(spark, own, rows.limit(0).where, day=later)
    with pytest.raises(ValueError, match="no rows"):
        importing.refresh_current(spark, own, later)
    assert spark.table(f"{db}.ods_erp_x").count() == 2
    importing.import_table(spark, own, rows.where("id = 1").where, day=later)
    assert spark.table(f"{db}.ods_erp_x").count() == 1
    empty = task(db, "src_erp_y", is_overwrite="1", hive_partition_key="part", hive_partition_value="first")
    importing.import_table(spark, empty, rows.limit(0).where, day=DAY)
    assert spark.table(f"{db}.ods_erp_y").isEmpty()


def test_one_rule_for_the_first_mark(spark):
    table = f"{scratch_database(spark, 'mark')}.t"
    spark.sql(f"CREATE TABLE {table} (at timestamp, n int, s string) USING orc")
    assert str(high_water_mark(spark.table(table), "max(at)").first()[0]) == "1970-01-01 00:00:00"
    assert read_mark(spark, table, "max(s)", kind="datetime") == read_mark(spark, "no.such", "max(s)", kind="DATE") == "1970-01-01"
    assert read_mark(spark, table, "max(n)", kind="int") == high_water_mark(spark.table(table), "max(n)").first()[0] == 0
    assert read_mark(spark, table, "max(s)", "2020-01-01", "timestamp(6)") == "2020-01-01"


def test_schema_comparison_takes_one_exchange(spark):
    many = {f"t{k}": [("a", "int"), ("b", "text"), ("c", "int")] for k in range(5)}
    source = column_catalogue(spark, many)
    target = column_catalogue(spark, {"t1": [("a", "int"), ("x", "string")], "t2": [("A", "int"), ("b", "string")], "t3": []})
    diff = schema_diff_import(source, target)
    flags = {}
    for r in diff.orderBy("table_name", "ordinal").collect():
        flags.setdefault(r["table_name"], []).append(r["flag"])
    assert flags == {"t0": ["create"] * 3, "t1": ["same", "drift", "add"], "t2": ["same", "same", "add"], "t3": ["create"] * 3, "t4": ["create"] * 3}
    assert [(r["table_name"], r["name"]) for r in evolve_add_columns(diff).collect()] == [("t2", "c")]
    for frame in (diff, evolve_add_columns(diff)):
        assert frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_row_counts_survive_a_broken_file(spark, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/good")
    spark.range(4).coalesce(1).write.parquet(f"{tmp_path}/bad")
    broken = spark.read.parquet(f"{tmp_path}/bad")
    for name in os.listdir(f"{tmp_path}/bad"):
        if name.endswith(".parquet"):
            with open(f"{tmp_path}/bad/{name}", "wb") as file:
                file.write(b"no parquet")
    counts = registry.table_rowcounts({"good": spark.read.parquet(f"{tmp_path}/good"), "bad": broken, "gone": None})
    assert {tuple(r) for r in counts.collect()} == {("good", 4), ("bad", None), ("gone", None)}


def test_repeated_counts_and_empty_sources_are_refused(spark):
    rows = spark.createDataFrame([("1", "d", "t", 0, "old")], "connection_id string, db_name string, table_name string, table_rows bigint, rows_updatetime string")
    counts = spark.createDataFrame([("1", "d", "t", 5), ("1", "d", "t", 6)], "connection_id string, db_name string, table_name string, table_rows bigint")
    with pytest.raises(Exception, match="counted twice"):
        registry.store_rowcounts(rows, counts).collect()
    listed = spark.createDataFrame([], "table_name string")
    with pytest.raises(ValueError, match="no tables"):
        registry.register_tables(registry.seed_registry(listed, "01", "pms", exec_engine="sqoop"), "unused.registry")
    assert "exec_engine" in registry.seed_registry(listed, "01", "pms", exec_engine="sqoop").columns


def test_export_tells_drift_and_keeps_long_text(spark):
    db = scratch_database(spark, "drift")
    spark.createDataFrame([(1, "x" * 1000)], "id int, note string").write.saveAsTable(f"{db}.final_t")
    target = f"spark_catalog.{db}.t"
    done = export_table(spark, f"{db}.final_t", target, "append", text_type="string")
    assert done.rows == 1 and len(spark.table(target).first()["note"]) == 1000
    spark.sql(f"CREATE TABLE {db}.swapped (note string, id int) USING orc")
    done = export_table(spark, f"{db}.final_t", f"spark_catalog.{db}.swapped", "append", text_type="string")
    assert {r["flag"] for r in done.findings.collect()} == {"drift"}


def test_latest_per_key_with_nested_maps(spark):
    df = spark.sql("SELECT 1 AS id, 2 AS at, array(map('a', 1)) AS held, named_struct('m', map('b', 2)) AS deep")
    assert latest_per_key(df.unionAll(df), ["id"], "at").count() == 1


def test_a_day_is_a_range_for_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    day = day_scan(events, "ts", "20240102")
    assert day.count() == events.where(F.date_format("ts", "yyyyMMdd") == "20240102").count() > 0
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


LOG = "id int, orgid int, at string, n int"
DELETES = "p_id int, p_orgid int, updatestamp string, tablename string"


@pytest.mark.parametrize("seed", range(3))
def test_refresh_equals_a_rebuild(spark, seed):
    """NULL stamps, ties, late rows, revived keys, buckets that lose all rows."""
    rng = random.Random(seed)
    table = f"{scratch_database(spark, 'refresh')}.ods_x"
    stamp = lambda: rng.choice([None, *"abcdefgh"])
    rows = [(rng.randint(1, 25), rng.choice([1, 2, None]), stamp(), k % 7) for k in range(150)]
    dead = [(rng.randint(1, 25), rng.choice([1, 2, None]), stamp(), "x") for _ in range(40)]
    at = F.lit(0).cast("timestamp")
    args = (["id", "orgid"], "at")
    first, deletes = spark.createDataFrame(rows[:60], LOG), spark.createDataFrame(dead[:10], DELETES)
    refresh.build_current(first, deletes, table, *args, buckets=16, etl_time=at)
    for k, (rows_to, dead_to) in enumerate([(75, 12), (76, 12), (76, 30), (150, 40)]):
        before = [(60, 10), (75, 12), (76, 12), (76, 30)][k]
        new = spark.createDataFrame(rows[before[0] : rows_to], LOG)
        known, fresh = spark.createDataFrame(dead[:dead_to], DELETES), spark.createDataFrame(dead[before[1] : dead_to], DELETES)
        refresh.refresh_current(spark, table, new, known, fresh, *args, etl_time=at)
        whole = unique_incremental(spark.createDataFrame(rows[:rows_to], LOG), known, *args, etl_time=at)
        found = spark.table(table).drop(refresh.BUCKET)
        key = lambda r: str(tuple(r))
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_refresh_leaves_other_buckets_alone(spark):
    table = f"{scratch_database(spark, 'alone')}.ods_x"
    log = spark.range(200).select(F.col("id").cast("int"), F.lit(1).alias("orgid"), F.lit("b").alias("at"), F.lit(0).alias("n"))
    none = spark.createDataFrame([], DELETES)
    refresh.build_current(log, none, table, ["id", "orgid"], "at", buckets=16)
    files = {r["f"] for r in spark.table(table).select(F.input_file_name().alias("f")).distinct().collect()}
    new = spark.createDataFrame([(7, 1, "c", 9)], LOG)
    touched = refresh.refresh_current(spark, table, new, none, none, ["id", "orgid"], "at")
    after = {r["f"] for r in spark.table(table).select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(touched) == 1 and all(f"{refresh.BUCKET}={touched[0]}/" in f for f in files ^ after)
    assert spark.table(table).where("id = 7").first()["n"] == 9 and spark.table(table).count() == 200
    plan = refresh.refreshed(spark.table(table), new, none, touched, ["id", "orgid"], "at", 16)
    assert f"PartitionFilters: [isnotnull({refresh.BUCKET}" in plan._jdf.queryExecution().executedPlan().toString()
    assert refresh.refresh_current(spark, table, new.limit(0), none, none, ["id", "orgid"], "at") == []


def test_run_stops_when_a_tombstone_log_fails(spark):
    ledger = f"{scratch_database(spark, 'run')}.runs"
    sink.create_table(spark, ledger, [tuple(c.split()) for c in registry.LEDGER.split(",")])
    rows = spark.createDataFrame([(1, "a"), (2, "src_Warm_Deleted"), (3, "b")], "id int, table_name string").collect()
    ran = []

    def run(bad):
        def load(row):
            ran.append(row["id"])
            if row["id"] in bad:
                raise RuntimeError("no")

        return load

    assert [r["id"] for r in running.run_tasks(spark, rows, run([2]), ledger, "2024-01-02")] == [2] and ran == [2]
    ran.clear()
    assert [r["id"] for r in running.run_tasks(spark, rows, run([1]), ledger, "2024-01-02")] == [1] and ran == [2, 1, 3]
    held = sorted((r["id"], r["status"]) for r in spark.table(ledger).collect())
    assert held == [(1, "FAILED"), (2, "FAILED"), (2, "SUCCEEDED"), (3, "SUCCEEDED")]


def test_text_policy_of_the_engine(spark):
    db = scratch_database(spark, "text")
    rows = spark.createDataFrame([(1, "a\r\nb\tc")], "id int, note string")
    for engine, text in (("Sqoop", "ab\tc"), ("datax", "a b c"), (None, "a\r\nb\tc")):
        own = task(db, f"src_{engine}_x", exec_engine=engine)
        importing.import_table(spark, own, rows.where, unique=False)
        assert spark.table(own.target).first()["note"] == text
