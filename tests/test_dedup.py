import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_per_key, latest_tombstone, tombstone_join
from tidemark.plans.unique import (
    UniqueRule,
    current_name,
    is_incremental,
    unique_dispatch,
    unique_incremental,
    unique_latest,
    unique_snapshot,
    unique_table,
)

ROWS = "id int, orgid int, ts int"
DELETES = "tablename string, p_id int, p_orgid int, updatestamp int"


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_tombstone_edges(spark):
    log = spark.createDataFrame(
        [(1, 1, 5), (2, 1, 5), (3, 1, None), (4, 1, 9), (5, 1, 1), (None, 1, 3), (6, 1, 4), (7, None, 1)], ROWS
    )
    deletes = spark.createDataFrame(
        [("t", 1, 1, 5), ("t", 2, 1, 4), ("t", 3, 1, 2), ("t", 4, 1, None), ("t", None, 1, 9), ("t", 6, 1, 8),
         ("T", 6, 1, 2), ("other", 5, 1, 9), ("t", 7, None, 9)], DELETES,
    )
    kept = tombstone_join(log, latest_tombstone(deletes, "T"), ["id", "orgid"], "ts")
    assert rows(kept, "id") == sorted([(2,), (4,), (5,), (None,), (7,)], key=repr)


def test_latest_tombstone_prefers_a_dated_delete(spark):
    deletes = spark.createDataFrame([("t", 1, 1, None), ("t", 1, 1, 3), ("t", 1, 1, 2), ("t", 2, 1, None)], DELETES)
    assert rows(latest_tombstone(deletes, "t"), "p_id", "p_orgid", "p_updatestamp") == [(1, 1, 3), (2, 1, None)]


def test_latest_per_key_edges(spark):
    log = spark.createDataFrame(
        [(1, 1, 5, "a"), (1, 1, 5, "b"), (1, 1, None, "z"), (2, 1, None, "c"), (None, 1, 1, "d"), (None, 1, 2, "e")],
        "id int, orgid int, ts int, v string",
    )
    latest = latest_per_key(log, ["id", "orgid"], "ts", tie_break=["v"])
    assert rows(latest, "id", "ts", "v") == sorted([(1, 5, "b"), (2, None, "c"), (None, 2, "e")], key=repr)
    assert latest.columns == log.columns


def test_ties_without_tie_break_are_repeatable(spark):
    log = spark.range(2000).select((F.col("id") % 7).alias("k"), F.lit(1).alias("ts"), F.col("id").alias("v"))
    picks = {tuple(rows(latest_per_key(log.repartition(n), ["k"], "ts"), "k", "v")) for n in (1, 3, 8)}
    assert len(picks) == 1


def test_dedup_is_idempotent(spark):
    log = spark.range(500).select((F.col("id") % 40).alias("k"), (F.col("id") % 11).alias("ts"), F.col("id").alias("v"))
    once = latest_per_key(log, ["k"], "ts")
    assert rows(latest_per_key(once, ["k"], "ts"), "k", "v") == rows(once, "k", "v")


def test_hot_key_is_cut_before_the_shuffle(spark):
    """Each task may send one row per key, so a hot key cannot pile up."""
    log = spark.range(100_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("ts")
    )
    plan = latest_per_key(log, ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    before, _, after = plan.rpartition("Exchange hashpartitioning")
    assert "WindowGroupLimit" in before and "Partial" in after
    assert rows(latest_per_key(log, ["k"], "ts").where("k = 0"), "ts") == [(99_999,)]


def test_join_reuses_the_ranking_shuffle(spark):
    log = spark.range(1000).select("id", (F.col("id") % 5).alias("orgid"), F.col("id").alias("ts"))
    deletes = spark.createDataFrame([("t", 1, 1, 5)], "tablename string, p_id bigint, p_orgid bigint, updatestamp bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = unique_incremental(log, deletes, ["id", "orgid"], "ts", "t")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


PMS = ("id", "orgid")
DISPATCH = [
    ("pet_medical.src_pms_creg", True, UniqueRule("tombstones", PMS, "updatestamp", "pet_medical.src_pms_warm_deleted", "creg")),
    ("pet_medical.src_pms_creg", False, UniqueRule("snapshot")),
    ("pet_medical.src_pmsweb_PPets", True, UniqueRule("tombstones", PMS, "updatetimestamp", "pet_medical.src_pmsweb_warm_deleted", "PPets")),
    ("pet_medical.src_pms_sysicd10", True, UniqueRule("tombstones", ("icdcode", "orgid"), "updatestamp", "pet_medical.src_pms_warm_deleted", "sysicd10")),
    ("pet_medical.src_pms_operationlog", True, UniqueRule("tombstones", PMS, "updatetimestamp", "pet_medical.src_pms_warm_deleted", "operationlog")),
    ("pet_medical.src_pms_operationlogdetail", True, UniqueRule("snapshot")),
    ("pet_medical.src_his_case", True, UniqueRule("latest", PMS, "update_time")),
    ("pet_medical.src_his_case", False, UniqueRule("snapshot")),
    ("pet_medical.src_xunde_crm_customer", False, UniqueRule("latest", ("cus_logicid", "orgid"), "updatetime")),
    ("pet_medical.src_yichong_crm_pet", True, UniqueRule("latest", ("pet_logicid", "orgid"), "updatetime")),
    ("pet_medical.src_chongdun_clinic_case_regonly", True, UniqueRule("latest", ("regid", "orgid"), "updatetime")),
    ("pet_medical.src_lianchong_clinic_paymentdetails_book", True, UniqueRule("latest", ("id", "paymentid", "orgid"), "updatetime")),
    ("pet_medical.src_vetbuddy_clinic_product", True, UniqueRule("latest", PMS, "updatetime")),
    ("pet_medical.src_vetbuddy_clinic_payment_book", True, UniqueRule("snapshot")),
    ("pet_medical.src_erp_items", True, UniqueRule("snapshot")),
    ("pet_medical.src_pms_warm_deleted", True, UniqueRule("skip")),
]


@pytest.mark.parametrize("table,incremental,rule", DISPATCH)
def test_unique_dispatch(table, incremental, rule):
    assert unique_dispatch(table, incremental) == rule


@pytest.mark.parametrize("table", ["pet_medical.ods_pms_creg", "other.src_pms_creg", "src_pms_creg", "a.b.src_c"])
def test_other_layers_are_refused(table):
    with pytest.raises(ValueError):
        unique_dispatch(table, True)


def test_only_the_layer_prefix_is_replaced():
    assert current_name("dw.src_erp_src_items") == "dw.ods_erp_src_items"


def test_is_incremental(spark):
    df = spark.createDataFrame(
        [(1, "id > {max_value}", "max(id)"), (2, " ", "max(id)"), (3, "id > 1", None), (4, "\t　", ""), (5, "a", "b")],
        "id int, filter string, max_value string",
    )
    assert rows(df.where(is_incremental()), "id") == [(1,), (5,)]


def test_unique_table_by_rule(spark):
    log = spark.createDataFrame([(1, 1, 1), (1, 1, 2)], "id int, orgid int, update_time int")
    at = F.lit(dt.datetime(2024, 1, 1))
    rule = unique_dispatch("pet_medical.src_his_case", True)
    out = unique_table(log, rule, etl_time=at)
    assert rows(out, "update_time") == [(2,)] and out.columns[-1] == "etl_time"
    assert unique_table(log, UniqueRule("skip")) is None
    assert unique_table(log, UniqueRule("snapshot")).count() == 2
    with pytest.raises(ValueError):
        unique_table(log, unique_dispatch("pet_medical.src_pms_creg", True))


def test_etl_time_defaults_to_now(spark):
    df = unique_latest(spark.range(1).withColumn("ts", F.lit(1)), ["id"], "ts")
    assert abs((df.first()["etl_time"] - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 86_400


def test_snapshot_takes_one_partition(spark):
    df = spark.createDataFrame([(1, "20240101"), (2, "20240102")], "id int, date string")
    assert rows(unique_snapshot(df, "date", "20240102"), "id") == [(2,)]
    assert unique_snapshot(df).count() == 2
