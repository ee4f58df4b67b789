import pytest
from pyspark.sql import functions as F

from tidemark.operators.projections import project_common
from tidemark.operators.routing import (
    enrich_dim,
    merge_middle,
    merge_routed,
    route_migrated,
    route_not_migrated,
    routing_dimension,
    union_all,
)
from tidemark.plans.merge import MERGE_TABLES, merge_dispatch, merge_table
from tidemark.session import scratch_database

DIM = "clinic_id bigint, pmsweb_id bigint, brand_code string, clinic_name string"


@pytest.fixture(scope="module")
def dimension(spark):
    return routing_dimension(spark.createDataFrame([(1, None, "b1", "one"), (2, 20, "b2", "two")], DIM))


@pytest.fixture(scope="module")
def lineages(spark):
    rows = [(10, 1), (11, 2), (12, 3), (13, None)]
    old = spark.createDataFrame([(i, o, "old", 1) for i, o in rows], "id int, orgid bigint, source string, extra int")
    new = spark.createDataFrame([("x", i, o, "new") for i, o in rows], "other string, id int, orgid bigint, source string")
    return old, new


def ids(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_routes(dimension, lineages):
    old, new = lineages
    assert ids(route_not_migrated(old, dimension), "id") == [(10,), (12,), (13,)]
    assert ids(route_migrated(new, dimension), "id") == [(11,)]


def test_unknown_clinics_stay_in_the_middle_only(dimension, lineages):
    middle = merge_middle(*lineages, dimension)
    assert ids(middle, "id", "source") == [(10, "old"), (11, "new"), (12, "old"), (13, "old")]
    merged = merge_routed(*lineages, dimension)
    assert ids(merged, "id", "source", "clinic_name") == [(10, "old", "one"), (11, "new", "two")]
    assert merged.columns == ["brand_code", "clinic_name", "id", "orgid", "source"]


def test_one_join_equals_the_three_steps(dimension, lineages):
    steps = enrich_dim(merge_middle(*lineages, dimension), dimension)
    once = merge_routed(*lineages, dimension)
    assert steps.columns == once.columns and ids(steps, *steps.columns) == ids(once, *once.columns)


def test_each_clinic_comes_from_one_lineage(dimension, lineages):
    seen = merge_routed(*lineages, dimension).groupBy("orgid").agg(F.countDistinct("source").alias("n"))
    assert seen.where("n <> 1").count() == 0


def test_repeated_clinic_is_refused(spark):
    with pytest.raises(ValueError, match="clinic_id is not unique"):
        routing_dimension(spark.createDataFrame([(1, None, "b", "x"), (1, 2, "b", "y")], DIM))


def test_union_all_types(spark):
    left = spark.createDataFrame([(1, 1, "a", True)], "id int, code int, Name string, flag boolean")
    right = spark.createDataFrame([(2**40, "x", "b", 1)], "id bigint, code string, name string, flag int")
    both = union_all(left, right)
    assert both.dtypes == [("id", "bigint"), ("code", "string"), ("Name", "string"), ("flag", "string")]
    assert ids(both, "id", "code", "flag") == [(1, "1", "true"), (2**40, "x", "1")]


def test_project_common_needs_a_shared_column(spark):
    with pytest.raises(ValueError):
        project_common(spark.range(1), spark.range(1).toDF("x"))


def test_merge_dispatch():
    found = {t: merge_dispatch(f"pet_medical.ods_pms_{t.lower()}") for t in MERGE_TABLES}
    assert len(MERGE_TABLES) == 39
    assert [t for t, b in found.items() if b == "prefer_new"] == ["SysCategory"]
    assert [t for t, b in found.items() if b == "routed_self"] == ["PClientManagement"]
    assert {t for t, b in found.items() if b == "passthrough"} == {
        "CEMRecord", "CPrescriptions", "CPrescriptionDetails", "CEMRecordPhysical", "CLabReport", "CLabVirusDetails",
        "PBCheckList", "PXRaysList", "PPathologyList",
    }
    assert merge_dispatch("pet_medical.ods_pms_CPhysical") == "passthrough"
    assert merge_dispatch("pet_medical.ods_pms_ppets") == "routed"


def test_merge_table(spark, dimension, lineages):
    db, final = scratch_database(spark, "dw"), scratch_database(spark, "final")
    old, new = lineages
    for name, df in (("ods_pms_ppets", old), ("ods_pmsweb_ppets", new), ("ods_pms_cemrecord", old),
                     ("ods_pmsweb_syscategory", new), ("ods_pms_pclientmanagement", old.drop("orgid").withColumn("id", F.col("id") - 9)),
                     ("ods_pmsweb_pclientmanagement", new.withColumn("id", F.col("id") - 9))):
        df.write.format("orc").saveAsTable(f"{db}.{name}")
    table = merge_table(spark, f"{db}.ods_pms_ppets", dimension, final)
    assert ids(spark.table(table), "id", "source") == [(10, "old"), (11, "new")]
    assert not spark.catalog.tableExists(f"{db}.mid_ppets")
    merge_table(spark, f"{db}.ods_pms_ppets", dimension, final, keep_layers=True)
    assert ids(spark.table(table), "id", "source") == [(10, "old"), (11, "new")]
    assert spark.table(f"{db}.mid_ppets").count() == 4 and spark.table(f"{db}.mir_ppets").count() == 2
    assert spark.table(merge_table(spark, f"{db}.ods_pms_cemrecord", dimension, final)).count() == 4
    assert "other" in spark.table(merge_table(spark, f"{db}.ods_pms_syscategory", dimension, final)).columns
    own = spark.table(merge_table(spark, f"{db}.ods_pms_pclientmanagement", dimension, final))
    assert ids(own, "id", "source", "brand_code") == [(1, "old", "b1"), (2, "new", "b2")]
    with pytest.raises(ValueError):
        merge_table(spark, f"{db}.src_pms_ppets", dimension, final)


def test_hot_clinic_is_split(spark):
    """A clinic with a third of the rows, and a dimension too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    clinic = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
    old = spark.range(200_000, numPartitions=8).select("id", clinic.alias("orgid"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    dim = spark.range(1000).select(
        F.col("id").alias("clinic_id"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("pmsweb_id"),
        F.lit("b").alias("brand_code"), F.col("id").cast("string").alias("clinic_name"),
    )
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        merged = merge_routed(old, old, routing_dimension(dim))
        assert merged.count() == 200_000
        rows = merged.groupBy("orgid").count().where("orgid = 7").first()["count"]
        wide = merged.select(*merged.columns)
        wide.write.format("noop").mode("overwrite").save()
        executed = merged._jdf.queryExecution().executedPlan()
        merged.collect()
        plan = executed.toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert rows >= 66_666
    assert "isSkew=true" in plan or "skewed" in plan
