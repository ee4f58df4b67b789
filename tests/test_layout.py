"""Stored layouts and counts from the files' own figures."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import layout
from tidemark.operators.routing import merge_routed, routing_dimension
from tidemark.plans import registry
from tidemark.session import scratch_database


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_merge_without_a_shuffle_of_the_large_sides(spark, no_broadcast):
    db = scratch_database(spark, "layout")
    clinics = spark.range(200).select(
        F.col("id").cast("int").alias("clinic_id"), F.when(F.col("id") % 2 == 1, F.col("id")).alias("pmsweb_id"),
        F.concat(F.lit("b"), "id").alias("brand_code"), F.lit("n").alias("clinic_name"),
    )
    dimension = routing_dimension(clinics)
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 230).cast("int")  # a third of all rows are clinic 7's
    old = spark.range(3000).withColumn("orgid", hot).withColumn("note", F.lit("x"))
    new = spark.range(5000, 9000).withColumn("orgid", hot).withColumn("extra", F.lit(1))
    layout.store_salted(old, f"{db}.old", "orgid", ["id"])
    layout.store_salted(new, f"{db}.new", "orgid", ["id"])
    merged = layout.merge_stored(spark, f"{db}.old", f"{db}.new", dimension)
    want = merge_routed(old, new, dimension)
    assert merged.columns == want.columns
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, want.collect()))
    plan = merged._jdf.queryExecution().optimizedPlan().toString() + merged._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan
    lines = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()
    for k, line in enumerate(lines):
        if "Exchange" in line:  # below it lies the dimension only
            depth = len(line) - len(line.lstrip(" :+-"))
            below = []
            for other in lines[k + 1 :]:
                if len(other) - len(other.lstrip(" :+-")) <= depth:
                    break
                below.append(other)
            assert "FileScan" not in "".join(below)
    parts = [r["count"] for r in spark.table(f"{db}.new").where("orgid = 7").groupBy(layout.SALT).count().collect()]
    assert len(parts) == layout.SALTS and max(parts) < 1.5 * sum(parts) / len(parts)
    with pytest.raises(ValueError, match="own column"):
        layout.store_salted(spark.table(f"{db}.old"), f"{db}.again", "orgid", ["id"])


def test_counts_from_footers(spark, tmp_path):
    db = scratch_database(spark, "footers")
    rows = spark.range(1000).withColumn("part", F.col("id") % 3)
    for fmt in ("orc", "parquet"):
        rows.write.format(fmt).partitionBy("part").saveAsTable(f"{db}.{fmt}_t")
        counted = registry.footer_count(spark, f"{db}.{fmt}_t")
        assert "PushedAggregation: [COUNT(*)]" in counted._jdf.queryExecution().executedPlan().toString()
        assert counted.first()["table_rows"] == 1000
    rows.write.format("json").saveAsTable(f"{db}.json_t")
    spark.sql(f"CREATE VIEW {db}.seen AS SELECT * FROM {db}.orc_t WHERE part = 1")
    for name, n in (("json_t", 1000), ("seen", 333)):
        assert registry.footer_count(spark, f"{db}.{name}").first()["table_rows"] == n
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    found = registry.warehouse_rowcounts(spark, [f"{db}.orc_t", f"{db}.seen", f"{db}.none"])
    assert sorted((r["table_name"].split(".")[1], r["table_rows"]) for r in found.collect()) == [("none", None), ("orc_t", 1000), ("seen", 333)]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
