import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.text import drop_delims
from tidemark.session import scratch_database, scratch_folder
from tidemark.sinks import tables as sink
from tidemark.sinks.text import read_delimited, write_delimited
from tidemark.sources.tables import (
    describe_columns,
    fill_filter,
    high_water_mark,
    incremental_filter,
    list_source_tables,
    partition_scan,
    read_mark,
)


@pytest.fixture()
def db(spark):
    return scratch_database(spark, "t")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def numbers(spark, *values):
    return spark.createDataFrame([(v, str(v)) for v in values], "id int, name string")


def test_create_describe_add(spark, db):
    table = f"{db}.src_t"
    assert describe_columns(spark, table) == []
    sink.create_table(spark, table, [("ID", "int"), ("Name", "string")], "Date")
    sink.create_table(spark, table, [("other", "int")])
    assert describe_columns(spark, table) == [("id", "int"), ("name", "string")]
    sink.overwrite_partition(numbers(spark, 1), table, "date", "20240101")
    sink.add_columns(spark, table, [("Paid", "double")])
    assert describe_columns(spark, table)[-1] == ("paid", "double")
    assert spark.table(table).first()["paid"] is None
    assert [r["table_name"] for r in list_source_tables(spark, db).collect()] == ["src_t"]


def test_partitions(spark, db):
    table = f"{db}.p"
    sink.create_table(spark, table, [("id", "int"), ("name", "string")], "date")
    sink.overwrite_partition(numbers(spark, 1, 2), table, "date", "20240101")
    sink.overwrite_partition(numbers(spark, 3), table, "date", "20240102")
    sink.overwrite_partition(numbers(spark, 4), table, "date", "20240102", append=True)
    assert ids(partition_scan(spark.table(table), "date", "20240102")) == [3, 4]
    sink.overwrite_partition(numbers(spark, 5), table, "date", "20240102")
    assert ids(spark.table(table)) == [1, 2, 5]
    sink.overwrite_partition(numbers(spark, 9).where("id < 0"), table, "date", "20240102")
    assert ids(spark.table(table)) == [1, 2]
    sink.add_partition(spark, table, "date", "it's {odd}")
    sink.overwrite_partition(numbers(spark, 6), table, "date", "it's {odd}")
    assert ids(partition_scan(spark.table(table), "date", "it's {odd}")) == [6]
    sink.drop_partition(spark, table, "date", "20240101")
    sink.drop_partition(spark, table, "date", "20240101")
    assert ids(spark.table(table)) == [6]


def test_only_the_partitions_in_the_rows_are_replaced(spark, db):
    table = f"{db}.some"
    sink.create_table(spark, table, [("id", "int"), ("name", "string")], "date")
    sink.overwrite_partitions(numbers(spark, 1, 2, 3).withColumn("date", F.col("name")), table, "date")
    sink.overwrite_partitions(numbers(spark, 7).withColumn("date", F.lit("2")), table, "date")
    assert ids(spark.table(table)) == [1, 3, 7]
    sink.overwrite_partitions(numbers(spark, 8).withColumn("date", F.lit("2")), table, "date", append=True)
    assert ids(spark.table(table)) == [1, 3, 7, 8]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    sink.overwrite_table(numbers(spark, 9).withColumn("date", F.lit("9")), table)
    assert ids(spark.table(table)) == [9]


def test_partition_scan_reads_only_its_files(spark, db):
    table = f"{db}.pruned"
    sink.create_table(spark, table, [("id", "int"), ("name", "string")], "date")
    sink.overwrite_partitions(numbers(spark, 1, 2, 3).withColumn("date", F.col("name")), table, "date")
    plan = partition_scan(spark.table(table), "date", "2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_large_partition_is_split_before_the_write(spark, db):
    table = f"{db}.hot"
    rows = spark.range(300_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 5).otherwise(0).cast("string").alias("date"),
                                       F.sha2(F.col("id").cast("string"), 256).alias("v"))
    sink.create_table(spark, table, [("id", "bigint"), ("v", "string")], "date")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        sink.overwrite_partitions(rows, table, "date")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.table(table).where("date = '0'").select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1 and spark.table(table).count() == 300_000


def test_write_by_name(spark, db):
    table = f"{db}.named"
    sink.create_table(spark, table, [("id", "int"), ("name", "string"), ("more", "double")])
    sink.append_table(numbers(spark, 1).select("name", F.col("id").alias("ID")), table)
    assert tuple(spark.table(table).first()) == (1, "1", None)
    with pytest.raises(ValueError, match="no column"):
        sink.append_table(numbers(spark, 1).withColumn("unknown", F.lit(1)), table)


def test_ctas_replace_reads_what_it_replaces(spark, db):
    table = f"{db}.self"
    sink.ctas_replace(numbers(spark, 1, 2, 3), table)
    sink.ctas_replace(spark.table(table).where("id > 1"), table)
    assert ids(spark.table(table)) == [2, 3]
    assert [r["table_name"] for r in list_source_tables(spark, db).collect()] == ["self"]


def test_ctas_replace_keeps_the_old_table_on_failure(spark, db):
    table = f"{db}.kept"
    sink.ctas_replace(numbers(spark, 1), table)
    broken = numbers(spark, 2).withColumn("name", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        sink.ctas_replace(broken, table)
    assert ids(spark.table(table)) == [1]
    # A program that ended between the two renames left the table aside.
    sink.rename_table(spark, table, f"{table}__previous")
    sink.ctas_replace(numbers(spark, 3), table)
    assert ids(spark.table(table)) == [3] and not spark.catalog.tableExists(f"{table}__previous")


def test_bucketed_tables_join_without_a_shuffle(spark, db):
    for name in ("a", "b"):
        sink.ctas_replace(numbers(spark, *range(50)), f"{db}.{name}", fmt="parquet", bucket_by=["id"], buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(f"{db}.a").join(spark.table(f"{db}.b"), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_drop_of_a_missing_table(spark, db):
    sink.drop_table(spark, f"{db}.nothing")


def test_high_water_mark(spark, db):
    table = f"{db}.marked"
    assert read_mark(spark, table, "max(id)") == 0
    sink.create_table(spark, table, [("id", "int"), ("name", "string")])
    assert read_mark(spark, table, "max(id)") == 0
    assert high_water_mark(spark.table(table), "max(id)").first()[0] == 0
    assert high_water_mark(spark.table(table), "max(name)", "0").first()[0] == "0"
    sink.append_table(numbers(spark, 3, 7), table)
    assert read_mark(spark, table, "max(id)") == 7
    assert high_water_mark(spark.table(table), "max(id)").first()[0] == 7
    newer = incremental_filter(numbers(spark, 6, 7, 8), spark.table(table), "id > {max_value}", "max(id)")
    assert ids(newer) == [8]
    again = incremental_filter(numbers(spark, 6, 7, 8), spark.table(table), "id >= {max_value}", "max(id)")
    assert ids(again) == [7, 8]
    assert fill_filter("a > '{max_value}' and b > '{max_value}'", "x") == "a > 'x' and b > 'x'"


def test_mark_reaches_the_scan(spark, db):
    numbers(spark, 1, 2, 3).write.format("orc").saveAsTable(f"{db}.src")
    newer = incremental_filter(spark.table(f"{db}.src"), numbers(spark, 2), "id > {max_value}", "max(id)")
    assert "GreaterThan(id,2)" in newer._jdf.queryExecution().executedPlan().toString()


def test_delimited_edges(spark):
    values = ["a\r\nb", "c\x01d", None, "", "\\N", 'quo"te', "back\\slash", ' "x", ', "\\", '\\"', "tab\t"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    for options in ({}, {"sep": ","}, {"sep": "\t"}, {"sep": "|", "line": ";"}, {"raw_null": False}):
        path = scratch_folder(spark, "text")
        write_delimited(df, path, **options)
        back = [r["v"] for r in read_delimited(spark, path, df.schema, **options).orderBy("id").collect()]
        expect = [None if v is None else v.replace("\r", "").replace("\n", "").replace("\x01", "") for v in values]
        if "raw_null" not in options:
            expect[4] = None
        assert back == expect, options


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab\"\\,' \x01\n", max_size=8), min_size=1, max_size=30))
def test_delimited_round_trip(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    path = scratch_folder(spark, "text")
    write_delimited(df, path, sep=",")
    back = read_delimited(spark, path, df.schema, sep=",").orderBy("id").collect()
    want = df.select("id", drop_delims("v").alias("v")).orderBy("id").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in want]
