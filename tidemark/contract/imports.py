"""Filters, high-water marks, clean-up and whole imports."""

import datetime as dt

from pyspark.sql import functions as F

from ..functions import dates, names, text, types
from ..operators import projections
from ..plans.importing import ImportTask
from ..plans.importing import import_table as run_import
from ..session import scratch_database
from ..sinks.tables import drop_table
from ..sources import tables as source
from .base import given, query
from .unique import ETL_TIME, etl_time


@query("""
SELECT * FROM lineitem WHERE l_shipdate > (SELECT max(o_orderdate) FROM orders)""")
def incremental_filter(spark, sf_dir):
    lines, orders = given(spark, sf_dir, "lineitem", "orders")
    return source.incremental_filter(lines, orders, "l_shipdate > '{max_value}'", "max(o_orderdate)")


@query("SELECT coalesce(max(l_shipdate), TIMESTAMP '1970-01-01') AS max_value FROM lineitem")
def high_water_mark(spark, sf_dir):
    return source.high_water_mark(given(spark, sf_dir, "lineitem"), "max(l_shipdate)")


@query("SELECT * FROM events WHERE strftime(ts, '%Y%m%d') = '20240102'")
def partition_snapshot(spark, sf_dir):
    return source.day_scan(given(spark, sf_dir, "events"), "ts", "20240102")


@query("SELECT doc_id, replace(replace(replace(text, chr(10), ''), chr(13), ''), chr(1), '') AS text FROM documents")
def drop_delims(spark, sf_dir):
    return given(spark, sf_dir, "documents").select("doc_id", text.drop_delims("text").alias("text"))


@query("SELECT doc_id, regexp_replace(text, '\\r\\n|[\\r\\n\\t]', ' ', 'g') AS text FROM documents")
def sanitize_text(spark, sf_dir):
    return given(spark, sf_dir, "documents").select("doc_id", text.sanitize_text("text").alias("text"))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""")
def normalize_types(spark, sf_dir):
    orders = given(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(15,2)"))
    return types.normalize_types(orders, {"o_orderkey": "string"})


@query("SELECT l_orderkey, l_linenumber, l_tax FROM lineitem")
def project_listed(spark, sf_dir):
    return projections.project_listed(given(spark, sf_dir, "lineitem"), ["L_TAX", "l_orderkey", " l_linenumber"])


@query("SELECT * EXCLUDE (props, value) FROM events")
def project_except(spark, sf_dir):
    return projections.project_except(given(spark, sf_dir, "events"), ["props", "value", "rank_tmp"])


@query("SELECT l_returnflag, l_orderkey, l_linenumber FROM lineitem")
def project_fixed_order(spark, sf_dir):
    return projections.project_fixed_order(given(spark, sf_dir, "lineitem"), ["l_returnflag", "l_orderkey", "l_linenumber"])


@query("SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, * EXCLUDE (l_orderkey) FROM lineitem")
def override_column_types(spark, sf_dir):
    return types.override_column_types(given(spark, sf_dir, "lineitem"), types.parse_overrides("L_ORDERKEY=string"))


@query("SELECT conv_id, turn, coalesce(trim(text, E' \\t\\r\\n') = '', TRUE) AS blank FROM conversations")
def is_blank(spark, sf_dir):
    return given(spark, sf_dir, "conversations").select("conv_id", "turn", text.is_blank("text").alias("blank"))


@query("SELECT conv_id, turn, lower(text) AS text FROM conversations")
def lower(spark, sf_dir):
    return given(spark, sf_dir, "conversations").select("conv_id", "turn", F.lower("text").alias("text"))


@query("SELECT * FROM conversations WHERE lower(role) = lower('USER')")
def filter_ci_equal(spark, sf_dir):
    return given(spark, sf_dir, "conversations").where(names.same_text("role", F.lit("USER")))


@query("SELECT doc_id, regexp_matches(text, '(?i)the|der|les') AS found FROM documents")
def regex_match(spark, sf_dir):
    return given(spark, sf_dir, "documents").select("doc_id", names.matches("text", "the|der|les").alias("found"))


@query("SELECT page_id, regexp_replace(url || '(' || page_id || ',2)', '\\(.*', '') AS name FROM pages")
def regex_strip(spark, sf_dir):
    typed = F.concat("url", F.lit("("), "page_id", F.lit(",2)"))
    return given(spark, sf_dir, "pages").select("page_id", types.base_type(typed).alias("name"))


@query("SELECT c_custkey, 'dw.ods_' || lower(c_mktsegment) || '_src_' || c_name AS name FROM customer")
def replace_layer(spark, sf_dir):
    name = F.concat(F.lit("dw."), names.concat_name(F.lower("c_mktsegment"), F.concat(F.lit("src_"), "c_name")))
    return given(spark, sf_dir, "customer").select("c_custkey", names.replace_layer(name, "src_", "ods_").alias("name"))


@query("SELECT c_custkey, 'src_' || c_mktsegment || '_' || c_name AS name FROM customer")
def concat_name(spark, sf_dir):
    name = names.concat_name(F.col("c_mktsegment"), F.col("c_name"))
    return given(spark, sf_dir, "customer").select("c_custkey", name.alias("name"))


@query("SELECT c_custkey, lower(c_mktsegment) AS db FROM customer")
def substr_locate(spark, sf_dir):
    name = names.concat_name(F.lower("c_mktsegment"), F.concat(F.lit("x_"), "c_name"))
    return given(spark, sf_dir, "customer").select("c_custkey", names.database_part(name).alias("db"))


@query("SELECT l_orderkey, l_linenumber, strftime(l_shipdate - INTERVAL 1 DAY, '%Y%m%d') AS day_before FROM lineitem")
def yesterday(spark, sf_dir):
    before = dates.yesterday(F.col("l_shipdate")).alias("day_before")
    return given(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", before)


@query("""
SELECT o_orderkey, try_strptime(strftime(o_orderdate, '%Y%m') ||
  CASE o_orderstatus WHEN 'F' THEN '31' WHEN 'O' THEN '15' ELSE '1x' END, '%Y%m%d') AS day FROM orders""")
def parse_date(spark, sf_dir):
    day = F.when(F.col("o_orderstatus") == "F", "31").when(F.col("o_orderstatus") == "O", "15").otherwise("1x")
    written = F.concat(F.date_format("o_orderdate", "yyyyMM"), day)
    return given(spark, sf_dir, "orders").select("o_orderkey", dates.parse_date(written).cast("timestamp_ntz").alias("day"))


@query("""
SELECT doc_id, array_to_string([trim(x) FOR x IN string_split(lang || ', ' || source, ',')], '|') AS items
FROM documents""")
def split_list(spark, sf_dir):
    items = text.split_list(F.concat("lang", F.lit(", "), "source"))
    return given(spark, sf_dir, "documents").select("doc_id", F.array_join(items, "|").alias("items"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity > 10 THEN l_extendedprice END AS price FROM lineitem""")
def nan_to_null(spark, sf_dir):
    price = F.when(F.col("l_quantity") > 10, F.col("l_extendedprice")).otherwise(F.lit(float("nan")))
    kept = ("l_orderkey", "l_linenumber", "l_partkey")
    return given(spark, sf_dir, "lineitem").select(*kept, text.nan_to_null(price).alias("price"))


@query(f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
       o_orderpriority, '20240101' AS date, TIMESTAMP '{ETL_TIME}' AS etl_time
FROM orders""")
def import_table(spark, sf_dir):
    """Full load of one partition, then the snapshot of that partition."""
    database = scratch_database(spark, "import_table")
    task = ImportTask(
        "sales", "orders", database, "src_sales_orders", is_overwrite="1",
        hive_partition_key="date", hive_partition_value="$yesterday",
    )
    orders = given(spark, sf_dir, "orders")
    run_import(spark, task, orders.where, day=dt.date(2024, 1, 2), etl_time=etl_time())
    drop_table(spark, task.target)
    return spark.table(f"{database}.ods_sales_orders")


@query(f"""
WITH log AS (SELECT user_id AS id, event_type AS orgid, CAST(ts AS VARCHAR) AS updatestamp, event_id, value, props
             FROM events WHERE event_type <> 'error'),
     a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, orgid ORDER BY updatestamp DESC NULLS LAST)
             AS rn FROM log) WHERE rn = 1),
     b AS (SELECT user_id AS p_id, CAST(max(ts) AS VARCHAR) AS p_ts FROM events
             WHERE event_type = 'error' GROUP BY user_id)
SELECT id, orgid, updatestamp, event_id, value, props, TIMESTAMP '{ETL_TIME}' AS etl_time
FROM a LEFT JOIN b ON a.id = b.p_id AND a.orgid = 'view' WHERE b.p_ts IS NULL OR a.updatestamp > b.p_ts""")
def import_incremental(spark, sf_dir):
    """Tombstones first, then a first load and a load from the mark on."""
    database = scratch_database(spark, "import_incremental")
    events = given(spark, sf_dir, "events")
    deletes = events.where("event_type = 'error'").select(
        F.lit("Visits").alias("tablename"),
        F.col("user_id").alias("p_id"),
        F.lit("view").alias("p_orgid"),
        F.col("ts").alias("updatestamp"),
    )
    run_import(spark, ImportTask("pms", "warm_deleted", database, "src_pms_warm_deleted"), deletes.where)
    visits = events.where("event_type <> 'error'").select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("orgid"),
        F.col("ts").alias("updatestamp"),
        "event_id",
        "value",
        "props",
    )
    task = ImportTask(
        "pms", "visits", database, "src_pms_visits",
        filter="updatestamp > '{max_value}'", max_value="max(updatestamp)",
    )
    run_import(spark, task, visits.where("updatestamp < '2024-01-16'").where, unique=False)
    run_import(spark, task, visits.where, etl_time=etl_time())
    drop_table(spark, task.target)
    return spark.table(f"{database}.ods_pms_visits")
