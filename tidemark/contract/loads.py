"""Loads that must lose nothing: wide keys, described types, loaded partitions, whole plans."""

import datetime as dt

from pyspark.sql import functions as F

from ..functions.names import split_name
from ..plans import importing, registry, running
from ..plans.exporting import export_table
from ..session import scratch_database
from ..sinks import tables as sink
from .base import given, query
from .unique import ETL_TIME, etl_time

WIDE = 9007199254740992
WIDE_SQL = f"CAST(l_orderkey AS DECIMAL(20,0)) + {WIDE}"


@query(f"""
SELECT CAST(CAST({WIDE_SQL} AS DECIMAL(20,0)) AS VARCHAR) AS id, l_linenumber AS orgid,
       max(CAST(l_shipdate AS VARCHAR)) AS updatetime, TIMESTAMP '{ETL_TIME}' AS etl_time
FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def import_unsigned(spark, sf_dir):
    """Unsigned keys beyond 2**53, imported and deduplicated; every key survives."""
    database = scratch_database(spark, "import_unsigned")
    lines = given(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") + F.lit(WIDE)).cast("decimal(20,0)").alias("id"),
        F.col("l_linenumber").alias("orgid"),
        F.col("l_shipdate").alias("updatetime"),
    )
    described = [("id", "bigint(20) unsigned"), ("orgid", "int(11)"), ("updatetime", "datetime")]
    task = importing.ImportTask("crm", "lines", database, "src_chongdun_lines", is_overwrite="1")
    importing.import_table(spark, task, lines.where, described, etl_time=etl_time())
    sink.drop_table(spark, task.target)
    return spark.table(f"{database}.ods_chongdun_lines").withColumn("id", F.col("id").cast("string"))


@query("SELECT l_orderkey, l_linenumber, CAST(l_orderkey % 256 AS SMALLINT) AS level FROM lineitem")
def import_sqlserver(spark, sf_dir):
    """SQL Server's tinyint, which runs to 255."""
    table = f"{scratch_database(spark, 'import_sqlserver')}.src_erp_lines"
    lines = given(spark, sf_dir, "lineitem")
    lines = lines.select("l_orderkey", "l_linenumber", (F.col("l_orderkey") % 256).cast("smallint").alias("level"))
    described = [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("level", "tinyint")]
    task = importing.ImportTask("erp", "lines", *split_name(table))
    importing.import_table(spark, task, lines.where, described, unique=False, db_type="sqlserver")
    return spark.table(table)


EXACT_SQL = """
SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS price,
       CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS VARCHAR) AS paid"""


@query(f"{EXACT_SQL}, 'sqlserver' AS db_type FROM lineitem UNION ALL {EXACT_SQL}, 'oracle' FROM lineitem")
def import_exact(spark, sf_dir):
    """Prices as two databases describe them, kept exact."""
    price = F.col("l_extendedprice")
    lines = given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", price.cast("decimal(15,2)").alias("price"), price.cast("decimal(19,4)").alias("paid")
    )
    database = scratch_database(spark, "import_exact")
    for db_type, kinds in (("sqlserver", ("numeric(15,2)", "money")), ("oracle", ("NUMBER(15,2)", "NUMBER(19,4)"))):
        described = [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("price", kinds[0]), ("paid", kinds[1])]
        task = importing.ImportTask("erp", "lines", database, f"src_{db_type}_lines")
        importing.import_table(spark, task, lines.where, described, unique=False, exact_decimals=True, db_type=db_type)
    text = {name: F.col(name).cast("string") for name in ("price", "paid")}
    kept = [
        spark.table(f"{database}.src_{kind}_lines").withColumns({**text, "db_type": F.lit(kind)})
        for kind in ("sqlserver", "oracle")
    ]
    return kept[0].unionByName(kept[1])


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def export_long_text(spark, sf_dir):
    """Documents out and back, whole."""
    database = scratch_database(spark, "export_long_text")
    source, target = f"{database}.final_documents", f"spark_catalog.{database}.documents"
    sink.ctas_replace(given(spark, sf_dir, "documents"), source)
    export_table(spark, source, target, "overwrite", text_type="string")
    return spark.table(target)


@query("SELECT s_suppkey AS id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier")
def overwrite_all_partitions(spark, sf_dir):
    """A table is replaced whole, whatever the session does with partitions."""
    table = f"{scratch_database(spark, 'overwrite_all_partitions')}.party"
    sink.create_table(spark, table, [("id", "bigint"), ("name", "string")], "nation")
    customer, supplier = given(spark, sf_dir, "customer", "supplier")
    for name, old in (("c_custkey", customer), ("s_suppkey", supplier)):
        mark = name[:2]
        rows = old.select(F.col(name).alias("id"), F.col(f"{mark}name").alias("name"), F.col(f"{mark}nationkey").cast("string").alias("nation"))
        with sink._session_setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            sink.overwrite_table(rows, table)
    return spark.table(table)


@query(f"""
SELECT o_orderkey, o_custkey, o_totalprice, 'first' AS part, TIMESTAMP '{ETL_TIME}' AS etl_time FROM orders""")
def snapshot_of_loaded_partition(spark, sf_dir):
    """The current table shows the partition that was loaded, here one with a name of its own."""
    database = scratch_database(spark, "snapshot_of_loaded_partition")
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    task = importing.ImportTask(
        "sales", "orders", database, "src_sales_orders", is_overwrite="1",
        hive_partition_key="part", hive_partition_value="first",
    )
    importing.import_table(spark, task, orders.where, day=dt.date(2024, 1, 2), etl_time=etl_time())
    return spark.table(f"{database}.ods_sales_orders")


@query("SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id FROM events")
def import_into_empty_target(spark, sf_dir):
    """An incremental load by time into a table that is there and empty."""
    database = scratch_database(spark, "import_into_empty_target")
    events = given(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    task = importing.ImportTask(
        "log", "events", database, "src_log_events", filter="ts > '{max_value}'", max_value="max(ts)"
    )
    importing.import_table(spark, task, events.where("event_id < 0").where, unique=False)
    importing.import_table(spark, task, events.where, unique=False)
    return spark.table(f"{database}.src_log_events")


@query("""
SELECT doc_id, replace(replace(replace(text, chr(10), ''), chr(13), ''), chr(1), '') AS text, 'sqoop' AS engine
FROM documents UNION ALL
SELECT doc_id, regexp_replace(text, '\r\n|[\r\n\t]', ' ', 'g'), 'datax' FROM documents UNION ALL
SELECT doc_id, text, 'spark' FROM documents""")
def import_text(spark, sf_dir):
    """Texts under each engine's policy for line breaks."""
    database = scratch_database(spark, "import_text")
    docs, loaded = given(spark, sf_dir, "documents").select("doc_id", "text"), []
    for engine in ("sqoop", "datax", "spark"):
        task = importing.ImportTask("web", "documents", database, f"src_{engine}_documents", exec_engine=engine)
        importing.import_table(spark, task, docs.where, unique=False)
        loaded.append(spark.table(task.target).withColumn("engine", F.lit(engine)))
    return loaded[0].unionByName(loaded[1]).unionByName(loaded[2])


PLAN_TABLES = ("supplier", "nation", "customer", "region")


@query(
    " UNION ALL ".join(
        f"SELECT {k} AS id, '{name}' AS table_name, '2024-01-02' AS last_exec_date, count(*) AS n FROM {name}"
        for k, name in enumerate(PLAN_TABLES, 1)
    )
)
def run_plan(spark, sf_dir):
    """A registry's tables imported by its plan; the day's second plan is empty."""
    database = scratch_database(spark, "run_plan")
    ledger = f"{database}.runs"
    sink.create_table(spark, ledger, [tuple(c.split()) for c in registry.LEDGER.split(",")])
    connections = spark.createDataFrame([("01", "sales", "1")], "connection_id string, connection_name string, status string")
    rows = [(k, "01", "sales", name, "2024-01-01", None, "1") for k, name in enumerate(PLAN_TABLES, 1)]
    registered = spark.createDataFrame(
        rows,
        "id int, connection_id string, db_name string, table_name string, last_exec_date string, task_order int, status string",
    )

    def load(row):
        task = importing.ImportTask(row["db_name"], row["table_name"], database, f"src_sales_{row['table_name']}")
        importing.import_table(spark, task, given(spark, sf_dir, row["table_name"]).where, unique=False)

    for _ in range(2):
        plan = registry.sync_plan(connections, registered, "2024-01-02")
        registered = running.run_plan(spark, plan, registered, load, ledger, "2024-01-02")
    counts = registry.table_rowcounts({name: spark.table(f"{database}.src_sales_{name}") for name in PLAN_TABLES})
    return registered.join(counts, "table_name").select("id", "table_name", "last_exec_date", F.col("table_rows").alias("n"))
