"""Warehouse writes, read back."""

from pyspark.sql import functions as F

from ..functions.types import import_type
from ..session import scratch_database, scratch_folder
from ..sinks import tables as sink
from ..sinks import text as text_sink
from ..sources.tables import partition_scan as one_partition
from ..sources.tables import warehouse_scan as scan
from .base import given, query

PARTY = ("id", "name", "nation", "balance")


def customers(spark, sf_dir):
    return given(spark, sf_dir, "customer").toDF(*PARTY, "segment")


def suppliers(spark, sf_dir):
    return given(spark, sf_dir, "supplier").toDF(*PARTY)


CUSTOMERS_SQL = (
    "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment"
    " FROM customer"
)
SUPPLIERS_SQL = (
    "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment"
    " FROM supplier"
)
DAYS_SQL = "SELECT event_id, user_id, value, strftime(ts, '%Y%m%d') AS date FROM events"


def _days(spark, sf_dir):
    return given(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", F.date_format("ts", "yyyyMMdd").alias("date")
    )


def _partitioned(spark, sf_dir, label):
    """Events stored by day."""
    table = f"{scratch_database(spark, label)}.days"
    rows = _days(spark, sf_dir)
    sink.create_table(spark, table, rows.drop("date").dtypes, partition_key="date")
    sink.overwrite_partitions(rows, table, "date")
    return table


@query(f"SELECT * FROM ({DAYS_SQL}) WHERE date = '20240102'")
def partition_scan(spark, sf_dir):
    """One stored partition; the others' files are not read."""
    return one_partition(scan(spark, _partitioned(spark, sf_dir, "partition_scan")), "date", "20240102")


@query(f"{CUSTOMERS_SQL} UNION ALL {SUPPLIERS_SQL}")
def append_table(spark, sf_dir):
    table = f"{scratch_database(spark, 'append_table')}.party"
    sink.create_table(spark, table, customers(spark, sf_dir).dtypes)
    sink.append_table(customers(spark, sf_dir), table)
    sink.append_table(suppliers(spark, sf_dir), table)
    return scan(spark, table)


@query(SUPPLIERS_SQL)
def overwrite_table(spark, sf_dir):
    table = f"{scratch_database(spark, 'overwrite_table')}.party"
    sink.create_table(spark, table, customers(spark, sf_dir).dtypes)
    sink.append_table(customers(spark, sf_dir), table)
    sink.overwrite_table(suppliers(spark, sf_dir), table)
    return scan(spark, table)


@query(SUPPLIERS_SQL)
def truncate_table(spark, sf_dir):
    table = f"{scratch_database(spark, 'truncate_table')}.party"
    sink.create_table(spark, table, customers(spark, sf_dir).dtypes)
    sink.append_table(customers(spark, sf_dir), table)
    sink.truncate_table(spark, table)
    sink.append_table(suppliers(spark, sf_dir), table)
    return scan(spark, table)


@query(f"""
SELECT event_id, user_id, CASE WHEN date = '20240102' THEN -value ELSE value END AS value, date FROM ({DAYS_SQL})""")
def overwrite_partition(spark, sf_dir):
    table = _partitioned(spark, sf_dir, "overwrite_partition")
    reload = _days(spark, sf_dir).where("date = '20240102'").withColumn("value", -F.col("value")).drop("date")
    sink.overwrite_partition(reload, table, "date", "20240102")
    return scan(spark, table)


@query(f"""
SELECT event_id, user_id, CASE WHEN date >= '20240116' THEN -value ELSE value END AS value, date FROM ({DAYS_SQL})""")
def overwrite_partitions(spark, sf_dir):
    """A second load corrects the later days and leaves the others alone."""
    table = _partitioned(spark, sf_dir, "overwrite_partitions")
    reload = _days(spark, sf_dir).where("date >= '20240116'").withColumn("value", -F.col("value"))
    sink.overwrite_partitions(reload, table, "date")
    return scan(spark, table)


@query(f"SELECT * FROM ({DAYS_SQL}) WHERE date <> '20240102'")
def drop_partition(spark, sf_dir):
    table = _partitioned(spark, sf_dir, "drop_partition")
    sink.drop_partition(spark, table, "date", "20240102")
    sink.drop_partition(spark, table, "date", "19000101")
    return scan(spark, table)


@query(f"SELECT * FROM ({DAYS_SQL}) UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal, '20240201' FROM supplier")
def add_partition(spark, sf_dir):
    table = _partitioned(spark, sf_dir, "add_partition")
    sink.add_partition(spark, table, "date", "20240201")
    sink.add_partition(spark, table, "date", "20240102")
    rows = suppliers(spark, sf_dir).toDF("event_id", "name", "user_id", "value").drop("name")
    sink.overwrite_partition(rows, table, "date", "20240201", append=True)
    return scan(spark, table)


@query("SELECT * FROM orders")
def rename_table(spark, sf_dir):
    database = scratch_database(spark, "rename_table")
    sink.ctas_replace(given(spark, sf_dir, "orders"), f"{database}.before")
    sink.rename_table(spark, f"{database}.before", f"{database}.after")
    sink.drop_table(spark, f"{database}.before")
    return scan(spark, f"{database}.after")


@query("SELECT * FROM lineitem")
def warehouse_scan(spark, sf_dir):
    table = f"{scratch_database(spark, 'warehouse_scan')}.lines"
    sink.ctas_replace(given(spark, sf_dir, "lineitem"), table)
    return scan(spark, table)


@query(SUPPLIERS_SQL)
def drop_table(spark, sf_dir):
    """A table is dropped and built anew with other columns."""
    table = f"{scratch_database(spark, 'drop_table')}.party"
    sink.drop_table(spark, table)
    sink.ctas_replace(given(spark, sf_dir, "customer"), table)
    sink.drop_table(spark, table)
    sink.create_table(spark, table, customers(spark, sf_dir).dtypes)
    sink.append_table(suppliers(spark, sf_dir), table)
    return scan(spark, table)


@query("SELECT * FROM orders WHERE o_orderstatus <> 'F'")
def ctas_replace(spark, sf_dir):
    """The second query reads the table that it replaces."""
    table = f"{scratch_database(spark, 'ctas_replace')}.orders"
    sink.ctas_replace(given(spark, sf_dir, "orders"), table)
    sink.ctas_replace(spark.table(table).where("o_orderstatus <> 'F'"), table)
    return scan(spark, table)


@query("SELECT * FROM lineitem")
def ctas_passthrough(spark, sf_dir):
    database = scratch_database(spark, "ctas_passthrough")
    sink.ctas_replace(given(spark, sf_dir, "lineitem"), f"{database}.ods_pms_cemrecord")
    sink.ctas_passthrough(spark, f"{database}.ods_pms_cemrecord", f"{database}.cemrecord")
    sink.drop_table(spark, f"{database}.ods_pms_cemrecord")
    return scan(spark, f"{database}.cemrecord")


@query("""
SELECT doc_id, replace(replace(replace(text, chr(10), ''), chr(13), ''), chr(1), '') AS text, lang, source, n_chars
FROM documents""")
def write_delimited(spark, sf_dir):
    documents = given(spark, sf_dir, "documents")
    path = scratch_folder(spark, "write_delimited")
    text_sink.write_delimited(documents, path)
    return text_sink.read_delimited(spark, path, documents.schema)


@query("""
SELECT c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN '' ELSE c_mktsegment END AS segment,
       CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance, ' ' || c_name || ' "' || chr(92) || ',' AS name
FROM customer""")
def raw_null_sentinel(spark, sf_dir):
    segment = F.col("c_mktsegment")
    rows = given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(segment == "MACHINERY", "").when(segment != "BUILDING", segment).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.concat(F.lit(" "), "c_name", F.lit(' "\\,')).alias("name"),
    )
    path = scratch_folder(spark, "raw_null_sentinel")
    text_sink.write_delimited(rows, path, sep=",")
    return text_sink.read_delimited(spark, path, rows.schema, sep=",")


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
       CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def create_import_target(spark, sf_dir):
    """A target of mapped types that gains a column between two loads."""
    table = f"{scratch_database(spark, 'create_import_target')}.src_orders"
    orders = given(spark, sf_dir, "orders")
    columns = [(name.upper(), import_type(kind)) for name, kind in orders.dtypes]
    sink.create_table(spark, table, columns[:-1])
    sink.append_table(orders.where("o_orderstatus <> 'P'").drop("o_orderpriority"), table)
    sink.add_columns(spark, table, columns[-1:])
    sink.append_table(orders.where("o_orderstatus = 'P'"), table)
    return scan(spark, table)
