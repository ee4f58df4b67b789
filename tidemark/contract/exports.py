"""Export modes against a catalog target, read back.

The target here is the session's own catalog; a database differs only in the
catalog part of the name.
"""

import datetime as dt

from pyspark.sql import functions as F

from ..plans.exporting import export_table as run_export
from ..session import scratch_database
from ..sinks import export as sink
from ..sinks import tables
from .base import given, query
from .tables import CUSTOMERS_SQL, SUPPLIERS_SQL, customers, suppliers


def _target(spark, sf_dir, label):
    """A target that holds the customers already."""
    target = f"spark_catalog.{scratch_database(spark, label)}.party"
    sink.export_create_target(spark, customers(spark, sf_dir), target)
    sink.export_append(customers(spark, sf_dir), target)
    return target


@query(f"{CUSTOMERS_SQL} UNION ALL {SUPPLIERS_SQL}")
def export_append(spark, sf_dir):
    target = _target(spark, sf_dir, "export_append")
    sink.export_append(suppliers(spark, sf_dir), target)
    return spark.table(target)


@query(SUPPLIERS_SQL)
def export_overwrite(spark, sf_dir):
    target = _target(spark, sf_dir, "export_overwrite")
    sink.export_overwrite(suppliers(spark, sf_dir), target)
    return spark.table(target)


@query(f"""
SELECT *, 'current' AS held FROM ({SUPPLIERS_SQL}) UNION ALL SELECT *, 'backup' AS held FROM ({CUSTOMERS_SQL})""")
def export_rename(spark, sf_dir):
    target = _target(spark, sf_dir, "export_rename")
    sink.export_rename(suppliers(spark, sf_dir), target, "20240102", "20240101")
    backup = spark.table(f"{target}_20240101_bak").withColumn("held", F.lit("backup"))
    return spark.table(target).withColumn("held", F.lit("current")).unionByName(backup)


@query("""
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""")
def export_create_target(spark, sf_dir):
    database = scratch_database(spark, "export_create_target")
    target = f"spark_catalog.{database}.orders"
    orders = given(spark, sf_dir, "orders")
    sink.export_create_target(spark, orders, target)
    sink.create_target_like(spark, f"{target}_20240102", target)
    sink.jdbc_export_insert(orders, f"{target}_20240102")
    return spark.table(f"{target}_20240102")


@query(f"""
SELECT *, 'party' AS table_name FROM ({CUSTOMERS_SQL}) UNION ALL
SELECT *, 'party_20240102_bak' FROM ({CUSTOMERS_SQL})""")
def export_table(spark, sf_dir):
    """Two daily exports in rename mode; the first day's backup is dropped."""
    database = scratch_database(spark, "export_table")
    source, target = f"{database}.final_party", f"spark_catalog.{database}.party"
    tables.ctas_replace(customers(spark, sf_dir), source)
    for day in (2, 3):
        run_export(spark, source, target, "rename", day=dt.date(2024, 1, day))
    tables.drop_table(spark, source)
    names = spark.sql(f"SHOW TABLES IN `{database}` LIKE 'party*'").collect()
    held = [spark.table(f"{database}.{n['tableName']}").withColumn("table_name", F.lit(n["tableName"])) for n in names]
    return held[0].unionByName(held[1])


@query(f"SELECT * EXCLUDE (segment) FROM ({CUSTOMERS_SQL})")
def create_target_like(spark, sf_dir):
    """A staging table takes the target's columns, not those of the rows."""
    database = scratch_database(spark, "create_target_like")
    target, rows = f"spark_catalog.{database}.party", customers(spark, sf_dir).drop("segment")
    sink.export_create_target(spark, rows, target)
    sink.create_target_like(spark, f"{target}_20240102", target)
    sink.jdbc_export_insert(rows.select("balance", "id", "name", "nation"), f"{target}_20240102")
    return spark.table(f"{target}_20240102")
