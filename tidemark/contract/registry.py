"""Task plan, run ledger, row counts and registration, on large registries."""

from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..plans import registry as plan
from ..session import scratch_database
from ..sinks.export import expired_backups
from ..sinks.tables import create_table
from ..sources.tables import filter_name_prefix as with_prefix
from .base import given, query

TODAY = "2024-01-02"
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connections(spark, sf_dir):
    """Nations in the role of connections; those of region 4 are inactive."""
    return given(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("connection_id"),
        F.col("n_name").alias("connection_name"),
        F.when(F.col("n_regionkey") == 4, "0").otherwise("1").alias("status"),
    )


def tasks(spark, sf_dir):
    """Customers in the role of registered tables."""
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    return given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").cast("string").alias("connection_id"),
        F.lower("c_mktsegment").alias("db_name"),
        F.when((segment == "HOUSEHOLD") & (F.col("c_nationkey") == 0), "Warm_Deleted")
        .otherwise(F.col("c_name"))
        .alias("table_name"),
        F.when(balance >= 0, F.floor(balance / 100).cast("int")).alias("task_order"),
        F.when(segment == "BUILDING", TODAY).when(segment == "MACHINERY", "2024-01-01").when(segment == "AUTOMOBILE", "")
        .alias("last_exec_date"),
        F.when((segment == "FURNITURE") & (balance < 1000), "0").otherwise("1").alias("status"),
    )


def ledger(spark, sf_dir):
    """Orders in the role of runs of the customers' tables."""
    started = F.col("o_orderdate")
    return given(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.date_format(started, "yyyy-MM-dd").alias("run_date"),
        started.alias("started"),
        (started + F.make_dt_interval(secs=F.floor("o_totalprice"))).alias("ended"),
        F.when(F.col("o_orderstatus") == "F", plan.FAILED).otherwise(plan.SUCCEEDED).alias("status"),
    )


CONNECTIONS_SQL = """
SELECT CAST(n_nationkey AS VARCHAR) AS connection_id, n_name AS connection_name,
       CASE WHEN n_regionkey = 4 THEN '0' ELSE '1' END AS status FROM nation"""
TASKS_SQL = f"""
SELECT c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS connection_id, lower(c_mktsegment) AS db_name,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_nationkey = 0 THEN 'Warm_Deleted' ELSE c_name END AS table_name,
       CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 100) AS INTEGER) END AS task_order,
       CASE c_mktsegment WHEN 'BUILDING' THEN '{TODAY}' WHEN 'MACHINERY' THEN '2024-01-01' WHEN 'AUTOMOBILE' THEN ''
       END AS last_exec_date,
       CASE WHEN c_mktsegment = 'FURNITURE' AND c_acctbal < 1000 THEN '0' ELSE '1' END AS status FROM customer"""
LEDGER_SQL = """
SELECT o_custkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS run_date, o_orderdate AS started,
       o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT)) AS ended,
       CASE WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status FROM orders"""
ACTIVE_SQL = f"""
SELECT c.connection_id, c.connection_name, t.id, t.db_name, t.table_name, t.task_order, t.last_exec_date, t.status
FROM ({CONNECTIONS_SQL}) c JOIN ({TASKS_SQL}) t ON c.connection_id = t.connection_id
WHERE c.status = '1' AND t.status = '1'"""
NUMBERED_SQL = """
SELECT *, row_number() OVER (ORDER BY task_order ASC NULLS LAST, connection_id, id) AS seq"""
LATEST_RUN_SQL = f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id
  ORDER BY ended DESC NULLS LAST, started DESC, status DESC) AS rn FROM ({LEDGER_SQL})) WHERE rn = 1"""


def in_order(df):
    """Number the rows as they come."""
    return number_rows(df.withColumn("_seen", F.monotonically_increasing_id()), [F.col("_seen").asc()], "place").drop("_seen")


@query(f"""
SELECT *, row_number() OVER (ORDER BY task_order ASC NULLS LAST, connection_id, id) AS place FROM ({TASKS_SQL})""")
def order_task_plan(spark, sf_dir):
    return in_order(plan.order_task_plan(tasks(spark, sf_dir)))


@query(f"""
SELECT * EXCLUDE (seq), CASE WHEN lower(table_name) = 'warm_deleted' THEN 0 ELSE seq END AS no
FROM ({NUMBERED_SQL} FROM ({TASKS_SQL}))""")
def number_tasks(spark, sf_dir):
    return plan.number_tasks(tasks(spark, sf_dir))


@query(ACTIVE_SQL)
def filter_active(spark, sf_dir):
    return plan.filter_active(connections(spark, sf_dir), tasks(spark, sf_dir))


@query(f"""
SELECT * EXCLUDE (seq), CASE WHEN lower(table_name) = 'warm_deleted' THEN 0 ELSE seq END AS no
FROM ({NUMBERED_SQL} FROM ({ACTIVE_SQL})) WHERE last_exec_date IS NULL OR last_exec_date <> '{TODAY}'""")
def sync_plan(spark, sf_dir):
    return plan.sync_plan(connections(spark, sf_dir), tasks(spark, sf_dir), TODAY)


@query(f"""
SELECT * EXCLUDE (seq), seq AS no FROM ({NUMBERED_SQL} FROM ({ACTIVE_SQL}))
WHERE last_exec_date IS NULL OR last_exec_date <> '{TODAY}'""")
def export_plan(spark, sf_dir):
    return plan.export_plan(connections(spark, sf_dir), tasks(spark, sf_dir), TODAY)


@query(f"""
SELECT c.connection_id, c.connection_name, t.* EXCLUDE (connection_id)
FROM ({CONNECTIONS_SQL}) c JOIN ({TASKS_SQL}) t ON c.connection_id = t.connection_id
WHERE t.last_exec_date <> '' AND c.connection_id IN ('1', '3')""")
def filter_redo(spark, sf_dir):
    return plan.filter_redo(connections(spark, sf_dir), tasks(spark, sf_dir), ["1", "3"])


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS connection_id, c_name AS connection_name, c_mktsegment AS connection_status,
       o_orderkey AS id, o_orderstatus AS status
FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def registry_left_join(spark, sf_dir):
    """Customers as connections, orders as their tables; some have none."""
    customer, orders = given(spark, sf_dir, "customer", "orders")
    many = customer.select(
        F.col("c_custkey").cast("string").alias("connection_id"),
        F.col("c_name").alias("connection_name"),
        F.col("c_mktsegment").alias("status"),
    )
    registered = orders.select(
        F.col("o_custkey").cast("string").alias("connection_id"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
    )
    return plan.registry_scan(many, registered)


@query(f"""
SELECT c.connection_id, c.connection_name, c.status AS connection_status, t.* EXCLUDE (connection_id)
FROM ({CONNECTIONS_SQL}) c LEFT JOIN ({TASKS_SQL}) t ON c.connection_id = t.connection_id""")
def registry_scan(spark, sf_dir):
    return plan.registry_scan(connections(spark, sf_dir), tasks(spark, sf_dir))


@query(f"""
SELECT c.connection_id, c.connection_name, c.status AS connection_status, t.* EXCLUDE (connection_id)
FROM ({CONNECTIONS_SQL}) c JOIN ({TASKS_SQL}) t ON c.connection_id = t.connection_id""")
def registry_inner_join(spark, sf_dir):
    return plan.registry_inner_join(connections(spark, sf_dir), tasks(spark, sf_dir))


@query(f"""
SELECT connection_id, count(*) AS n, row_number() OVER (ORDER BY connection_id) AS place
FROM ({TASKS_SQL}) GROUP BY connection_id""")
def order_by_key(spark, sf_dir):
    """Place of each key among the keys, from the places of its rows, which lie together."""
    placed = in_order(plan.order_by_key(tasks(spark, sf_dir))).groupBy("connection_id")
    runs = placed.agg(F.count("*").alias("n"), F.min("place").alias("first"), F.max("place").alias("last"))
    together = runs.where("last - first + 1 = n").select("connection_id", "n", "first")
    return number_rows(together, [F.col("first").asc()], "place").drop("first")


@query(f"SELECT * FROM ({TASKS_SQL}) WHERE last_exec_date IS NULL OR last_exec_date <> '{TODAY}'")
def filter_due_today(spark, sf_dir):
    return plan.filter_due_today(tasks(spark, sf_dir), TODAY)


@query(f"""
SELECT * FROM ({TASKS_SQL}) WHERE lower(table_name) = 'customer#000000001'
  AND connection_id = (SELECT CAST(min(c_nationkey) AS VARCHAR) FROM customer WHERE c_name = 'Customer#000000001')
  AND db_name = (SELECT min(lower(c_mktsegment)) FROM customer WHERE c_name = 'Customer#000000001')""")
def filter_lookup(spark, sf_dir):
    registered = tasks(spark, sf_dir)
    one = registered.where("table_name = 'Customer#000000001'").select("connection_id", "db_name").first()
    return plan.filter_lookup(registered, one["connection_id"], one["db_name"].upper(), "CUSTOMER#000000001")


@query(f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY connection_id, db_name ORDER BY id) AS rn
  FROM ({TASKS_SQL})) WHERE rn = 1""")
def distinct_keep_first(spark, sf_dir):
    return plan.distinct_keep_first(tasks(spark, sf_dir), ["connection_id", "db_name"])


@query(f"SELECT *, row_number() OVER (ORDER BY id DESC) AS place FROM ({TASKS_SQL})")
def reverse_list_order(spark, sf_dir):
    return in_order(plan.reverse_list_order(tasks(spark, sf_dir), "id"))


@query(f"""
SELECT *, CAST(floor(epoch(ended) - epoch(started)) AS BIGINT) AS seconds
FROM ({LATEST_RUN_SQL}) WHERE status = 'FAILED'""")
def failed_tasks(spark, sf_dir):
    return plan.failed_tasks(ledger(spark, sf_dir))


@query(f"""
SELECT t.* REPLACE (coalesce(l.done, t.last_exec_date) AS last_exec_date) FROM ({TASKS_SQL}) t
LEFT JOIN (SELECT id, max(run_date) AS done FROM ({LEDGER_SQL}) WHERE status = 'SUCCEEDED' GROUP BY id) l
  ON t.id = l.id""")
def sync_ledger(spark, sf_dir):
    return plan.sync_ledger(tasks(spark, sf_dir), ledger(spark, sf_dir))


@query(
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS table_rows FROM {t}" for t in TABLES)
    + " UNION ALL SELECT 'no_such_table', NULL"
)
def table_rowcounts(spark, sf_dir):
    opened = dict(zip(TABLES, given(spark, sf_dir, *TABLES)))
    return plan.table_rowcounts({**opened, **plan.open_tables(spark, ["no_such_table"])})


@query(f"""
SELECT t.id, t.connection_id, t.db_name, t.table_name, coalesce(n.rows, -1) AS table_rows,
       CASE WHEN n.rows IS NULL THEN 'never' ELSE '2024-01-02 00:00:00' END AS rows_updatetime
FROM ({TASKS_SQL}) t LEFT JOIN (
  SELECT CAST(c_nationkey AS VARCHAR) AS connection_id, lower(c_mktsegment) AS db_name, c_name AS table_name,
         count(*) AS rows
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3) n
  ON t.connection_id = n.connection_id AND t.db_name = n.db_name AND t.table_name = n.table_name
UNION ALL SELECT c_custkey, 'other', lower(c_mktsegment), c_name, -1, 'never' FROM customer""")
def store_rowcounts(spark, sf_dir):
    """Counts of one connection; another one has tables of the same names."""
    customer, orders = given(spark, sf_dir, "customer", "orders")
    counts = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("table_rows"))
    counts = counts.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").cast("string").alias("connection_id"),
        F.lower("c_mktsegment").alias("db_name"),
        F.col("c_name").alias("table_name"),
        "table_rows",
    )
    registered = tasks(spark, sf_dir).select(
        "id", "connection_id", "db_name", "table_name",
        F.lit(-1).cast("bigint").alias("table_rows"), F.lit("never").alias("rows_updatetime"),
    )
    same_names = customer.select(
        F.col("c_custkey").alias("id"), F.lit("other").alias("connection_id"),
        F.lower("c_mktsegment").alias("db_name"), F.col("c_name").alias("table_name"),
        F.lit(-1).cast("bigint").alias("table_rows"), F.lit("never").alias("rows_updatetime"),
    )
    return plan.store_rowcounts(registered.unionByName(same_names), counts, F.lit("2024-01-02 00:00:00"))


SEED_SQL = """
SELECT CAST(c_nationkey AS VARCHAR) AS connection_id, lower(c_mktsegment) AS db_name, c_name AS table_name,
       'pet_medical' AS hive_database, 'src_' || lower(c_mktsegment) || '_' || c_name AS hive_table,
       '1' AS is_overwrite, '0' AS status FROM customer"""


@query(SEED_SQL)
def seed_registry(spark, sf_dir):
    listed = given(spark, sf_dir, "customer").withColumn("table_name", F.col("c_name"))
    return plan.seed_registry(listed, F.col("c_nationkey").cast("string"), F.lower("c_mktsegment"))


@query(f"""
SELECT row_number() OVER (ORDER BY is_new, connection_id, db_name, table_name) AS id, connection_id, db_name, table_name,
       hive_table, status
FROM (SELECT *, FALSE AS is_new FROM ({SEED_SQL}) WHERE connection_id < '2'
      UNION ALL SELECT *, TRUE AS is_new FROM ({SEED_SQL}) WHERE connection_id >= '2')""")
def register_tables(spark, sf_dir):
    """Two registrations; the second goes on from the last id of the first."""
    table = f"{scratch_database(spark, 'register_tables')}.meta_import"
    seeded = seed_registry(spark, sf_dir)
    create_table(spark, table, [("id", "bigint"), *seeded.dtypes])
    for part in ("connection_id < '2'", "connection_id >= '2'"):
        plan.register_tables(seeded.where(part), table)
    return spark.table(table).select("id", "connection_id", "db_name", "table_name", "hive_table", "status")


@query(f"""
SELECT DISTINCT db_name, CASE WHEN instr(substr(hive_table, 5), '_') > 0
  THEN substr(hive_table, 5, instr(substr(hive_table, 5), '_') - 1) ELSE '' END AS hive_db_name FROM ({SEED_SQL})""")
def distinct_db_map(spark, sf_dir):
    return plan.distinct_db_map(seed_registry(spark, sf_dir))


BACKUPS_SQL = """
SELECT o_orderkey AS id, 'orders_' || CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y%m%d')
  WHEN 'O' THEN 'old_' || strftime(o_orderdate, '%Y%m%d') ELSE strftime(o_orderdate, '%Y') || '1399' END || '_bak'
  AS table_name FROM orders"""


def backups(spark, sf_dir):
    """A backup name per order: a right one, one of another table, or no date."""
    day = F.date_format("o_orderdate", "yyyyMMdd")
    part = (
        F.when(F.col("o_orderstatus") == "F", day)
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("old_"), day))
        .otherwise(F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("1399")))
    )
    return given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("orders_"), part, F.lit("_bak")).alias("table_name")
    )


@query(f"""
SELECT id, table_name FROM ({BACKUPS_SQL})
WHERE try_strptime(regexp_extract(table_name, '^orders_([0-9]{{8}})_bak$', 1), '%Y%m%d') IS NOT NULL
  AND regexp_extract(table_name, '^orders_([0-9]{{8}})_bak$', 1) < '19980101'""")
def backup_retention(spark, sf_dir):
    return expired_backups(backups(spark, sf_dir), "orders", "19980101")


@query(f"SELECT * FROM ({BACKUPS_SQL}) WHERE starts_with(table_name, 'orders_old_')")
def filter_name_prefix(spark, sf_dir):
    return with_prefix(backups(spark, sf_dir), "orders_old_")
