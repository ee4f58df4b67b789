"""Latest rows, tombstones, snapshots."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.dedup import RANK
from ..operators.dedup import filter_rank_first as keep_first
from ..operators.dedup import latest_per_key as latest
from ..operators.dedup import latest_tombstone as latest_delete
from ..operators.dedup import filter_newer_than_delete as newer_than_delete
from ..operators.dedup import stamp_etl_time as add_etl_time
from ..operators.dedup import tombstone_join as drop_deleted
from ..plans import refresh
from ..plans import unique as plan
from ..session import scratch_database
from ..sinks import tables as sink
from .base import given, query

LINE_TIES = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
LINE_ORDER = "l_shipdate DESC NULLS LAST, " + ", ".join(f"{c} DESC NULLS LAST" for c in LINE_TIES)
ETL_TIME = "2024-01-31 00:00:00"


def etl_time():
    return F.lit(ETL_TIME).cast("timestamp_ntz")


def line_log(spark, sf_dir):
    """Lines not returned, as a change log; open lines carry no stamp if untaxed."""
    lines = given(spark, sf_dir, "lineitem").where("l_returnflag <> 'R'")
    return lines.select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("orgid"),
        F.when(~((F.col("l_linestatus") == "O") & (F.col("l_tax") == 0)), F.col("l_shipdate")).alias("updatestamp"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_extendedprice").alias("price"),
    )


def line_deletes(spark, sf_dir):
    """Returned lines, as a tombstone log of two tables; undiscounted ones carry no stamp."""
    lines = given(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return lines.select(
        F.col("l_linestatus").alias("tablename"),
        F.col("l_orderkey").alias("p_id"),
        F.col("l_linenumber").alias("p_orgid"),
        F.when(F.col("l_discount") > 0, F.col("l_shipdate")).alias("updatestamp"),
    )


LINE_LOG_SQL = """
SELECT l_orderkey AS id, l_linenumber AS orgid,
       CASE WHEN NOT (l_linestatus = 'O' AND l_tax = 0) THEN l_shipdate END AS updatestamp,
       l_partkey AS partkey, l_extendedprice AS price
FROM lineitem WHERE l_returnflag <> 'R'"""
LINE_DELETES_SQL = """
SELECT l_linestatus AS tablename, l_orderkey AS p_id, l_linenumber AS p_orgid,
       CASE WHEN l_discount > 0 THEN l_shipdate END AS updatestamp
FROM lineitem WHERE l_returnflag = 'R'"""


@query("""
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def latest_per_key(spark, sf_dir):
    return latest(given(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", tie_break=["event_id"])


@query(f"""
WITH log AS ({LINE_DELETES_SQL})
SELECT p_id, p_orgid, updatestamp AS p_updatestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY p_id, p_orgid ORDER BY updatestamp DESC NULLS LAST) AS rn
  FROM log WHERE lower(tablename) = 'o') WHERE rn = 1""")
def latest_tombstone(spark, sf_dir):
    return latest_delete(line_deletes(spark, sf_dir), "o")


@query(f"""
WITH log AS ({LINE_LOG_SQL}), deletes AS ({LINE_DELETES_SQL}),
     dead AS (SELECT p_id, p_orgid, max(updatestamp) AS p_ts FROM deletes GROUP BY p_id, p_orgid)
SELECT a.* FROM log a LEFT JOIN dead b ON a.id = b.p_id AND a.orgid = b.p_orgid
WHERE b.p_ts IS NULL OR a.updatestamp > b.p_ts""")
def tombstone_join(spark, sf_dir):
    deletes = latest_delete(line_deletes(spark, sf_dir))
    return drop_deleted(line_log(spark, sf_dir), deletes, ["id", "orgid"], "updatestamp")


@query(f"""
WITH log AS ({LINE_LOG_SQL}), deletes AS ({LINE_DELETES_SQL}),
     a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, orgid
             ORDER BY updatestamp DESC NULLS LAST, partkey DESC, price DESC) AS rn FROM log) WHERE rn = 1),
     b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_id, p_orgid
             ORDER BY updatestamp DESC NULLS LAST) AS rn FROM deletes WHERE lower(tablename) = 'f') WHERE rn = 1)
SELECT a.id, a.orgid, a.updatestamp, a.partkey, a.price, TIMESTAMP '{ETL_TIME}' AS etl_time
FROM a LEFT JOIN b ON a.id = b.p_id AND a.orgid = b.p_orgid
WHERE b.updatestamp IS NULL OR a.updatestamp > b.updatestamp""")
def unique_incremental(spark, sf_dir):
    return plan.unique_incremental(
        line_log(spark, sf_dir),
        line_deletes(spark, sf_dir),
        ["id", "orgid"],
        "updatestamp",
        tombstone_name="f",
        tie_break=["partkey", "price"],
        etl_time=etl_time(),
    )


@query(f"""
WITH log AS ({LINE_LOG_SQL}), deletes AS ({LINE_DELETES_SQL}),
     a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, orgid
             ORDER BY updatestamp DESC NULLS LAST, partkey DESC, price DESC) AS rn FROM log) WHERE rn = 1),
     b AS (SELECT p_id, p_orgid, max(updatestamp) AS p_ts FROM deletes GROUP BY p_id, p_orgid)
SELECT a.id, a.orgid, a.updatestamp, a.partkey, a.price, TIMESTAMP '{ETL_TIME}' AS etl_time
FROM a LEFT JOIN b ON a.id = b.p_id AND a.orgid = b.p_orgid WHERE b.p_ts IS NULL OR a.updatestamp > b.p_ts""")
def unique_refresh(spark, sf_dir):
    """A part of the log built, the rest and its deletes applied in two steps: the same as a rebuild."""
    table = f"{scratch_database(spark, 'unique_refresh')}.ods_pms_lines"
    log, deletes = line_log(spark, sf_dir), line_deletes(spark, sf_dir)
    keys, ties = ["id", "orgid"], ["partkey", "price"]
    first = "p_id % 5 < 3"
    refresh.build_current(log.where("partkey % 3 = 0"), deletes.where(first), table, keys, "updatestamp", 64, ties, etl_time())
    for part, known, new in ((1, "p_id % 5 < 4", "p_id % 5 = 3"), (2, "true", "p_id % 5 = 4 OR p_id IS NULL")):
        refresh.refresh_current(
            spark, table, log.where(f"partkey % 3 = {part}"), deletes.where(known), deletes.where(new), keys,
            "updatestamp", ties, etl_time(),
        )
    return spark.table(table).drop(refresh.BUCKET)


@query("""
WITH a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
             ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM events WHERE event_type <> 'error') WHERE rn = 1),
     b AS (SELECT user_id, max(ts) AS p_ts FROM events WHERE event_type = 'error' GROUP BY user_id)
SELECT a.event_id, a.ts, a.user_id, a.event_type, a.value, a.props
FROM a LEFT JOIN b ON a.user_id = b.user_id WHERE b.p_ts IS NULL OR a.ts > b.p_ts""")
def latest_minus_tombstones(spark, sf_dir):
    events = given(spark, sf_dir, "events")
    rows = latest(events.where("event_type <> 'error'"), ["user_id", "event_type"], "ts", tie_break=["event_id"])
    deletes = latest_delete(events.where("event_type = 'error'"), keys=["user_id"], stamp="ts")
    return drop_deleted(rows, deletes, ["user_id"], "ts", tombstone_keys=["user_id"])


@query(f"""
SELECT * EXCLUDE (rn), TIMESTAMP '{ETL_TIME}' AS etl_time FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS rn
  FROM lineitem) WHERE rn = 1""")
def unique_latest(spark, sf_dir):
    lines = given(spark, sf_dir, "lineitem")
    return plan.unique_latest(lines, ["l_orderkey", "l_linenumber"], "l_shipdate", LINE_TIES, etl_time())


@query(f"""
SELECT *, strftime(ts, '%Y%m%d') AS date, TIMESTAMP '{ETL_TIME}' AS etl_time
FROM events WHERE strftime(ts, '%Y%m%d') = '20240102'""")
def unique_snapshot(spark, sf_dir):
    """One stored partition; the filter reaches the partition column."""
    table = f"{scratch_database(spark, 'unique_snapshot')}.src_log_events"
    events = given(spark, sf_dir, "events").withColumn("date", F.date_format("ts", "yyyyMMdd"))
    sink.create_table(spark, table, events.drop("date").dtypes, "date")
    sink.overwrite_partitions(events, table, "date")
    return plan.unique_snapshot(spark.table(table), "date", "20240102", etl_time())


@query(f"SELECT *, TIMESTAMP '{ETL_TIME}' AS etl_time FROM orders")
def unique_snapshot_whole(spark, sf_dir):
    return plan.unique_snapshot(given(spark, sf_dir, "orders"), etl_time=etl_time())


@query(f"""
WITH a AS (SELECT * FROM (SELECT o_orderkey AS id, o_custkey AS orgid, o_orderdate AS update_time, o_totalprice,
             row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC NULLS LAST,
             o_orderkey DESC) AS rn, o_orderstatus FROM orders) WHERE rn = 1)
SELECT id, orgid, update_time, o_totalprice, o_orderstatus, TIMESTAMP '{ETL_TIME}' AS etl_time FROM a""")
def unique_latest_orders(spark, sf_dir):
    orders = given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("orgid"),
        F.col("o_orderdate").alias("update_time"),
        "o_totalprice",
        "o_orderstatus",
    )
    return plan.unique_latest(orders, ["orgid", "o_orderstatus"], "update_time", ["id"], etl_time())


@query(f"""
SELECT l_orderkey AS id, l_linenumber AS orgid, max(l_shipdate) AS update_time, TIMESTAMP '{ETL_TIME}' AS etl_time
FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def unique_dispatch(spark, sf_dir):
    """An incremental table whose rule follows from its name."""
    lines = given(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("orgid"), F.col("l_shipdate").alias("update_time")
    )
    rule = plan.unique_dispatch("pet_medical.src_his_lines", incremental=True)
    return plan.unique_table(lines, rule, etl_time=etl_time())


@query("""
SELECT id, filter, max_value FROM (SELECT c_custkey AS id, CASE WHEN c_acctbal > 0 THEN 'id > {max_value}' ELSE ' ' END AS filter,
  CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN '' ELSE 'max(id)' END AS max_value FROM customer)
WHERE trim(filter) <> '' AND trim(max_value) <> ''""")
def is_incremental(spark, sf_dir):
    segment = F.col("c_mktsegment")
    registered = given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") > 0, "id > {max_value}").otherwise(" ").alias("filter"),
        F.when(segment == "MACHINERY", "").when(segment != "BUILDING", "max(id)").alias("max_value"),
    )
    return registered.where(plan.is_incremental())


@query(f"SELECT *, TIMESTAMP '{ETL_TIME}' AS etl_time FROM supplier")
def stamp_etl_time(spark, sf_dir):
    return add_etl_time(given(spark, sf_dir, "supplier"), etl_time())


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS stamp,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE TIMESTAMP '1998-01-01' END AS deleted FROM orders
WHERE o_orderstatus = 'O' OR (o_orderstatus <> 'P' AND o_orderdate > TIMESTAMP '1998-01-01')""")
def filter_newer_than_delete(spark, sf_dir):
    rows = given(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("stamp"),
        F.when(F.col("o_orderstatus") != "O", F.lit("1998-01-01").cast("timestamp_ntz")).alias("deleted"),
    )
    return rows.where(newer_than_delete(F.col("stamp"), F.col("deleted")))


@query("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders)
WHERE rn = 1""")
def filter_rank_first(spark, sf_dir):
    latest_first = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), "o_orderkey")
    return keep_first(given(spark, sf_dir, "orders").withColumn(RANK, F.row_number().over(latest_first)))


@query("SELECT o_orderkey, TRUE AS stamped FROM orders")
def current_timestamp(spark, sf_dir):
    """The load time differs by run, so only its nearness is compared."""
    stamped = add_etl_time(given(spark, sf_dir, "orders"))
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("etl_time")
    return stamped.select("o_orderkey", F.abs(age).between(0, 3600).alias("stamped"))
