"""Routing, union and enrichment of two lineages."""

from pyspark.sql import functions as F

from ..operators import projections
from ..operators import routing as op
from ..plans import merge as plan
from ..session import scratch_database
from ..sinks.tables import ctas_replace, drop_table
from .base import given, query


def old_rows(spark, sf_dir):
    """Orders in the role of the old system."""
    return given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("orgid"),
        F.col("o_custkey").alias("code"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("updatestamp"),
        F.col("o_orderpriority").alias("priority"),
    )


def new_rows(spark, sf_dir):
    """Lines in the role of the new system; ``code`` has another type there."""
    return given(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("line"),
        F.col("l_orderkey").alias("id"),
        F.col("l_partkey").alias("orgid"),
        F.col("l_returnflag").alias("code"),
        F.col("l_linestatus").alias("status"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("updatestamp"),
    )


def clinics(spark, sf_dir):
    """Customers in the role of clinics; those in two segments have moved."""
    customer = given(spark, sf_dir, "customer")
    return op.routing_dimension(
        customer.select(
            F.col("c_custkey").alias("clinic_id"),
            F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.col("c_custkey")).alias("pmsweb_id"),
            F.col("c_mktsegment").alias("brand_code"),
            F.col("c_name").alias("clinic_name"),
        )
    )


OLD_SQL = """
SELECT o_orderkey AS id, o_custkey AS orgid, o_custkey AS code, o_orderstatus AS status, o_totalprice AS amount,
       o_orderdate AS updatestamp, o_orderpriority AS priority FROM orders"""
NEW_SQL = """
SELECT l_linenumber AS line, l_orderkey AS id, l_partkey AS orgid, l_returnflag AS code, l_linestatus AS status,
       l_extendedprice AS amount, l_shipdate AS updatestamp FROM lineitem"""
CLINICS_SQL = """
SELECT c_custkey AS clinic_id, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_custkey END AS pmsweb_id,
       c_mktsegment AS brand_code, c_name AS clinic_name FROM customer"""
COMMON = "id, orgid, CAST(code AS VARCHAR) AS code, status, amount, updatestamp"
MIDDLE_SQL = f"""
SELECT t.* FROM (SELECT {COMMON} FROM old) t LEFT JOIN dim s ON t.orgid = s.clinic_id WHERE s.pmsweb_id IS NULL
UNION ALL
SELECT t.* FROM (SELECT {COMMON} FROM new) t LEFT JOIN dim s ON t.orgid = s.clinic_id WHERE s.pmsweb_id IS NOT NULL"""
WITH = f"WITH old AS ({OLD_SQL}), new AS ({NEW_SQL}), dim AS ({CLINICS_SQL})"


@query(f"{WITH} SELECT t.* FROM old t LEFT JOIN dim s ON t.orgid = s.clinic_id WHERE s.pmsweb_id IS NULL")
def route_not_migrated(spark, sf_dir):
    return op.route_not_migrated(old_rows(spark, sf_dir), clinics(spark, sf_dir))


@query(f"{WITH} SELECT t.* FROM new t LEFT JOIN dim s ON t.orgid = s.clinic_id WHERE s.pmsweb_id IS NOT NULL")
def route_migrated(spark, sf_dir):
    return op.route_migrated(new_rows(spark, sf_dir), clinics(spark, sf_dir))


@query(f"{WITH} SELECT s.brand_code, s.clinic_name, t.* FROM new t JOIN dim s ON t.orgid = s.clinic_id")
def enrich_dim(spark, sf_dir):
    return op.enrich_dim(new_rows(spark, sf_dir), clinics(spark, sf_dir))


@query(f"{WITH} SELECT {COMMON} FROM old UNION ALL SELECT {COMMON} FROM new")
def union_all(spark, sf_dir):
    return op.union_all(old_rows(spark, sf_dir), new_rows(spark, sf_dir))


@query(f"""{WITH} SELECT id, orgid, CAST(code AS VARCHAR) AS code, CAST(status AS VARCHAR) AS status, amount, updatestamp,
  'old' AS side FROM old
UNION ALL SELECT id, orgid, CAST(code AS VARCHAR), CAST(status AS VARCHAR), amount, updatestamp, 'new' FROM new""")
def project_common(spark, sf_dir):
    old, new = projections.project_common(old_rows(spark, sf_dir), new_rows(spark, sf_dir))
    text = {name: F.col(name).cast("string") for name in ("code", "status")}
    sides = [df.withColumns({**text, "side": F.lit(side)}) for df, side in ((old, "old"), (new, "new"))]
    return sides[0].unionByName(sides[1])


@query(f"{WITH} {MIDDLE_SQL}")
def merge_middle(spark, sf_dir):
    return op.merge_middle(old_rows(spark, sf_dir), new_rows(spark, sf_dir), clinics(spark, sf_dir))


@query(f"""
{WITH}, mid AS ({MIDDLE_SQL})
SELECT s.brand_code, s.clinic_name, t.* FROM mid t JOIN dim s ON t.orgid = s.clinic_id""")
def merge_routed(spark, sf_dir):
    return op.merge_routed(old_rows(spark, sf_dir), new_rows(spark, sf_dir), clinics(spark, sf_dir))


@query("""
WITH old AS (SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer),
     new AS (SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier),
     dim AS (SELECT p_partkey AS clinic_id, CASE WHEN p_size > 25 THEN p_partkey END AS pmsweb_id,
                    p_brand AS brand_code, p_name AS clinic_name FROM part),
     mid AS (SELECT t.id, t.name, t.balance FROM old t LEFT JOIN dim s ON t.id = s.clinic_id WHERE s.pmsweb_id IS NULL
             UNION ALL
             SELECT t.* FROM new t LEFT JOIN dim s ON t.id = s.clinic_id WHERE s.pmsweb_id IS NOT NULL)
SELECT s.brand_code, s.clinic_name, t.* FROM mid t JOIN dim s ON t.id = s.clinic_id""")
def merge_routed_self(spark, sf_dir):
    customer, supplier, part = given(spark, sf_dir, "customer", "supplier", "part")
    old = customer.toDF("id", "name", "nation", "balance", "segment").drop("segment")
    new = supplier.toDF("id", "name", "nation", "balance").drop("nation")
    dimension = part.select(
        F.col("p_partkey").alias("clinic_id"),
        F.when(F.col("p_size") > 25, F.col("p_partkey")).alias("pmsweb_id"),
        F.col("p_brand").alias("brand_code"),
        F.col("p_name").alias("clinic_name"),
    )
    return plan.merge_routed_self(old, new, op.routing_dimension(dimension))


@query("""
WITH dim AS (SELECT n_nationkey AS clinic_id, CASE WHEN n_regionkey < 2 THEN n_nationkey END AS pmsweb_id,
                    CAST(n_regionkey AS VARCHAR) AS brand_code, n_name AS clinic_name FROM nation),
     mid AS (SELECT c_custkey AS id, c_name AS name, c_nationkey AS orgid, c_acctbal AS balance
             FROM customer t LEFT JOIN dim s ON t.c_nationkey = s.clinic_id WHERE s.pmsweb_id IS NULL
             UNION ALL
             SELECT s_suppkey, s_name, s_nationkey, s_acctbal
             FROM supplier t LEFT JOIN dim s ON t.s_nationkey = s.clinic_id WHERE s.pmsweb_id IS NOT NULL)
SELECT s.brand_code, s.clinic_name, t.* FROM mid t JOIN dim s ON t.orgid = s.clinic_id""")
def routed_union_merge(spark, sf_dir):
    customer, supplier, nation = given(spark, sf_dir, "customer", "supplier", "nation")
    dimension = nation.select(
        F.col("n_nationkey").alias("clinic_id"),
        F.when(F.col("n_regionkey") < 2, F.col("n_nationkey")).alias("pmsweb_id"),
        F.col("n_regionkey").cast("string").alias("brand_code"),
        F.col("n_name").alias("clinic_name"),
    )
    old = customer.toDF("id", "name", "orgid", "balance", "segment")
    new = supplier.toDF("id", "name", "orgid", "balance")
    return op.merge_routed(old, new, op.routing_dimension(dimension))


@query(f"{WITH} SELECT * FROM old")
def merge_passthrough(spark, sf_dir):
    branch = plan.merge_dispatch("ods_pms_CPrescriptions")
    return plan.merge_frames(branch, old_rows(spark, sf_dir), None, None)


@query(f"{WITH} SELECT * FROM new")
def merge_prefer_new(spark, sf_dir):
    branch = plan.merge_dispatch("ods_pms_SysCategory")
    return plan.merge_frames(branch, None, new_rows(spark, sf_dir), None)


@query(f"""
{WITH}, mid AS ({MIDDLE_SQL})
SELECT s.brand_code, s.clinic_name, t.* FROM mid t JOIN dim s ON t.orgid = s.clinic_id""")
def merge_table(spark, sf_dir):
    """Stored tables in, stored table out, with the layers in between."""
    database, final = scratch_database(spark, "merge_table"), scratch_database(spark, "merge_final")
    ctas_replace(old_rows(spark, sf_dir), f"{database}.ods_pms_cpayments")
    ctas_replace(new_rows(spark, sf_dir), f"{database}.ods_pmsweb_cpayments")
    merged = plan.merge_table(spark, f"{database}.ods_pms_cpayments", clinics(spark, sf_dir), final, keep_layers=True)
    for layer in ("ods_pms_", "ods_pmsweb_", "mid_", "mir_"):
        drop_table(spark, f"{database}.{layer}cpayments")
    return spark.table(merged)


@query(f"{WITH} SELECT status, amount, id, orgid FROM new")
def project_dim_first(spark, sf_dir):
    return projections.project_dim_first(new_rows(spark, sf_dir), ["status", "amount"], ["id", "orgid"])


@query(f"""
{WITH}, mid AS ({MIDDLE_SQL})
SELECT s.brand_code, s.clinic_name, t.* FROM mid t JOIN dim s ON t.orgid = s.clinic_id""")
def merge_dispatch(spark, sf_dir):
    """A table whose branch follows from its name."""
    branch = plan.merge_dispatch("pet_medical.ods_pms_cpaymentdetails")
    return plan.merge_frames(branch, old_rows(spark, sf_dir), new_rows(spark, sf_dir), clinics(spark, sf_dir))
