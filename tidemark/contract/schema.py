"""Schema comparison over large column catalogues."""

from pyspark.sql import functions as F

from ..functions import types
from ..operators import schema as op
from ..plans import registry
from .base import given, query

# One catalogue entry per (order, line): the order is the table, the line the position.
ENTRIES_SQL = """
SELECT 't' || l_orderkey AS table_name, l_linenumber AS ordinal, max(l_quantity) AS q, min(l_returnflag) AS rf,
       min(l_tax) AS tax, min(l_discount) AS disc FROM lineitem GROUP BY l_orderkey, l_linenumber"""
SOURCE_TYPES = (
    (5, "int(11)"), (10, "varchar(40)"), (15, "datetime"), (20, "decimal(10,2)"), (25, "bigint unsigned"),
    (30, "mediumint(9)"), (35, "bit(1)"), (40, "point"), (45, "tinyint(1)"),
)
SOURCE_SQL = f"""
SELECT table_name, ordinal, 'Col' || ordinal AS name,
       CASE {' '.join(f"WHEN q <= {q} THEN '{t}'" for q, t in SOURCE_TYPES)} ELSE 'NUMBER' END AS type
FROM ({ENTRIES_SQL})"""
TARGET_SQL = f"""
SELECT table_name, ordinal, CASE WHEN tax > 0.06 THEN 'other' ELSE 'col' || ordinal END AS name,
       CASE WHEN q <= 5 THEN 'int' WHEN q <= 15 THEN 'string' WHEN q <= 30 THEN 'double' ELSE 'tinyint' END AS type
FROM ({ENTRIES_SQL}) WHERE disc < 0.08"""
IMPORT_TYPE_SQL = """CASE source_type WHEN 'int(11)' THEN 'int' WHEN 'varchar(40)' THEN 'string'
  WHEN 'datetime' THEN 'string' WHEN 'decimal(10,2)' THEN 'double' WHEN 'bigint unsigned' THEN 'decimal(20,0)'
  WHEN 'mediumint(9)' THEN 'int' WHEN 'bit(1)' THEN 'boolean' WHEN 'point' THEN 'string'
  WHEN 'tinyint(1)' THEN 'tinyint' ELSE 'double' END"""


def _entries(spark, sf_dir):
    lines = given(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("ordinal"))
    return lines.agg(
        F.max("l_quantity").alias("q"), F.min("l_tax").alias("tax"), F.min("l_discount").alias("disc")
    ).withColumn("table_name", F.concat(F.lit("t"), "l_orderkey"))


def source_columns(spark, sf_dir):
    kind = F.lit("NUMBER")
    for q, name in reversed(SOURCE_TYPES):
        kind = F.when(F.col("q") <= q, name).otherwise(kind)
    return _entries(spark, sf_dir).select(
        "table_name", "ordinal", F.concat(F.lit("Col"), "ordinal").alias("name"), kind.alias("type")
    )


def target_columns(spark, sf_dir):
    name = F.when(F.col("tax") > 0.06, "other").otherwise(F.concat(F.lit("col"), "ordinal"))
    kind = F.when(F.col("q") <= 5, "int").when(F.col("q") <= 15, "string").when(F.col("q") <= 30, "double")
    kept = _entries(spark, sf_dir).where("disc < 0.08")
    return kept.select("table_name", "ordinal", name.alias("name"), kind.otherwise("tinyint").alias("type"))


def _diff_sql(source, target, wanted, same_name, same_type):
    return f"""
SELECT s.table_name, s.ordinal, s.source_name, s.source_type, s.wanted_type, t.name AS target_name,
       t.type AS target_type,
       CASE WHEN t.name IS NULL AND k.table_name IS NOT NULL THEN 'add' WHEN t.name IS NULL THEN 'create'
            WHEN NOT ({same_name}) THEN 'drift' WHEN {same_type} THEN 'same' ELSE 'diff' END AS flag
FROM (SELECT *, {wanted} AS wanted_type FROM
       (SELECT table_name, ordinal, name AS source_name, type AS source_type FROM ({source}))) s
LEFT JOIN ({target}) t ON s.table_name = t.table_name AND s.ordinal = t.ordinal
LEFT JOIN (SELECT DISTINCT table_name FROM ({target})) k ON s.table_name = k.table_name"""


IMPORT_DIFF_SQL = _diff_sql(
    SOURCE_SQL,
    TARGET_SQL,
    IMPORT_TYPE_SQL,
    "lower(s.source_name) = lower(t.name)",
    "regexp_replace(s.wanted_type, '\\(.*', '') = regexp_replace(t.type, '\\(.*', '')",
)
EXPORT_DIFF_SQL = _diff_sql(
    TARGET_SQL,
    SOURCE_SQL.replace("'Col'", "'col'"),
    "CASE WHEN source_type IN ('tinyint','smallint','int','bigint','float','double') THEN source_type"
    " ELSE 'varchar(255)' END",
    "s.source_name = t.name",
    "(regexp_replace(s.wanted_type, '\\(.*', '') = regexp_replace(t.type, '\\(.*', '')"
    " OR (s.wanted_type = 'varchar(255)' AND regexp_matches(t.type, '(?i)char|text')))",
)


@query(f"SELECT table_name, ordinal, source_type, {IMPORT_TYPE_SQL} AS wanted_type FROM"
       f" (SELECT table_name, ordinal, type AS source_type FROM ({SOURCE_SQL}))")
def map_types_import(spark, sf_dir):
    named = source_columns(spark, sf_dir).withColumn("kind", types.type_name("type"))
    wanted = types.map_types_import("kind").alias("wanted_type")
    return named.select("table_name", "ordinal", F.col("type").alias("source_type"), wanted)


@query(f"""
SELECT table_name, ordinal, type, CASE WHEN type = 'string' THEN 'varchar(255)' ELSE type END AS wanted_type
FROM ({TARGET_SQL})""")
def map_types_export(spark, sf_dir):
    wanted = types.map_types_export("type").alias("wanted_type")
    return target_columns(spark, sf_dir).select("table_name", "ordinal", "type", wanted)


@query(f"""
SELECT s.* FROM ({SOURCE_SQL}) s
WHERE EXISTS (SELECT 1 FROM ({TARGET_SQL}) t WHERE t.table_name = s.table_name AND lower(t.name) = lower(s.name))""")
def common_column_join(spark, sf_dir):
    return op.common_column_join(source_columns(spark, sf_dir), target_columns(spark, sf_dir))


@query(f"""
SELECT s.table_name, s.ordinal, s.name AS source_name, s.type AS source_type, t.name AS target_name, t.type AS target_type
FROM ({SOURCE_SQL}) s LEFT JOIN ({TARGET_SQL}) t ON s.table_name = t.table_name AND s.ordinal = t.ordinal""")
def ordinal_schema_join(spark, sf_dir):
    return op.ordinal_schema_join(source_columns(spark, sf_dir), target_columns(spark, sf_dir))


def _import_diff(spark, sf_dir):
    return op.schema_diff_import(source_columns(spark, sf_dir), target_columns(spark, sf_dir))


@query(IMPORT_DIFF_SQL)
def schema_diff_import(spark, sf_dir):
    return _import_diff(spark, sf_dir)


@query(EXPORT_DIFF_SQL)
def schema_diff_export(spark, sf_dir):
    database = source_columns(spark, sf_dir).withColumn("name", F.concat(F.lit("col"), "ordinal"))
    return op.schema_diff_export(target_columns(spark, sf_dir), database)


@query(f"""
WITH d AS ({IMPORT_DIFF_SQL})
SELECT table_name, ordinal, source_name AS name, wanted_type AS type FROM d
WHERE flag = 'add' AND table_name NOT IN (SELECT table_name FROM d WHERE flag = 'drift')""")
def evolve_add_columns(spark, sf_dir):
    return op.evolve_add_columns(_import_diff(spark, sf_dir))


@query(f"""
SELECT table_name, ordinal,
       'ALTER TABLE ' || table_name || ' ADD COLUMNS (' || source_name || ' ' || wanted_type || ')' AS statement
FROM ({IMPORT_DIFF_SQL}) WHERE flag = 'add'""")
def alter_statements(spark, sf_dir):
    return op.alter_statements(_import_diff(spark, sf_dir))


@query(f"""
SELECT table_name, added, retyped, drifted,
       CASE WHEN drifted > 0 THEN 'no alter: columns out of order' WHEN added > 0 THEN 'add columns'
            ELSE 'report only' END AS action
FROM (SELECT table_name, count(*) FILTER (flag = 'add') AS added, count(*) FILTER (flag = 'diff') AS retyped,
             count(*) FILTER (flag = 'drift') AS drifted FROM ({IMPORT_DIFF_SQL}) GROUP BY table_name)
WHERE added + retyped + drifted > 0""")
def schema_drift_report(spark, sf_dir):
    return op.schema_drift_report(_import_diff(spark, sf_dir))


@query(f"""
SELECT 't' || o_orderkey AS table_name FROM orders
WHERE 't' || o_orderkey NOT IN (SELECT table_name FROM ({SOURCE_SQL}))""")
def missing_sources(spark, sf_dir):
    registered = given(spark, sf_dir, "orders").select(F.concat(F.lit("t"), "o_orderkey").alias("table_name"))
    return op.missing_sources(registered, source_columns(spark, sf_dir))


@query(f"""
SELECT r.hive AS table_name, d.* EXCLUDE (table_name) FROM ({IMPORT_DIFF_SQL}) d
JOIN (SELECT 't' || o_orderkey AS table_name, 'dw.src_' || lower(o_orderstatus) || '_t' || o_orderkey AS hive FROM orders) r
  ON d.table_name = r.table_name""")
def check_schemas(spark, sf_dir):
    """Findings of a large registry, whose tables have other names in the warehouse."""
    registered = given(spark, sf_dir, "orders").select(
        F.lit("01").alias("connection_id"),
        F.lit("sales").alias("db_name"),
        F.concat(F.lit("T"), "o_orderkey").alias("table_name"),
        F.lit("dw").alias("hive_database"),
        F.concat(F.lit("src_"), "o_orderstatus", F.lit("_t"), "o_orderkey").alias("hive_table"),
    )
    source = source_columns(spark, sf_dir).withColumns({"db_name": F.lit("Sales"), "connection_id": F.lit("01")})
    named = registered.select(F.lower("table_name").alias("key"), F.concat_ws(".", "hive_database", "hive_table").alias("hive"))
    target = target_columns(spark, sf_dir).join(named, F.col("table_name") == F.col("key"))
    target = target.select(F.col("hive").alias("table_name"), "ordinal", "name", "type")
    return registry.check_schemas(registered, source, target)
