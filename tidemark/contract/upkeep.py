"""Tables kept up to date: runs merged on reading, late rows, even readers, aligned columns, plans with needs."""

from pyspark.sql import functions as F

from ..operators import alignment, layout
from ..plans import graph, importing, registry, runs
from ..session import scratch_database
from ..sinks import tables as sink
from ..sinks import versions
from ..sources import marks, splits
from .base import given, query
from .merge import MIDDLE_SQL, WITH, clinics, new_rows, old_rows
from .schema import SOURCE_SQL, TARGET_SQL, source_columns, target_columns
from .unique import ETL_TIME, LINE_DELETES_SQL, LINE_LOG_SQL, etl_time, line_deletes, line_log


@query(f"""
WITH log AS ({LINE_LOG_SQL}), deletes AS ({LINE_DELETES_SQL}),
     a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, orgid
             ORDER BY updatestamp DESC NULLS LAST, partkey DESC, price DESC) AS rn FROM log) WHERE rn = 1),
     b AS (SELECT p_id, p_orgid, max(updatestamp) AS p_ts FROM deletes GROUP BY p_id, p_orgid)
SELECT a.id, a.orgid, a.updatestamp, a.partkey, a.price, TIMESTAMP '{ETL_TIME}' AS etl_time
FROM a LEFT JOIN b ON a.id = b.p_id AND a.orgid = b.p_orgid WHERE b.p_ts IS NULL OR a.updatestamp > b.p_ts""")
def unique_merge_on_read(spark, sf_dir):
    """The log and its deletes applied in six runs, two of which merge others: the same as a rebuild."""
    table = f"{scratch_database(spark, 'unique_merge_on_read')}.ods_pms_lines"
    log, deletes = line_log(spark, sf_dir), line_deletes(spark, sf_dir)
    runs.create_runs(spark, table, log, ["id", "orgid"], "updatestamp", ["partkey", "price"])
    for part in range(6):
        new = log.where(f"partkey % 6 = {part}")
        gone = deletes.where("p_id IS NULL" if part == 5 else f"p_id % 5 = {part}")
        runs.add_run(spark, table, new, gone, fan=3)
    return runs.current_rows(spark, table, etl_time())


# A first load of January's first ten days that lacks every seventh event, which are committed later.
FIRST_LOAD = "ts < TIMESTAMP '2024-01-11' AND event_id % 7 <> 0"


@query(f"""
WITH source AS (SELECT event_id, date_trunc('hour', ts) AS ts, user_id, value FROM events
                WHERE ts < TIMESTAMP '2024-01-21'),
     loaded AS (SELECT * FROM source WHERE {FIRST_LOAD}),
     mark AS (SELECT max(ts) - INTERVAL 36 HOUR AS low FROM loaded)
SELECT * FROM loaded
UNION ALL
SELECT s.* FROM source s, mark WHERE s.ts >= low AND NOT EXISTS (
  SELECT 1 FROM loaded l WHERE l.event_id = s.event_id AND l.ts = s.ts)""")
def window_load(spark, sf_dir):
    """Two loads whose stamps are whole hours, so that many rows are late with a stamp that was loaded."""
    events = given(spark, sf_dir, "events").where("ts < TIMESTAMP_NTZ '2024-01-21'")
    source = events.select("event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "user_id", "value")
    table = f"{scratch_database(spark, 'window_load')}.src_log_events"
    source.where(FIRST_LOAD.replace("TIMESTAMP", "TIMESTAMP_NTZ")).write.format("orc").saveAsTable(table)
    late = marks.window_load(source, spark.table(table), "ts", ["event_id"], "36 hours")
    sink.append_table(late, table)
    return spark.table(table)


@query("""
WITH mark AS (SELECT max(ts) AS stamp, max(ts) - INTERVAL 90 MINUTE AS low_value FROM events)
SELECT stamp AS max_value, (SELECT max(event_id) FROM events WHERE ts = stamp) AS max_key, low_value FROM mark""")
def composite_mark(spark, sf_dir):
    mark = marks.composite_mark(given(spark, sf_dir, "events"), "ts", ["event_id"], "90 minutes")
    return mark.select("max_value", F.col("max_key.event_id").alias("max_key"), "low_value")


@query("SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id FROM events")
def import_overlap(spark, sf_dir):
    """An import that goes back a day behind its mark: of a day's rows half were late, none is lost or doubled."""
    database = scratch_database(spark, "import_overlap")
    events = given(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    task = importing.ImportTask(
        "log", "events", database, "src_log_events", filter="ts >= '{max_value}'", max_value="max(ts)",
        overlap="1 day", seen_by="event_id",
    )
    punctual = "(ts < TIMESTAMP_NTZ '2024-01-15' OR event_id % 2 = 0) AND ts < TIMESTAMP_NTZ '2024-01-16'"
    for known in (punctual, "true", "true"):
        importing.import_table(spark, task, events.where(known).where, unique=False)
    return spark.table(f"{database}.src_log_events")


DELIMITED_SQL = """
SELECT doc_id, lang, replace(replace(replace(replace(text, chr(10), ''), chr(13), ''), chr(1), ''), '~', '') AS text, n_chars
FROM documents"""


@query(DELIMITED_SQL)
def import_delimited(spark, sf_dir):
    """An import whose registry row names marks: the target is text with them, NULL as the registry says."""
    database = scratch_database(spark, "import_delimited")
    docs = given(spark, sf_dir, "documents").select("doc_id", "lang", "text", "n_chars")
    row = spark.createDataFrame(
        [("web", "documents", database, "src_web_documents", "|", "~", "1")],
        "db_name string, table_name string, hive_database string, hive_table string, fields_terminated_by string,"
        " line_terminated_by string, use_raw_null string",
    ).first()
    importing.import_table(spark, importing.ImportTask.from_row(row), docs.where, unique=False)
    return spark.table(f"{database}.src_web_documents")


READERS = 7


@query("""
SELECT l_orderkey, count(*) AS lines, 1 AS readers, true AS even FROM lineitem GROUP BY l_orderkey""")
def even_splits(spark, sf_dir):
    """Lines read in ranges of equal counts, half of them under keys that lie close together: each by one reader."""
    lines = given(spark, sf_dir, "lineitem").select("l_orderkey")
    spread = F.when(F.col("l_orderkey") % 2 == 0, F.col("l_orderkey") * 1_000_003).otherwise(F.col("l_orderkey"))
    keyed = lines.withColumn("key", spread)
    read = None
    for number, where in enumerate(splits.equal_predicates(keyed, "key", READERS)):
        part = keyed.where(where).withColumn("reader", F.lit(number))
        read = part if read is None else read.unionByName(part)
    shares = read.groupBy("reader").count().agg(
        (F.max("count") <= F.sum("count") / READERS * 1.25).alias("even")
    )
    found = read.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("reader").cast("int").alias("readers")
    )
    return found.join(F.broadcast(shares))  # one row


# Of every table's columns those with an odd discount are missing on the one side, and some swap places.
CHANGED_SQL = f"""
SELECT table_name, CAST(CASE WHEN type = 'string' THEN ordinal + 10 ELSE ordinal END AS INTEGER) AS ordinal, name
FROM ({TARGET_SQL}) WHERE name <> 'other'"""


@query(f"""
WITH RECURSIVE s AS (SELECT table_name, lower(name) AS key, name, ordinal FROM ({SOURCE_SQL})),
  t AS (SELECT table_name, lower(name) AS key, name, ordinal FROM ({CHANGED_SQL})),
  m AS (SELECT coalesce(s.table_name, t.table_name) AS table_name, coalesce(s.name, t.name) AS name,
               s.ordinal AS source_ordinal, t.ordinal AS target_ordinal
        FROM s FULL JOIN t ON s.table_name = t.table_name AND s.key = t.key),
  p AS (SELECT table_name, source_ordinal AS i, target_ordinal AS j FROM m
        WHERE source_ordinal IS NOT NULL AND target_ordinal IS NOT NULL),
  chains AS (
    SELECT table_name, i, j, [i] AS chain FROM p
    UNION ALL
    SELECT p.table_name, p.i, p.j, list_append(c.chain, p.i) FROM chains c JOIN p
      ON p.table_name = c.table_name AND p.i > c.i AND p.j > c.j),
  best AS (SELECT table_name, arg_min(chain, (-len(chain), chain)) AS chain FROM chains GROUP BY table_name)
SELECT m.table_name, m.name, m.source_ordinal, m.target_ordinal,
       CASE WHEN m.target_ordinal IS NULL THEN 'inserted' WHEN m.source_ordinal IS NULL THEN 'removed'
            WHEN list_contains(b.chain, m.source_ordinal) THEN 'kept' ELSE 'moved' END AS change
FROM m LEFT JOIN best b USING (table_name)""")
def schema_alignment(spark, sf_dir):
    moved = F.when(F.col("type") == "string", F.col("ordinal") + 10).otherwise(F.col("ordinal"))
    changed = target_columns(spark, sf_dir).where("name <> 'other'").withColumn("ordinal", moved)
    return alignment.schema_alignment(source_columns(spark, sf_dir), changed)


@query("SELECT n_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name")
def replace_versioned(spark, sf_dir):
    """A table replaced three times without a gap, the second time from its own rows."""
    table = f"{scratch_database(spark, 'replace_versioned')}.final_suppliers"
    supplier, nation = given(spark, sf_dir, "supplier", "nation")
    named = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    versions.replace_versioned(named.select("n_name", "s_suppkey"), table)
    versions.replace_versioned(spark.table(table).unionAll(spark.table(table)), table)
    versions.replace_versioned(spark.table(table).distinct(), table)
    return spark.table(table).groupBy("n_name").agg(F.count(F.lit(1)).alias("suppliers"))


GRAPH_TABLES = ("region", "nation", "customer", "supplier", "no_such_table", "part")


@query(
    " UNION ALL ".join(
        f"SELECT {k} AS id, '{name}' AS table_name, "
        + ("'2024-01-01' AS last_exec_date, 'FAILED' AS status, -1 AS n" if name == "no_such_table" else
           "'2024-01-01' AS last_exec_date, 'CANCELLED' AS status, -1 AS n" if name == "part" else
           f"'2024-01-02' AS last_exec_date, 'SUCCEEDED' AS status, (SELECT count(*) FROM {name}) AS n")
        for k, name in enumerate(GRAPH_TABLES, 1)
    )
)
def run_graph(spark, sf_dir):
    """A registry's tables imported three at a time in the order of their needs; what needs the missing one is cancelled."""
    database = scratch_database(spark, "run_graph")
    ledger = f"{database}.runs"
    sink.create_table(spark, ledger, [tuple(c.split()) for c in registry.LEDGER.split(",")])
    connections = spark.createDataFrame([("01", "sales", "1")], "connection_id string, connection_name string, status string")
    registered = spark.createDataFrame(
        [(k, "01", "sales", name, "2024-01-01", None, "1") for k, name in enumerate(GRAPH_TABLES, 1)],
        "id int, connection_id string, db_name string, table_name string, last_exec_date string, task_order int, status string",
    )

    def load(row):
        task = importing.ImportTask(row["db_name"], row["table_name"], database, f"src_sales_{row['table_name']}")
        importing.import_table(spark, task, given(spark, sf_dir, row["table_name"]).where, unique=False)

    plan = registry.sync_plan(connections, registered, "2024-01-02")
    needs = {2: [1], 3: [2], 4: [2], 6: [5, 1]}
    dated = graph.run_plan_at_once(spark, plan, registered, load, ledger, "2024-01-02", needs, at_once=3)
    there = [name for name in GRAPH_TABLES if spark.catalog.tableExists(f"{database}.src_sales_{name}")]
    counts = registry.table_rowcounts({name: spark.table(f"{database}.src_sales_{name}") for name in there})
    status = spark.table(ledger).select("id", F.col("status"))
    return (
        dated.drop("status").join(status, "id").join(counts, "table_name", "left")
        .select("id", "table_name", "last_exec_date", "status", F.coalesce("table_rows", F.lit(-1)).alias("n"))
    )


@query(f"""
{WITH}, mid AS ({MIDDLE_SQL})
SELECT s.brand_code, s.clinic_name, t.* FROM mid t JOIN dim s ON t.orgid = s.clinic_id""")
def merge_stored(spark, sf_dir):
    """Both lineages stored by clinic and salt, merged where they lie."""
    database = scratch_database(spark, "merge_stored")
    for name, rows in (("old", old_rows(spark, sf_dir)), ("new", new_rows(spark, sf_dir))):
        layout.store_salted(rows, f"{database}.{name}", "orgid", [c for c in rows.columns if c != "orgid"])
    return layout.merge_stored(spark, f"{database}.old", f"{database}.new", clinics(spark, sf_dir))


COUNTED = ("nation", "customer", "orders", "lineitem")


@query(" UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS table_rows FROM {name}" for name in COUNTED))
def warehouse_rowcounts(spark, sf_dir):
    """Tables of the warehouse counted by their files' footers."""
    database = scratch_database(spark, "warehouse_rowcounts")
    for name in COUNTED:
        given(spark, sf_dir, name).write.format("orc").saveAsTable(f"{database}.{name}")
    found = registry.warehouse_rowcounts(spark, [f"{database}.{name}" for name in COUNTED])
    return found.withColumn("table_name", F.substring_index("table_name", ".", -1))
