"""Tables replaced without a gap, and the structure of database tables."""

import threading

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_database
from tidemark.sinks import structure, versions
from tidemark.sinks.batches import Database
from tidemark.sinks.structure import Detail, IndexPart


def held(spark, table):
    return {r[0] for r in spark.table(table).select("v").distinct().collect()}


def test_a_reader_never_misses_the_table(spark):
    table = f"{scratch_database(spark, 'swap')}.final_t"
    rows = lambda v: spark.range(20, numPartitions=3).withColumn("v", F.lit(v))
    versions.replace_versioned(rows(0), table)
    stop, seen, errors = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                seen.append([tuple(r) for r in spark.table(table).groupBy("v").count().collect()])
            except Exception as error:  # noqa: BLE001
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 6):
        versions.replace_versioned(spark.table(table).withColumn("v", F.lit(v)), table)  # reads what it replaces
    stop.set()
    reader.join()
    assert not errors and all(len(s) == 1 and s[0][1] == 20 for s in seen) and held(spark, table) == {5}
    assert versions.stored_versions(spark, table) == {5: True, 6: True}


@pytest.mark.parametrize("step", ["write_version", "point_to", "expire_versions"])
@pytest.mark.parametrize("before", [True, False])
def test_a_program_that_ends_between_steps(spark, monkeypatch, step, before):
    table = f"{scratch_database(spark, 'ends')}.final_t"
    versions.replace_versioned(spark.range(5).withColumn("v", F.lit("old")), table)
    own = getattr(versions, step)

    def end(*args):
        if not before:
            own(*args)
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(versions, step, end)
        with pytest.raises(KeyboardInterrupt):
            versions.replace_versioned(spark.range(7).withColumn("v", F.lit("new")), table)
    pointed = (step == "point_to" and not before) or step == "expire_versions"
    assert held(spark, table) == {"new" if pointed else "old"} and spark.table(table).count() == (7 if pointed else 5)
    versions.replace_versioned(spark.range(3).withColumn("v", F.lit("later")), table)
    assert held(spark, table) == {"later"} and len(versions.stored_versions(spark, table)) <= 3


def test_columns_older_versions_and_moving_over(spark):
    table = f"{scratch_database(spark, 'columns')}.final_t"
    spark.range(3).withColumn("v", F.lit("made otherwise")).write.format("orc").saveAsTable(table)
    assert versions.current_version(spark, table) is None and versions.expire_versions(spark, table) == []
    versions.replace_versioned(spark.range(2).withColumn("v", F.lit("a")), table)
    versions.replace_versioned(spark.range(2).withColumn("v", F.lit("b")).withColumn("more", F.lit(1)), table)
    assert spark.table(table).columns == ["id", "v", "more"] and versions.current_version(spark, table) == 2
    versions.point_to(spark, table, 1)
    assert [r["more"] for r in spark.table(table).collect()] == [None, None]
    with pytest.raises(ValueError, match="other columns"):
        versions.replace_versioned(spark.range(2).withColumn("w", F.lit("x")), table)
    with pytest.raises(ValueError, match="no whole version"):
        versions.point_to(spark, table, 99)
    versions.drop_versioned(spark, table)
    assert versions.stored_versions(spark, table) == {} and not spark.catalog.tableExists(table)


DETAILS = {
    "mysql": [
        Detail(2, "name", "varchar(20)", False, "it's"), Detail(1, "id", "bigint unsigned", False, None, "auto_increment"),
        Detail(3, "at", "datetime", True, "CURRENT_TIMESTAMP", "DEFAULT_GENERATED on update CURRENT_TIMESTAMP"),
        Detail(4, "code", "varchar(36)", True, "uuid()", "DEFAULT_GENERATED"), Detail(5, "on", "bit(1)", True, "b'0'"),
    ],
    "sqlserver": [Detail(1, "id", "int", False), Detail(2, "name", "nvarchar(max)", True, "(N'x')"), Detail(3, "at", "datetime2", False, "(getdate())")],
    "oracle": [Detail(1, "ID", "NUMBER(19,0)", False), Detail(2, "NAME", "VARCHAR2(20 CHAR)", True, "'x' "), Detail(3, "AT", "DATE", False, "SYSDATE")],
}


def parts(upper=False):
    name = str.upper if upper else str
    return [
        IndexPart("by_name", "N", 2, name("id"), True), IndexPart("by_name", "N", 1, name("name"), False, 8),
        IndexPart("PRIMARY", "P", 1, name("id")), IndexPart("at_20240101", "U", 1, name("at")), IndexPart("odd", "N", 1, None),
    ]


def test_structure_of_three_databases():
    made = {
        kind: structure.structure_statements(DETAILS[kind], parts(kind == "oracle"), "pms.t_20240102", Database(kind, None), "20240102")
        for kind in DETAILS
    }
    assert made["mysql"] == [
        "CREATE TABLE `pms`.`t_20240102` (`id` bigint unsigned NOT NULL AUTO_INCREMENT,"
        " `name` varchar(20) DEFAULT 'it''s' NOT NULL,"
        " `at` datetime DEFAULT CURRENT_TIMESTAMP ON UPDATE CURRENT_TIMESTAMP, `code` varchar(36) DEFAULT (uuid()),"
        " `on` bit(1) DEFAULT b'0', PRIMARY KEY (`id`))",
        "CREATE UNIQUE INDEX `at_20240101` ON `pms`.`t_20240102` (`at`)",
        "CREATE INDEX `by_name` ON `pms`.`t_20240102` (`name`(8), `id` DESC)",
    ]
    assert made["sqlserver"] == [
        "CREATE TABLE [pms].[t_20240102] ([id] int NOT NULL, [name] nvarchar(max) DEFAULT (N'x'),"
        " [at] datetime2 DEFAULT (getdate()) NOT NULL, PRIMARY KEY ([id]))",
        "CREATE UNIQUE INDEX [at_20240101] ON [pms].[t_20240102] ([at])",
        "CREATE INDEX [by_name] ON [pms].[t_20240102] ([name], [id] DESC)",
    ]
    assert made["oracle"] == [
        'CREATE TABLE "pms"."t_20240102" ("ID" NUMBER(19,0) NOT NULL, "NAME" VARCHAR2(20 CHAR) DEFAULT \'x\','
        ' "AT" DATE DEFAULT SYSDATE NOT NULL, PRIMARY KEY ("ID"))',
        'CREATE UNIQUE INDEX "at_20240102" ON "pms"."t_20240102" ("AT")',
        'CREATE INDEX "by_name_20240102" ON "pms"."t_20240102" ("NAME", "ID" DESC)',
    ]
    with pytest.raises(ValueError, match="no columns"):
        structure.structure_statements([], [], "t", Database("mysql", None))


def test_staging_is_read_from_the_catalogue(monkeypatch):
    from tidemark.sources.jdbc import Connection

    ran = []

    class Session:
        def cursor(self):
            return self

        def execute(self, text):
            ran.append(text)

        def commit(self):
            ran.append("commit")

        def close(self):
            ran.append("close")

    class Rows(list):
        def collect(self):
            return self

    def scan(spark, connection, query):
        if "statistics" in query:
            return Rows([("T", "PRIMARY", "P", 1, "id", 0, None), ("other", "x", "N", 1, "id", 0, None)])
        return Rows([("t", 1, "id", "int", 0, None, ""), ("t_20240102", 1, "id", "int", 0, None, ""), ("other", 1, "z", "int", 1, None, None)])

    monkeypatch.setattr(structure, "jdbc_scan", scan)
    connection = Connection("01", "mysql", "h", 1, "pms")
    assert structure.stage_like(None, connection, Database("mysql", Session), "pms.t", "20240102") == "pms.t_20240102"
    assert ran == [
        "DROP TABLE `pms`.`t_20240102`", "CREATE TABLE `pms`.`t_20240102` (`id` int NOT NULL, PRIMARY KEY (`id`))", "commit", "close",
    ]
