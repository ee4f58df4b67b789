"""JDBC scans, up to the options that Spark's reader gets. No database is started."""

import pytest

from tidemark.plans import importing
from tidemark.plans.importing import ImportTask, jdbc_source
from tidemark.sources import jdbc
from tidemark.sources.jdbc import spread_predicates, Connection, Split

MYSQL = Connection("01", "MySQL", "db1", 3306, "pms", "useUnicode=true&characterEncoding=utf-8")
SQLSERVER = Connection("02", "sqlserver", "db2", 1433, "PMS", "encrypt=false")
ORACLE = Connection("03", "oracle", "db3", 1521, "ORCL")


class Reader:
    """Records what a scan hands to ``spark.read``."""

    def __init__(self, rows=None):
        self.seen, self.rows = [], rows

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.seen.append(options)
        return self

    def load(self):
        return self

    def first(self):
        return self.rows

    def toDF(self, *names):
        return names


def test_urls():
    assert MYSQL.url == "jdbc:mysql://db1:3306/pms?useUnicode=true&characterEncoding=utf-8&tinyInt1isBit=false"
    assert Connection("06", "mysql", "h", 1, "d").url == "jdbc:mysql://h:1/d?tinyInt1isBit=false"
    assert Connection("07", "mysql", "h", 1, "d", "tinyInt1isBit=true").url == "jdbc:mysql://h:1/d?tinyInt1isBit=true"
    assert SQLSERVER.url == "jdbc:sqlserver://db2:1433;databaseName=PMS;encrypt=false"
    assert ORACLE.url == "jdbc:oracle:thin:@db3:1521:ORCL"
    with pytest.raises(ValueError, match="database type"):
        Connection("04", "access", "h", 1, "d").url


def test_secrets_come_from_the_environment(monkeypatch):
    assert "password" not in MYSQL.options()
    monkeypatch.setenv("TIDEMARK_01_USER", "u")
    monkeypatch.setenv("TIDEMARK_01_PASSWORD", "p")
    assert (MYSQL.options()["user"], MYSQL.options()["password"]) == ("u", "p")
    assert "p" not in repr(MYSQL).split("'")


def test_relation():
    assert jdbc.relation(MYSQL, "visits") == "visits"
    assert jdbc.relation(ORACLE, "visits") == "VISITS"
    assert jdbc.relation(MYSQL, "visits", where="1=1") == "visits"
    assert jdbc.relation(MYSQL, "visits", where="id > 5") == "(SELECT * FROM visits WHERE id > 5) src"
    assert jdbc.relation(MYSQL, "visits", query="select id from v; ", where="id > 5") == "(select id from v) src"
    with pytest.raises(ValueError):
        jdbc.relation(MYSQL)


def test_read_options():
    options = jdbc.read_options(MYSQL, "visits", split=Split("id", 1, 900, 4), types={"id": "BIGINT", "at": "STRING"})
    assert options["dbtable"] == "visits" and options["fetchsize"] == "10000"
    assert [options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == ["id", "1", "900", "4"]
    assert options["customSchema"] == "id BIGINT, at STRING"
    assert "partitionColumn" not in jdbc.read_options(MYSQL, "visits", split=Split("id", 1, 900, 1))


def test_listings():
    reader = Reader()
    assert jdbc.list_source_tables(reader, MYSQL) == ("table_name",)
    assert reader.seen[0]["dbtable"] == "(SELECT table_name FROM information_schema.tables WHERE table_schema = 'pms') src"
    assert "sys.tables" in jdbc.catalogue_query(SQLSERVER, jdbc.LIST_TABLES)
    quoted = jdbc.catalogue_query(Connection("05", "mysql", "h", 1, "o'db"), jdbc.LIST_COLUMNS)
    assert quoted.endswith("table_schema = 'o''db'")


def test_split_bounds():
    reader = Reader(rows=(3, 90))
    assert jdbc.jdbc_split(reader, MYSQL, "id", 4, "visits", where="id > 2") == Split("id", 3, 90, 4)
    assert reader.seen[0]["dbtable"] == "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM (SELECT * FROM visits WHERE id > 2) src) src"
    assert jdbc.jdbc_split(Reader(rows=(None, None)), MYSQL, "id", 4, "visits") is None


def test_task_scan():
    reader = Reader(rows=(1, 100))
    scan = jdbc_source(reader, MYSQL, ImportTask("pms", "visits", "dw", "src_pms_visits", split_by="id", m=3))
    scan("id > 7")
    assert reader.seen[-1]["numPartitions"] == "3"
    assert reader.seen[-1]["dbtable"] == "(SELECT * FROM visits WHERE id > 7) src"
    plain = Reader()
    jdbc_source(plain, MYSQL, ImportTask("pms", "visits", "dw", "t", query_sql="select id from v"))("1=1")
    assert plain.seen == [{**MYSQL.options(), "dbtable": "(select id from v) src", "fetchsize": "10000"}]
    assert importing.DEFAULT_READERS > 1


def test_catalog_options():
    options = jdbc.catalog_options(MYSQL, "clinic", writers=6)
    assert options["spark.sql.catalog.clinic"].endswith("JDBCTableCatalog")
    assert options["spark.sql.catalog.clinic.url"] == MYSQL.url
    assert options["spark.sql.catalog.clinic.numPartitions"] == "6"


@pytest.mark.parametrize("kind", ["mysql", "sqlserver", "oracle"])
def test_spread_readers_share_all_rows(spark, kind):
    """Skewed, negative and NULL keys each pass one filter."""
    keys = spark.sql("SELECT explode(array(1, 1, 1, 2, -1, -7, 0, 1000003, NULL)) AS k")
    filters = spread_predicates(Connection("1", kind, "h", 1, "d"), "k", 4)
    assert len(filters) == 4
    passed = keys.selectExpr("k", " + ".join(f"IF({f}, 1, 0)" for f in filters) + " AS n")
    assert passed.where("n <> 1").count() == 0
