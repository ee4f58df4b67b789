import pytest

from tidemark.operators.schema import (
    alter_statements,
    column_catalogue,
    evolve_add_columns,
    missing_sources,
    schema_diff_export,
    schema_diff_import,
    schema_drift_report,
)

SOURCE = {
    "same": [("Id", "int(11)"), ("name", "varchar(20)")],
    "retyped": [("id", "bigint"), ("name", "varchar(20)")],
    "grown": [("id", "int"), ("name", "text"), ("born", "datetime"), ("paid", "decimal(10,2)")],
    "swapped": [("name", "text"), ("id", "int"), ("more", "int")],
    "shrunk": [("id", "int")],
    "fresh": [("id", "int")],
}
TARGET = {
    "same": [("id", "int"), ("name", "string")],
    "retyped": [("id", "int"), ("name", "string")],
    "grown": [("id", "int"), ("name", "string")],
    "swapped": [("id", "int"), ("name", "string")],
    "shrunk": [("id", "int"), ("extra", "string")],
}


@pytest.fixture(scope="module")
def diff(spark):
    return schema_diff_import(column_catalogue(spark, SOURCE), column_catalogue(spark, TARGET))


def flags(diff, table):
    return [r["flag"] for r in diff.where(diff["table_name"] == table).orderBy("ordinal").collect()]


def test_import_flags(diff):
    assert flags(diff, "same") == ["same", "same"]
    assert flags(diff, "retyped") == ["diff", "same"]
    assert flags(diff, "grown") == ["same", "same", "add", "add"]
    assert flags(diff, "swapped") == ["drift", "drift", "add"]
    assert flags(diff, "shrunk") == ["same"]
    assert flags(diff, "fresh") == ["create"]


def test_columns_to_add(diff):
    added = evolve_add_columns(diff).orderBy("table_name", "ordinal").collect()
    assert [(r["table_name"], r["name"], r["type"]) for r in added] == [
        ("grown", "born", "string"),
        ("grown", "paid", "double"),
    ]


def test_alter_statements_show_drifted_tables_too(diff):
    shown = {r["statement"] for r in alter_statements(diff).collect()}
    assert shown == {
        "ALTER TABLE grown ADD COLUMNS (born string)",
        "ALTER TABLE grown ADD COLUMNS (paid double)",
        "ALTER TABLE swapped ADD COLUMNS (more int)",
    }


def test_drift_report(diff):
    report = {r["table_name"]: (r["added"], r["retyped"], r["drifted"], r["action"]) for r in schema_drift_report(diff).collect()}
    assert report == {
        "grown": (2, 0, 0, "add columns"),
        "retyped": (0, 1, 0, "report only"),
        "swapped": (1, 0, 2, "no alter: columns out of order"),
    }


def test_export_flags(spark):
    source = {"t": [("id", "int"), ("name", "string"), ("Day", "string"), ("ok", "boolean"), ("paid", "double")],
              "u": [("Id", "int"), ("x", "int")]}
    target = {"t": [("id", "int(11)"), ("name", "TEXT"), ("Day", "char(8)"), ("ok", "bit(1)")], "u": [("id", "int")]}
    diff = schema_diff_export(column_catalogue(spark, source), column_catalogue(spark, target))
    assert flags(diff, "t") == ["same", "same", "same", "diff", "add"]
    assert flags(diff, "u") == ["drift", "add"]
    assert [(r["name"], r["type"]) for r in evolve_add_columns(diff).collect()] == [("paid", "double")]


def test_missing_sources(spark):
    listed = spark.createDataFrame([("same",), ("gone",)], "table_name string")
    assert [r[0] for r in missing_sources(listed, column_catalogue(spark, SOURCE)).collect()] == ["gone"]
