import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.types import (
    export_type,
    import_type,
    map_types_export,
    map_types_import,
    normalize_types,
    override_column_types,
    parse_overrides,
    type_name,
)

CASES = {
    "int(11)": "int",
    "INT": "int",
    "int identity": "int",
    "bigint unsigned": "decimal(20,0)",
    "int(10) unsigned": "bigint",
    "int(10) unsigned zerofill": "bigint",
    "mediumint(9)": "int",
    "tinyint(1)": "tinyint",
    "tinyint(3) unsigned": "smallint",
    "smallint": "smallint",
    "bit(1)": "boolean",
    "boolean": "boolean",
    "decimal(10,2)": "double",
    "decimal(10,2) unsigned": "double",
    "double precision": "double",
    "NUMBER": "double",
    "NUMBER(10, 2)": "double",
    "money": "double",
    "float": "double",
    "datetime": "string",
    "timestamp": "string",
    "timestamp(6) with time zone": "string",
    "nvarchar": "string",
    "VARCHAR2": "string",
    "image": "string",
    "point": "string",
    "interval": "string",
    "enum('int')": "string",
}


@pytest.mark.parametrize("source,wanted", CASES.items())
def test_import_type(source, wanted):
    assert import_type(source) == wanted


def test_import_type_as_column(spark):
    df = spark.createDataFrame(list(CASES.items()), "t string, w string")
    assert df.where(map_types_import(type_name("t")) != F.col("w")).count() == 0


def test_exact_decimals():
    assert import_type("decimal(10,2)", exact_decimals=True) == "decimal(10,2)"
    assert import_type("NUMBER(12)", exact_decimals=True) == "decimal(12,0)"
    assert import_type("money", exact_decimals=True) == "decimal(19,4)"
    assert import_type("NUMBER", exact_decimals=True) == "double"


def test_sqlserver_tinyint_is_unsigned():
    assert import_type("tinyint", db_type="sqlserver") == "smallint"
    assert import_type("tinyint", db_type="mysql") == "tinyint"


def test_export_types(spark):
    cases = {"bigint": "bigint", "double": "double", "string": "varchar(255)", "boolean": "varchar(255)",
             "decimal(10,2)": "varchar(255)", "array<int>": "varchar(255)"}
    assert {k: export_type(k) for k in cases} == cases
    df = spark.createDataFrame(list(cases.items()), "t string, w string")
    assert df.where(map_types_export("t") != F.col("w")).count() == 0


def test_parse_overrides():
    assert parse_overrides("a=string,B = decimal(10,2)") == {"a": "string", "b": "decimal(10,2)"}
    assert parse_overrides(None) == {} == parse_overrides("")


def test_normalize_types(spark):
    df = spark.createDataFrame(
        [(1, Decimal("1.25"), dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5, 600000), True, bytearray(b"\x0a\xff"))],
        "id bigint, price decimal(10,2), day date, at timestamp_ntz, flag boolean, raw binary",
    )
    row = normalize_types(df).first()
    assert row.asDict() == {
        "id": 1, "price": 1.25, "day": "2024-01-02", "at": "2024-01-02 03:04:05.6", "flag": True, "raw": "0aff",
    }
    assert normalize_types(df, {"id": "string"}).first()["id"] == "1"
    assert dict(normalize_types(df, exact_decimals=True).dtypes)["price"] == "decimal(10,2)"


def test_override_touches_only_named_columns(spark):
    df = spark.createDataFrame([(1, 2.5)], "id int, price double")
    assert override_column_types(df, {"ID": "string"}).dtypes == [("id", "string"), ("price", "double")]


def test_time_strings_sort_like_times(spark):
    stamps = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 250000), dt.datetime(2024, 1, 1, 0, 0, 0, 500000),
              dt.datetime(2024, 1, 1, 0, 0, 1), dt.datetime(2024, 1, 1, 0, 0, 1, 5)]
    df = normalize_types(spark.createDataFrame([(s,) for s in stamps], "at timestamp_ntz"))
    texts = [r["at"] for r in df.collect()]
    assert sorted(texts) == texts
