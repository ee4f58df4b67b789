import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.dates import day_string, parse_date, partition_value, yesterday
from tidemark.functions.names import (
    concat_name,
    database_part,
    matches,
    quoted,
    relayer,
    replace_layer,
    same_text,
    split_name,
)
from tidemark.functions.text import drop_delims, is_blank, nan_to_null, on_strings, sanitize_text, split_list

TEXT = ["a\r\nb", "a\rb", "a\tb", "a\x01b", None, "", "\\N", "\r\n\r\n", "plain", " pad "]


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def evaluate(spark, values, expr, kind="string"):
    return [r["o"] for r in column(spark, values, kind).withColumn("o", expr).orderBy("i").collect()]


def test_drop_delims(spark):
    assert evaluate(spark, TEXT, drop_delims("v")) == ["ab", "ab", "a\tb", "ab", None, "", "\\N", "", "plain", " pad "]


def test_sanitize_text(spark):
    assert evaluate(spark, TEXT, sanitize_text("v")) == ["a b", "a b", "a b", "a\x01b", None, "", "\\N", "  ", "plain", " pad "]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="ab\r\n\t\x01 \\'\"", max_size=12), min_size=1, max_size=20))
def test_text_against_plain_python(spark, values):
    assert evaluate(spark, values, drop_delims("v")) == [v.translate({10: None, 13: None, 1: None}) for v in values]
    plain = [v.replace("\r\n", " ").replace("\r", " ").replace("\n", " ").replace("\t", " ") for v in values]
    assert evaluate(spark, values, sanitize_text("v")) == plain


def test_is_blank(spark):
    assert evaluate(spark, [None, "", " \t\n", "　", "x", " x\n"], is_blank("v")) == [True, True, True, True, False, False]


def test_split_list_and_nan(spark):
    assert evaluate(spark, ["a, b,c", None], split_list("v")) == [["a", "b", "c"], None]
    assert evaluate(spark, [1.5, float("nan"), None], nan_to_null("v"), "double") == [1.5, None, None]


def test_on_strings_leaves_other_columns(spark):
    df = on_strings(column(spark, ["a\nb"]), drop_delims)
    assert df.dtypes == [("i", "int"), ("v", "string")] and df.first()["v"] == "ab"


def test_names(spark):
    assert split_name("dw.t") == ("dw", "t")
    for bad in ("t", ".t", "dw.", "a.b.c"):
        with pytest.raises(ValueError):
            split_name(bad)
    assert quoted("cat.db.t") == "`cat`.`db`.`t`"
    assert relayer("src_x.src_a_src_b", "src_", "ods_") == "src_x.ods_a_src_b"
    with pytest.raises(ValueError):
        relayer("dw.ods_a", "src_", "ods_")
    assert evaluate(spark, ["dw.src_a_src_b", "src_c", "dw.ods_src_d"], replace_layer("v", "src_", "ods_")) == [
        "dw.ods_a_src_b", "ods_c", "dw.ods_src_d",
    ]
    assert evaluate(spark, ["t"], concat_name(F.lit("db"), F.col("v"))) == ["src_db_t"]
    assert evaluate(spark, ["src_pms_creg", "src_pms", "src__x", None], database_part("v")) == ["pms", "", "", None]
    assert evaluate(spark, ["dw.src_PMS_x", "dw.src_his_x"], matches("v", "_pms_|_pmsweb_")) == [True, False]
    assert evaluate(spark, ["PPets"], same_text("v", F.lit("ppets"))) == [True]


def test_dates(spark):
    values = ["20240229", "20230229", "20241399", "2024011", "202401011", "x", None, "2024-1-1"]
    parsed = evaluate(spark, values, parse_date("v").isNotNull())
    assert parsed == [True, False, False, False, False, False, False, False]
    assert evaluate(spark, ["x"], yesterday(F.lit(dt.date(2024, 3, 1)))) == ["20240229"]
    assert len(evaluate(spark, ["x"], yesterday())[0]) == 8
    assert day_string(dt.date(2024, 3, 1), back=1) == "20240229"
    assert partition_value("$yesterday", dt.date(2024, 1, 1)) == "20231231"
    assert partition_value("fixed", dt.date(2024, 1, 1)) == "fixed"
