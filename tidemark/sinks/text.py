"""Delimited text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import drop_delims, on_strings

# Field mark and the text that stands for NULL, raw or not.
FIELD_MARK = "\x01"
NULL_TEXT = "\\N"
PLAIN_NULL_TEXT = "null"


def _options(sep: str | None, line: str | None, raw_null: bool) -> dict[str, str]:
    options = {
        "sep": sep or FIELD_MARK,
        # A quote inside a value is doubled, so backslashes stay plain text.
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "nullValue": NULL_TEXT if raw_null else PLAIN_NULL_TEXT,
    }
    if line:
        options["lineSep"] = line
    return options


def delimiter(text: str | None) -> str | None:
    """A registry's mark as a character: ``\\001``, ``\\x01``, ``\\u0001``, ``\\t``, or the mark itself; None if blank."""
    if text is None or text == "":
        return None
    named = {"\\t": "\t", "\\n": "\n", "\\r": "\r", "\\0": "\0", "\\\\": "\\"}
    if text in named:
        return named[text]
    coded = re.fullmatch(r"\\([0-7]{3})|\\(?:x([0-9a-fA-F]{2})|u([0-9a-fA-F]{4}))", text)
    if coded:
        return chr(int(coded[1], 8) if coded[1] else int(coded[2] or coded[3], 16))
    return text


def table_options(sep: str | None, line: str | None, raw_null: bool) -> dict[str, str]:
    """Options of a text table that reads and writes as :func:`write_delimited` does."""
    return _options(sep, line, raw_null)


def clean_delimited(df: DataFrame, line: str | None = None) -> DataFrame:
    """Strings without line breaks and \\x01 marks, nor a line mark of their own."""
    clean = on_strings(df, drop_delims)
    return on_strings(clean, lambda c: F.translate(c, line, "")) if line else clean


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str | None = None,
    line: str | None = None,
    raw_null: bool = True,
    mode: str = "overwrite",
) -> None:
    """Write text rows after dropping line breaks and \\x01 marks from strings.

    A custom line mark is dropped from strings too, since a reader splits on
    it first; a custom field mark inside a value is kept by quoting.

    NULL is written as ``\\N`` and an empty string as ``""``, so both come back
    as they were. A value that is literally ``\\N`` reads back as NULL. With
    ``raw_null`` off the same holds for the word ``null``.
    """
    clean_delimited(df, line).write.mode(mode).options(**_options(sep, line, raw_null)).csv(path)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str | None = None,
    line: str | None = None,
    raw_null: bool = True,
) -> DataFrame:
    """Read what :func:`write_delimited` wrote."""
    return spark.read.schema(schema).options(mode="FAILFAST", **_options(sep, line, raw_null)).csv(path)
