"""String clean-up for columns that pass through delimited text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_delims(column: str | Column) -> Column:
    """Remove line feeds, carriage returns and the \\x01 field mark."""
    return _replace_each(column, ("\n", "\r", "\x01"), "")


def sanitize_text(column: str | Column) -> Column:
    """Turn each line break or tab into one space; CR LF counts once."""
    return _replace_each(column, ("\r\n", "\n", "\r", "\t"), " ")


def _replace_each(column: str | Column, marks: tuple[str, ...], by: str) -> Column:
    # Literal replacement; about twice as fast as a pattern or translate.
    column = F.col(column) if isinstance(column, str) else column
    return reduce(lambda c, mark: F.replace(c, F.lit(mark), F.lit(by)), marks, column)


def is_blank(column: str | Column) -> Column:
    """True for NULL, the empty string and strings of white space only."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.rlike(r"(?U)\A\s*\z"), F.lit(True))


def split_list(column: str | Column) -> Column:
    """Split a comma list into trimmed items."""
    return F.transform(F.split(column, ","), lambda item: F.trim(item))


def nan_to_null(column: str | Column) -> Column:
    """NaN becomes NULL."""
    return F.when(~F.isnan(column), column if isinstance(column, Column) else F.col(column))


def on_strings(df: DataFrame, fn) -> DataFrame:
    """Apply a column function to every string column, keeping the order."""
    return df.select(
        *[
            fn(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
