"""Table names: layers, systems and the parts stored in them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_name(table: str) -> tuple[str, str]:
    """``database.table`` into its parts; anything else is refused."""
    database, dot, name = table.partition(".")
    if not (database and dot and name) or "." in name:
        raise ValueError(f"expected database.table, got {table!r}")
    return database, name


def quoted(table: str) -> str:
    """Back-quote every part of a dotted name for use in a statement."""
    return ".".join(f"`{part}`" for part in table.replace("`", "").split("."))


def relayer(table: str, old: str, new: str) -> str:
    """Swap the layer prefix of ``database.table``; only the prefix counts."""
    database, name = split_name(table)
    if not name.startswith(old):
        raise ValueError(f"{table!r} is not a {old!r} table")
    return f"{database}.{new}{name[len(old):]}"


def replace_layer(column: str | Column, old: str, new: str) -> Column:
    """Column form of :func:`relayer`; names of another layer stay as is."""
    return F.regexp_replace(column, rf"^([^.]+\.)?{re.escape(old)}", f"$1{new}")


def concat_name(db: str | Column, table: str | Column, layer: str = "src_") -> Column:
    """``<layer><db>_<table>``."""
    return F.concat(F.lit(layer), db, F.lit("_"), table)


def database_part(column: str | Column) -> Column:
    """Database part of ``src_<db>_<table>``: from position 5 to the next ``_``."""
    column = F.col(column) if isinstance(column, str) else column
    end = F.locate("_", column, 5)
    return F.when(end > 0, F.substring(column, F.lit(5), end - 5)).when(end == 0, F.lit(""))


def matches(column: str | Column, pattern: str) -> Column:
    """Case-insensitive regular expression search."""
    return F.rlike(column, F.lit(f"(?i){pattern}"))


def same_text(left: str | Column, right: str | Column) -> Column:
    """Case-insensitive equality."""
    return F.lower(left) == F.lower(right)
