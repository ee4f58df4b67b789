"""Rules from source types to warehouse types and on to database types."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole source type names and their warehouse type. A length is
# gone by now; a name that is not listed becomes a string.
IMPORT_TYPES = (
    (("tinyint",), "tinyint"),
    (("tinyint unsigned", "smallint"), "smallint"),
    (("smallint unsigned", "mediumint", "mediumint unsigned", "int", "integer"), "int"),
    (("int unsigned", "integer unsigned", "bigint"), "bigint"),
    (("bigint unsigned",), "decimal(20,0)"),
    (("float", "double", "double precision", "real", "decimal", "dec", "numeric", "number"), "double"),
    (("float unsigned", "double unsigned", "double precision unsigned", "real unsigned"), "double"),
    (("decimal unsigned", "dec unsigned", "numeric unsigned"), "double"),
    (("money", "smallmoney", "binary_float", "binary_double"), "double"),
    (("bit", "bool", "boolean"), "boolean"),
)
DEFAULT_IMPORT_TYPE = "string"

# Warehouse types that pass through to a database unchanged;
# every other type becomes the default.
EXPORT_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")
DEFAULT_EXPORT_TYPE = "varchar(255)"

_NOISE = r"\([^)]*\)|\s+(identity|zerofill|auto_increment)\b"
_EXACT = r"(?i)(?:decimal|dec|numeric|number)\s*\(\s*(\d+)\s*(?:,\s*(-?\d+)\s*)?\).*"


def _type_name(source_type: str) -> str:
    return re.sub(r"\s+", " ", re.sub(_NOISE, "", source_type.lower())).strip()


def import_type(source_type: str, exact_decimals: bool = False, db_type: str = "") -> str:
    """Warehouse type of one source type, e.g. from a column listing.

    SQL Server's ``tinyint`` runs from 0 to 255 and is widened like an
    unsigned one. ``exact_decimals`` keeps precision and scale instead of
    going to double.
    """
    name = _type_name(source_type)
    if db_type.lower() == "sqlserver" and name == "tinyint":
        name = "tinyint unsigned"
    if exact_decimals:
        exact = re.fullmatch(_EXACT, source_type.strip())
        if exact and int(exact[1]) <= 38:
            return f"decimal({exact[1]},{max(int(exact[2] or 0), 0)})"
        if name in ("money", "smallmoney"):
            return "decimal(19,4)"
    return next((kind for names, kind in IMPORT_TYPES if name in names), DEFAULT_IMPORT_TYPE)


def type_name(source_type: str | Column) -> Column:
    """Source type in lower case, without length and column attributes."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(source_type), _NOISE, ""), r"\s+", " "))


def map_types_import(
    name: str | Column, db_type: str = "", exact_decimals: bool = False, source_type: str | Column | None = None
) -> Column:
    """Warehouse type of a :func:`type_name`, for whole column catalogues.

    Column form of :func:`import_type`. Put the name in a column of its own
    first; it is compared with every rule. ``exact_decimals`` needs the
    ``source_type`` with its precision as well.
    """
    name = F.col(name) if isinstance(name, str) else name
    rules = [(name.isin(*names), F.lit(kind)) for names, kind in IMPORT_TYPES]
    if db_type.lower() == "sqlserver":
        rules.insert(0, (name == "tinyint", F.lit(import_type("tinyint", db_type=db_type))))
    if exact_decimals:
        told = F.trim(F.col(source_type) if isinstance(source_type, str) else source_type)
        pattern = rf"^{_EXACT}$"
        precision = F.regexp_extract(told, pattern, 1).try_cast("int")
        scale = F.greatest(F.coalesce(F.regexp_extract(told, pattern, 2).try_cast("int"), F.lit(0)), F.lit(0))
        kept = F.concat(F.lit("decimal("), precision, F.lit(","), scale, F.lit(")"))
        rules[:0] = [
            (F.coalesce(precision <= 38, F.lit(False)), kept),
            (name.isin("money", "smallmoney"), F.lit(import_type("money", exact_decimals=True))),
        ]
    chain = F.when(*rules[0])
    for rule in rules[1:]:
        chain = chain.when(*rule)
    return chain.otherwise(F.lit(DEFAULT_IMPORT_TYPE))


def export_type(warehouse_type: str, default: str = DEFAULT_EXPORT_TYPE) -> str:
    """Database type of one warehouse type."""
    return warehouse_type if warehouse_type in EXPORT_TYPES else default


def map_types_export(warehouse_type: str | Column, default: str = DEFAULT_EXPORT_TYPE) -> Column:
    """Column form of :func:`export_type`."""
    warehouse_type = F.col(warehouse_type) if isinstance(warehouse_type, str) else warehouse_type
    return F.when(warehouse_type.isin(*EXPORT_TYPES), warehouse_type).otherwise(F.lit(default))


def base_type(column: str | Column) -> Column:
    """Type name without its length or precision."""
    return F.substring_index(column, "(", 1)


def parse_overrides(text: str | None) -> dict[str, str]:
    """``a=string,b=decimal(10,2)`` into a dict with lower-case names."""
    pairs = re.findall(r"([^=,\s]+)\s*=\s*([^=,(]+(?:\([^)]*\))?)", text or "")
    return {name.lower(): kind.strip() for name, kind in pairs}


def cast_to(field: T.StructField, kind: str) -> Column:
    """Cast one column to a warehouse type; binary becomes hex text."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BinaryType) and kind == "string":
        return F.lower(F.hex(column)).alias(field.name)
    return column.cast(kind).alias(field.name)


def wanted_types(
    columns: Iterable[tuple[str, str]],
    overrides: dict[str, str] | None = None,
    exact_decimals: bool = False,
    db_type: str = "",
) -> list[tuple[str, str]]:
    """Warehouse types of described columns, overrides first: decided once for DDL, rows and comparison."""
    overrides = overrides or {}
    return [(n, overrides.get(n.lower()) or import_type(t, exact_decimals, db_type)) for n, t in columns]


def cast_columns(df: DataFrame, wanted: Iterable[tuple[str, str]]) -> DataFrame:
    """Cast the columns to types decided elsewhere, matched by name; the order stays."""
    kinds = {name.lower(): kind for name, kind in wanted}
    return df.select(*[cast_to(f, kinds[f.name.lower()]) for f in df.schema.fields])


def described(df: DataFrame) -> list[tuple[str, str]]:
    """Columns of a DataFrame as a source describes them; long whole numbers are no approximate decimals."""
    return [
        (f.name, "bigint unsigned" if f.dataType == T.DecimalType(20, 0) else f.dataType.simpleString())
        for f in df.schema.fields
    ]


def normalize_types(df: DataFrame, overrides: dict[str, str] | None = None, exact_decimals: bool = False) -> DataFrame:
    """Cast every column to its warehouse type, overrides first.

    Dates and times become strings whose text order is their time order.
    """
    return cast_columns(df, wanted_types(described(df), overrides, exact_decimals))


def override_column_types(df: DataFrame, overrides: dict[str, str]) -> DataFrame:
    """Cast only the named columns; the others keep their type and place."""
    kinds = {name.lower(): kind for name, kind in overrides.items()}
    return df.select(
        *[
            cast_to(f, kinds[f.name.lower()]) if f.name.lower() in kinds else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
