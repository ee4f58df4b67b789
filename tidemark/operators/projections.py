"""Column selections used between layers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame


def project_fixed_order(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exactly these columns, in this order."""
    return df.select(*[f"`{n}`" for n in names])


def project_listed(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The listed columns in the order of the source, whatever their case."""
    wanted = {n.strip().lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() in wanted])


def project_except(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """All columns but these; names that are not there are ignored."""
    return df.drop(*names)


def common_columns(left: Sequence[str], right: Sequence[str]) -> list[str]:
    """Names on both sides, as spelled and ordered on the left."""
    there = {c.lower() for c in right}
    return [c for c in left if c.lower() in there]


def project_common(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides cut to their shared columns, in the order of the left."""
    names = common_columns(left.columns, right.columns)
    if not names:
        raise ValueError("the two tables share no column")
    spelled = {c.lower(): c for c in right.columns}
    return (
        left.select(*[f"`{c}`" for c in names]),
        right.selectExpr(*[f"`{spelled[c.lower()]}` AS `{c}`" for c in names]),
    )


def project_dim_first(df: DataFrame, leading: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Dimension attributes ahead of the fact columns."""
    return df.select(*leading, *[f"`{c}`" for c in columns])
