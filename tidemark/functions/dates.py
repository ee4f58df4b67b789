"""Day stamps in the ``yyyyMMdd`` form used by partitions and backups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "yyyyMMdd"


def yesterday(day: str | Column | None = None) -> Column:
    """``yyyyMMdd`` of the day before ``day`` (today when not given)."""
    return F.date_format(F.date_sub(F.current_date() if day is None else day, 1), DAY_FORMAT)


def parse_date(column: str | Column) -> Column:
    """Timestamp of a strict ``yyyyMMdd`` string, NULL when it is no date."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column.rlike(r"\A\d{8}\z"), F.try_to_timestamp(column, F.lit(DAY_FORMAT)))


def day_string(day: dt.date, back: int = 0) -> str:
    """``yyyyMMdd`` of a driver-side date, ``back`` days earlier."""
    return (day - dt.timedelta(days=back)).strftime("%Y%m%d")


def partition_value(value: str | None, day: dt.date) -> str | None:
    """Resolve the registry's ``$yesterday`` marker; other values stay."""
    return day_string(day, back=1) if value == "$yesterday" else value
