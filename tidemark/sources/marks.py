"""High-water marks that lose no late row: a stamp, a key, and a window of rows that were seen.

A plain mark takes what is newer than the newest stamp. A row that is committed
later with that stamp, or a little older one, is lost; with ``>=`` the rows of
that stamp come twice. Here a load goes back to the mark less an overlap, and
leaves out what the target already holds of that window.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEEN, SEEN_NO = "seen_times", "seen_no"
_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


@dataclass(frozen=True)
class Mark:
    """Where a load has come to: the newest stamp, the highest key at it, and where the next load begins."""

    stamp: object
    key: tuple
    low: object

    def fill(self, template: str) -> str:
        """Put the mark into a filter such as ``at >= '{low_value}'``; ``{max_value}`` is the stamp, ``{max_key}`` the first key."""
        key = self.key[0] if self.key else ""
        found = template.replace("{low_value}", str(self.low)).replace("{max_value}", str(self.stamp))
        return found.replace("{max_key}", str(key))


def parse_overlap(overlap: str | int | float) -> dt.timedelta | int | float:
    """``"90 minutes"`` as a time span, a number as it is."""
    if not isinstance(overlap, str):
        return overlap
    text = overlap.strip().lower()
    if re.fullmatch(r"\d+", text):
        return int(text)
    spans = re.fullmatch(r"(\d+)\s*(second|minute|hour|day)s?", text)
    if not spans:
        raise ValueError(f"overlap {overlap!r} is no number and no span of seconds, minutes, hours or days")
    return dt.timedelta(seconds=int(spans[1]) * _UNITS[spans[2]])


def low_end(stamp: Column, overlap: dt.timedelta | int | float) -> Column:
    """The stamp less the overlap, in the stamp's own type; a stamp stored as text stays text of the same length."""
    if not isinstance(overlap, dt.timedelta):
        return stamp - F.lit(overlap)
    seconds = int(overlap.total_seconds())
    moved = F.to_timestamp_ntz(stamp) - F.expr(f"INTERVAL '{seconds}' SECOND")
    text = F.date_format(moved, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.substring(text, F.lit(1), F.length(stamp.cast("string")))


def composite_mark(target: DataFrame, stamp: str, keys: Sequence[str] = (), overlap: str | int | float = 0) -> DataFrame:
    """One row: ``max_value``, ``max_key`` (a struct of the keys, null without keys) and ``low_value``.

    All are null for a target without stamps. One pass with partial maxima.
    """
    known = target.where(F.col(stamp).isNotNull())
    parts = [F.col(stamp).alias("stamp"), *[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)]]
    top = known.agg(F.max(F.struct(*parts)).alias("top"))
    span = parse_overlap(overlap)
    kind = dict(target.dtypes)[stamp]
    low = low_end(F.col("top.stamp"), span) if span else F.col("top.stamp")
    if isinstance(span, dt.timedelta) and kind != "string":
        low = F.col("top.stamp") - F.expr(f"INTERVAL '{int(span.total_seconds())}' SECOND")
    key = F.struct(*[F.col(f"top.key_{i}").alias(k) for i, k in enumerate(keys)]) if keys else F.lit(None).cast("string")
    return top.select(F.col("top.stamp").alias("max_value"), key.alias("max_key"), low.cast(kind).alias("low_value"))


def read_composite_mark(target: DataFrame, stamp: str, keys: Sequence[str] = (), overlap: str | int | float = 0) -> Mark | None:
    """The mark as a driver-side value; None for a target without stamps."""
    row = composite_mark(target, stamp, keys, overlap).first()
    if row is None or row["max_value"] is None:
        return None
    return Mark(row["max_value"], tuple(row["max_key"]) if keys else (), row["low_value"])


def unseen(rows: DataFrame, held: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows beyond those that ``held`` has, compared by columns, NULL being equal to NULL.

    Rows that occur several times count: if two are held and three come, one is
    new. The source is read once. Rows that are not held are spread by a hash,
    so a hot value among them is no hot task.
    """
    alike = [F.col(c).eqNullSafe(F.col(f"held_{i}")) for i, c in enumerate(by)]
    counts = held.groupBy(*by).agg(F.count(F.lit(1)).alias(SEEN))
    counts = counts.select(*[F.col(c).alias(f"held_{i}") for i, c in enumerate(by)], SEEN)
    met = rows.join(counts, alike, "left").drop(*[f"held_{i}" for i in range(len(by))])
    content = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    spread = F.when(F.col(SEEN).isNull(), content)
    numbered = met.withColumn(SEEN_NO, F.row_number().over(Window.partitionBy(*by, spread).orderBy(content)))
    return numbered.where(F.col(SEEN).isNull() | (F.col(SEEN_NO) > F.col(SEEN))).drop(SEEN, SEEN_NO)


def window_load(
    source: DataFrame,
    target: DataFrame,
    stamp: str,
    keys: Sequence[str],
    overlap: str | int | float = 0,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of the source that a target lacks, from its mark less the overlap on.

    A row is known by its stamp and keys, or by the columns ``by``. The mark is
    fetched first and becomes a literal, so the filter reaches both scans; of
    the target only the window is read. Rows without a stamp come with the
    first load only, and so do rows older than the window: an overlap must be
    as long as a row can be late.
    """
    mark = read_composite_mark(target, stamp, keys, overlap)
    if mark is None:
        return source
    columns = list(by) if by else [stamp, *[k for k in keys if k != stamp]]
    recent = F.col(stamp) >= F.lit(mark.low)
    return unseen(source.where(recent), target.where(recent).select(*columns), columns)
