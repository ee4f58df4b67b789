"""Consecutive numbers over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Low bits of monotonically_increasing_id that hold the row's place in its partition.
_PLACE_BITS = 33


def number_rows(df: DataFrame, order: list[Column], column: str = "no") -> DataFrame:
    """Number rows 1..n in the given order without gathering them in one task.

    Rows are range-partitioned and sorted, fixed by a checkpoint, then numbered
    as *rows in earlier partitions* + *place in own partition*. Only one row per
    partition takes part in the running total, which bounds the broadcast.
    ``order`` should end in a unique column, so equal keys spread as well.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ).checkpoint()
    placed = placed.select(
        *df.columns,
        F.shiftright("_at", _PLACE_BITS).alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_place"),
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.select(*df.columns, (F.col("_before") + F.col("_place") + 1).alias(column))
