"""Current tables that are brought up to date in place.

A current table is stored in hash buckets of its key. An increment and its
deletes touch only the buckets of their keys; the others are neither read nor
written. The result equals a rebuild from the whole log as long as the log only
grows and deletes are not withdrawn.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import quoted
from ..session import ensure_checkpoint_dir
from ..sinks.tables import WAREHOUSE_FORMAT, drop_partition, overwrite_partitions
from .unique import unique_incremental

BUCKET = "key_bucket"
BUCKETS = 256


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a key; keys of log and deletes are compared as text."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def build_current(
    rows: DataFrame,
    tombstones: DataFrame,
    table: str,
    keys: Sequence[str],
    stamp: str,
    buckets: int = BUCKETS,
    tie_break: Sequence[str] | None = None,
    etl_time: Column | None = None,
) -> None:
    """Create the bucketed current table from the whole log.

    The number of buckets is kept in the table's properties.
    """
    current = unique_incremental(rows, tombstones, keys, stamp, tie_break=tie_break, etl_time=etl_time)
    placed = current.withColumn(BUCKET, key_bucket(keys, buckets)).hint("rebalance", BUCKET)
    placed.write.format(WAREHOUSE_FORMAT).partitionBy(BUCKET).saveAsTable(table)
    rows.sparkSession.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ('buckets' = '{buckets}')")


def buckets_of(spark: SparkSession, table: str) -> int:
    """Number of buckets of a current table."""
    return int(spark.sql(f"SHOW TBLPROPERTIES {quoted(table)} ('buckets')").first()["value"])


def touched_buckets(
    increment: DataFrame, new_tombstones: DataFrame, keys: Sequence[str], tombstone_keys: Sequence[str], buckets: int
) -> list[int]:
    """Buckets that hold a key of the increment or of a new delete; at most as many numbers as there are buckets."""
    found = increment.select(key_bucket(keys, buckets).alias(BUCKET)).unionAll(
        new_tombstones.select(key_bucket(tombstone_keys, buckets).alias(BUCKET))
    )
    return sorted(row[BUCKET] for row in found.distinct().collect())


def refreshed(
    current: DataFrame,
    increment: DataFrame,
    tombstones: DataFrame,
    touched: Sequence[int],
    keys: Sequence[str],
    stamp: str,
    buckets: int,
    tie_break: Sequence[str] | None = None,
    etl_time: Column | None = None,
    tombstone_keys: Sequence[str] = ("p_id", "p_orgid"),
) -> DataFrame:
    """New content of the touched buckets.

    All deletes of those buckets take part, old ones too, for a late row may be
    older than a delete that is known already.
    """
    kept = current.where(F.col(BUCKET).isin(*touched)).select(*increment.columns)
    dead = tombstones.where(key_bucket(tombstone_keys, buckets).isin(*touched))
    alive = unique_incremental(kept.unionByName(increment), dead, keys, stamp, tie_break=tie_break, etl_time=etl_time)
    return alive.withColumn(BUCKET, key_bucket(keys, buckets))


def refresh_current(
    spark: SparkSession,
    table: str,
    increment: DataFrame,
    tombstones: DataFrame,
    new_tombstones: DataFrame,
    keys: Sequence[str],
    stamp: str,
    tie_break: Sequence[str] | None = None,
    etl_time: Column | None = None,
    tombstone_keys: Sequence[str] = ("p_id", "p_orgid"),
) -> list[int]:
    """Apply an increment and new deletes to a current table; returns the buckets written.

    ``tombstones`` is the whole log of deletes, the new ones included. The new
    content is fixed by a checkpoint before the buckets it was read from are
    replaced. A bucket that has lost all rows is dropped.
    """
    ensure_checkpoint_dir(spark)
    buckets = buckets_of(spark, table)
    touched = touched_buckets(increment, new_tombstones, keys, tombstone_keys, buckets)
    if not touched:
        return []
    current = spark.table(table)
    fresh = refreshed(
        current, increment, tombstones, touched, keys, stamp, buckets, tie_break, etl_time, tombstone_keys
    ).checkpoint()
    filled = {row[BUCKET] for row in fresh.select(BUCKET).distinct().collect()}
    overwrite_partitions(fresh, table, BUCKET)
    for bucket in touched:
        if bucket not in filled:
            drop_partition(spark, table, BUCKET, str(bucket))
    return touched
