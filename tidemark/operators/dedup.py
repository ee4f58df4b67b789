"""Latest row per key and removal of deleted rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "rank_tmp"


def latest_per_key(df: DataFrame, keys: Sequence[str], stamp: str, tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one with the highest stamp, NULL stamps last.

    Rows with NULL keys form groups of their own. Spark turns the rank filter
    into a group limit ahead of the shuffle, so each map task sends at most one
    row per key and a hot key never gathers in one place. Ties fall to
    ``tie_break`` (descending), else to a hash of the row, so that a rerun
    task picks the same row again; an empty list leaves ties open.
    """
    order = [F.col(stamp).desc_nulls_last()]
    if tie_break is None:
        order.append(_row_hash(df).desc())
    else:
        order += [F.col(c).desc_nulls_last() for c in tie_break]
    window = Window.partitionBy(*keys).orderBy(*order)
    return filter_rank_first(df.withColumn(RANK, F.row_number().over(window)))


def filter_rank_first(df: DataFrame) -> DataFrame:
    """Keep rank one and drop the helper column."""
    return df.where(F.col(RANK) == 1).drop(RANK)


def latest_tombstone(
    log: DataFrame, table_name: str | None = None, keys: Sequence[str] = ("p_id", "p_orgid"), stamp: str = "updatestamp"
) -> DataFrame:
    """Highest delete stamp per key, for one table of the log if named.

    Only the stamp is wanted, so this is a plain maximum, combined on the map
    side. A key whose deletes all lack a stamp keeps NULL.
    """
    if table_name is not None:
        log = log.where(F.lower("tablename") == table_name.lower())
    return log.groupBy(*keys).agg(F.max(stamp).alias("p_updatestamp"))


def tombstone_join(
    rows: DataFrame,
    tombstones: DataFrame,
    keys: Sequence[str],
    stamp: str,
    tombstone_keys: Sequence[str] = ("p_id", "p_orgid"),
    tombstone_stamp: str = "p_updatestamp",
) -> DataFrame:
    """Drop the rows that a delete covers.

    A row stays if its key has no dated delete or its stamp is newer than the
    delete. A NULL stamp is not newer, an equal one is not either. NULL keys
    match no delete. ``tombstones`` holds one row per key.
    """
    dead = tombstones.where(F.col(tombstone_stamp).isNotNull()).select(
        *[F.col(k).alias(f"_dead_{i}") for i, k in enumerate(tombstone_keys)],
        F.col(tombstone_stamp).alias("_dead_stamp"),
    )
    same_key = [F.col(k) == F.col(f"_dead_{i}") for i, k in enumerate(keys)]
    covered = ~filter_newer_than_delete(F.col(stamp), F.col("_dead_stamp"))
    return rows.join(dead, [*same_key, covered], "left_anti")


def filter_newer_than_delete(stamp: Column, delete_stamp: Column) -> Column:
    """True when a row outlives the delete; never NULL."""
    return delete_stamp.isNull() | F.coalesce(stamp > delete_stamp, F.lit(False))


def stamp_etl_time(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Add the load time as ``etl_time``."""
    return df.withColumn("etl_time", F.current_timestamp() if at is None else at)


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])
