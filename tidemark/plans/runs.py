"""Current tables that are merged on reading.

A current table is stored as runs. Every refresh adds one: the latest row per
key of the increment and the latest delete per key, sorted by key, and reads
nothing of the table. Reading merges the runs. Runs that hold about as many
rows as one another are merged into one, so there are few at any time, and a
row is written again only as often as its run grows by ``FAN``.

A run is named by the first and the last refresh that it covers. It says the
same however often it is read, so a run that is still there beside the merged
one changes nothing: no step has to be undone when a program ends between two
of them. One program writes a table at a time; readers need no lock.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import quoted
from ..operators.dedup import latest_per_key, latest_tombstone, stamp_etl_time, tombstone_join
from ..sinks.tables import WAREHOUSE_FORMAT
from ..sources.tables import table_exists

FIRST, LAST = "first_run", "last_run"
DELETED, DELETED_AT = "run_deletes", "run_deleted_at"
HELPERS = (DELETED, DELETED_AT, FIRST, LAST)
# Runs of like size that are merged into one.
FAN = 4


@dataclass(frozen=True)
class RunRule:
    """How rows of a table's runs are merged; kept in its properties."""

    keys: tuple[str, ...]
    stamp: str
    tie_break: tuple[str, ...] | None = None

    @classmethod
    def of(cls, spark: SparkSession, table: str) -> RunRule:
        held = json.loads(spark.sql(f"SHOW TBLPROPERTIES {quoted(table)} ('runs')").first()["value"])
        ties = held["tie_break"]
        return cls(tuple(held["keys"]), held["stamp"], None if ties is None else tuple(ties))


@dataclass(frozen=True, order=True)
class Run:
    """A run by the refreshes it covers."""

    first: int
    last: int

    def covers(self, other: Run) -> bool:
        return self != other and self.first <= other.first and other.last <= self.last


def create_runs(
    spark: SparkSession, table: str, like: DataFrame, keys: Sequence[str], stamp: str, tie_break: Sequence[str] | None = None
) -> None:
    """Create an empty table of runs for rows such as those of ``like``."""
    taken = {c.lower() for c in like.columns} & set(HELPERS)
    if taken:
        raise ValueError(f"{table}: {sorted(taken)} are names of the runs' own columns")
    rule = RunRule(tuple(keys), stamp, None if tie_break is None else tuple(tie_break))
    kinds = [*like.dtypes, (DELETED, "boolean"), (DELETED_AT, dict(like.dtypes)[stamp]), (FIRST, "bigint"), (LAST, "bigint")]
    body = ", ".join(f"`{name}` {kind}" for name, kind in kinds)
    told = json.dumps(asdict(rule)).replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {quoted(table)} ({body}) USING {WAREHOUSE_FORMAT} PARTITIONED BY ({FIRST}, {LAST})"
        f" TBLPROPERTIES ('runs' = '{told}')"
    )


def stored_runs(spark: SparkSession, table: str) -> list[Run]:
    """Runs whose folders are registered, from the catalogue alone."""
    named = [dict(part.split("=") for part in row[0].split("/")) for row in spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()]
    return sorted(Run(int(p[FIRST]), int(p[LAST])) for p in named)


def live_runs(runs: Sequence[Run]) -> list[Run]:
    """Runs that no other one covers, oldest first."""
    return sorted(r for r in runs if not any(other.covers(r) for other in runs))


def run_to_merge(sizes: Sequence[int], fan: int = FAN) -> int:
    """Index of the oldest run to merge with all later ones; the number of runs if none is due.

    A run's tier is its size's order of magnitude to the base ``fan``. A merge is
    due when ``fan`` runs of the highest tier among the merged have come together.
    """
    tiers = [_tier(size, fan) for size in sizes]
    due = len(tiers)
    for at in range(len(tiers) - 1, -1, -1):
        top = max(tiers[at:])
        if tiers[at:].count(top) >= fan:
            due = at
    return due


def _tier(size: int, fan: int) -> int:
    tier = 0
    while size >= fan:
        size //= fan
        tier += 1
    return tier


def _rows_of(df: DataFrame) -> DataFrame:
    return df.where(~F.col(DELETED)).drop(*HELPERS)


def _deletes_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return latest_tombstone(df.where(DELETED), None, keys, DELETED_AT)


def _alive(df: DataFrame, rule: RunRule) -> DataFrame:
    latest = latest_per_key(_rows_of(df), rule.keys, rule.stamp, rule.tie_break)
    return tombstone_join(latest, _deletes_of(df, rule.keys), rule.keys, rule.stamp, rule.keys)


def _written(spark: SparkSession, table: str, rows: DataFrame, deletes: DataFrame, rule: RunRule, run: Run) -> None:
    """Write one run; ranges of keys lie in files of their own, sorted. Rows that are there twice change nothing."""
    stored = spark.table(table)
    columns = [f for f in stored.schema.fields if f.name not in (FIRST, LAST)]
    marks = deletes.where(F.col("p_updatestamp").isNotNull())
    for key in rule.keys:
        marks = marks.where(F.col(key).isNotNull())
    parts = []
    for part, own in (
        (rows, {DELETED: F.lit(False)}),
        (marks, {DELETED: F.lit(True), DELETED_AT: F.col("p_updatestamp")}),
    ):
        part = part.withColumns(own)
        there = {c.lower() for c in part.columns}
        parts.append(part.select(*[
            (F.col(f"`{f.name}`") if f.name.lower() in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in columns
        ]))
    placed = parts[0].unionByName(parts[1])
    placed = placed.repartitionByRange(*rule.keys).sortWithinPartitions(*rule.keys)
    spark.sql(
        f"INSERT INTO TABLE {quoted(table)} PARTITION ({FIRST} = {run.first}, {LAST} = {run.last}) SELECT * FROM {{rows}}",
        rows=placed,
    )


def add_run(
    spark: SparkSession,
    table: str,
    increment: DataFrame,
    new_tombstones: DataFrame | None = None,
    tombstone_keys: Sequence[str] = ("p_id", "p_orgid"),
    tombstone_name: str | None = None,
    fan: int = FAN,
) -> Run | None:
    """Apply an increment and new deletes; returns the run, None if there was nothing to apply.

    What is written is in proportion to the increment. Afterwards runs are
    merged where that is due. Folders that a merge made needless go at the next
    call, so a reader of the time before has until then.
    """
    rule = RunRule.of(spark, table)
    expire_runs(spark, table)
    if new_tombstones is None or new_tombstones.isEmpty():
        new_tombstones = None
        if increment.isEmpty():
            return None
    latest = latest_per_key(increment, rule.keys, rule.stamp, rule.tie_break)
    if new_tombstones is None:
        deletes = latest.select(*rule.keys, F.col(rule.stamp).alias("p_updatestamp")).limit(0)
    else:
        deletes = latest_tombstone(new_tombstones, tombstone_name, tombstone_keys)
        renamed = [F.col(old).alias(new) for old, new in zip(tombstone_keys, rule.keys, strict=True)]
        deletes = deletes.select(*renamed, "p_updatestamp")
    number = max((r.last for r in stored_runs(spark, table)), default=0) + 1
    run = Run(number, number)
    _written(spark, table, latest, deletes, rule, run)
    merge_runs(spark, table, fan)
    return run


def live_rows(spark: SparkSession, table: str) -> DataFrame:
    """Rows and deletes of the live runs; other folders are not read."""
    live = live_runs(stored_runs(spark, table))
    if not live:
        return spark.table(table).limit(0)
    here = F.lit(False)
    for run in live:
        here |= (F.col(FIRST) == run.first) & (F.col(LAST) == run.last)
    return spark.table(table).where(here)


def current_rows(spark: SparkSession, table: str, etl_time: Column | None = None) -> DataFrame:
    """The current table: the latest row per key of all runs, without rows that a delete covers.

    The same as a rebuild from the whole log, as long as the log only grows and
    deletes are not withdrawn.
    """
    return stamp_etl_time(_alive(live_rows(spark, table), RunRule.of(spark, table)), etl_time)


def run_sizes(spark: SparkSession, table: str) -> dict[Run, int]:
    """Rows and deletes of each live run; no column is read, only the files' own counts."""
    counted = live_rows(spark, table).groupBy(FIRST, LAST).count().collect()
    return {Run(row[FIRST], row[LAST]): row["count"] for row in counted}


def merge_runs(spark: SparkSession, table: str, fan: int = FAN) -> Run | None:
    """Merge the newest runs into one if that is due; returns it.

    Rows that a delete among them covers go, for a delete outlives every row it
    covers. Deletes stay, since rows older than one may still come.
    """
    live, sizes = live_runs(stored_runs(spark, table)), run_sizes(spark, table)
    at = run_to_merge([sizes.get(run, 0) for run in live], fan)
    if at == len(live):
        return None
    rule = RunRule.of(spark, table)
    merged = Run(live[at].first, live[-1].last)
    some = live_rows(spark, table).where(F.col(FIRST) >= merged.first)
    _written(spark, table, _alive(some, rule), _deletes_of(some, rule.keys), rule, merged)
    return merged


def expire_runs(spark: SparkSession, table: str) -> list[Run]:
    """Drop the folders of runs that another one covers; returns them."""
    runs = stored_runs(spark, table)
    gone = [run for run in runs if run not in live_runs(runs)]
    for run in gone:
        spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS PARTITION ({FIRST} = {run.first}, {LAST} = {run.last})")
    return gone


def refresh_runs(
    spark: SparkSession,
    table: str,
    increment: DataFrame,
    new_tombstones: DataFrame | None,
    keys: Sequence[str],
    stamp: str,
    tie_break: Sequence[str] | None = None,
    tombstone_name: str | None = None,
) -> DataFrame:
    """Create the table of runs if missing, add a run, and return the current rows."""
    if not table_exists(spark, table):
        create_runs(spark, table, increment, keys, stamp, tie_break)
    add_run(spark, table, increment, new_tombstones, tombstone_name=tombstone_name)
    return current_rows(spark, table)
