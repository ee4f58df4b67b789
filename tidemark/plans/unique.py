"""From change log to current table: which rule applies, and applying it."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import relayer, split_name
from ..functions.text import is_blank
from ..operators.dedup import latest_per_key, latest_tombstone, stamp_etl_time, tombstone_join

# Names, keys and stamps of the source systems.
WAREHOUSE = "pet_medical"
TOMBSTONE_TABLE = "warm_deleted"
PMS_SYSTEMS = "_pms_|_pmsweb_"
PMS_FULL_COPY = "operationlogdetail"
PMS_KEYS = (("sysicd10", ("icdcode",)),)
PMS_DEFAULT_KEY = ("id",)
PMS_STAMPS = (("pcustomers|ppets|operationlog", "updatetimestamp"),)
PMS_DEFAULT_STAMP = "updatestamp"
HIS_SYSTEMS = "_his_"
HIS_KEY = ("id",)
HIS_STAMP = "update_time"
FRANCHISE_SYSTEMS = "_chongdun_|_lianchong_|_yichong_|_xunde_|_vetbuddy_"
FRANCHISE_FULL_COPY = "clinic_payment_book"
FRANCHISE_KEYS = (
    ("crm_customer", ("cus_logicid",)),
    ("crm_pet", ("pet_logicid",)),
    ("clinic_case_regonly", ("regid",)),
    ("clinic_paymentdetails_book", ("id", "paymentid")),
)
FRANCHISE_DEFAULT_KEY = ("id",)
FRANCHISE_STAMP = "updatetime"
ORGANISATION = "orgid"


@dataclass(frozen=True)
class UniqueRule:
    """How a source table becomes its current table.

    ``strategy`` is ``skip``, ``tombstones``, ``latest`` or ``snapshot``.
    """

    strategy: str
    keys: tuple[str, ...] = ()
    stamp: str = ""
    tombstone_table: str = ""
    tombstone_name: str = ""


def unique_dispatch(table: str, incremental: bool, warehouse: str = WAREHOUSE) -> UniqueRule:
    """Choose the rule for ``<warehouse>.src_<system>_<table>`` by its name."""
    database, name = split_name(table)
    if TOMBSTONE_TABLE in name:
        return UniqueRule("skip")
    if database != warehouse or not name.startswith("src_"):
        raise ValueError(f"{table!r} is not a {warehouse}.src_ table")
    if incremental and _has(PMS_SYSTEMS, name) and not _has(PMS_FULL_COPY, name):
        system = "pms" if name.startswith("src_pms_") else "pmsweb"
        return UniqueRule(
            "tombstones",
            (*_pick(PMS_KEYS, name, PMS_DEFAULT_KEY), ORGANISATION),
            _pick(PMS_STAMPS, name, PMS_DEFAULT_STAMP),
            tombstone_table=f"{database}.src_{system}_{TOMBSTONE_TABLE}",
            tombstone_name=name.removeprefix(f"src_{system}_"),
        )
    if incremental and _has(HIS_SYSTEMS, name):
        return UniqueRule("latest", (*HIS_KEY, ORGANISATION), HIS_STAMP)
    if _has(FRANCHISE_SYSTEMS, name) and FRANCHISE_FULL_COPY not in name:
        keys = _pick(FRANCHISE_KEYS, name, FRANCHISE_DEFAULT_KEY)
        return UniqueRule("latest", (*keys, ORGANISATION), FRANCHISE_STAMP)
    return UniqueRule("snapshot")


def is_incremental(filter_text: str | Column = "filter", max_value: str | Column = "max_value") -> Column:
    """True where a registry row holds both a filter and a high-water mark."""
    return ~is_blank(filter_text) & ~is_blank(max_value)


def unique_incremental(
    rows: DataFrame,
    tombstones: DataFrame,
    keys: Sequence[str],
    stamp: str,
    tombstone_name: str | None = None,
    tie_break: Sequence[str] | None = None,
    etl_time: Column | None = None,
) -> DataFrame:
    """Latest row per key, without rows that a delete covers.

    The join runs on the keys the ranking is already partitioned and sorted
    by, so the log is shuffled once.
    """
    latest = latest_per_key(rows, keys, stamp, tie_break)
    alive = tombstone_join(latest, latest_tombstone(tombstones, tombstone_name), keys, stamp)
    return stamp_etl_time(alive, etl_time)


def unique_latest(
    rows: DataFrame,
    keys: Sequence[str],
    stamp: str,
    tie_break: Sequence[str] | None = None,
    etl_time: Column | None = None,
) -> DataFrame:
    """Latest row per key."""
    return stamp_etl_time(latest_per_key(rows, keys, stamp, tie_break), etl_time)


def unique_snapshot(
    rows: DataFrame, partition_key: str | None = None, day: str | None = None, etl_time: Column | None = None
) -> DataFrame:
    """The table as it is, or one partition of it."""
    if partition_key:
        rows = rows.where(F.col(partition_key) == day)
    return stamp_etl_time(rows, etl_time)


def unique_table(
    rows: DataFrame,
    rule: UniqueRule,
    tombstones: DataFrame | None = None,
    partition_key: str | None = None,
    day: str | None = None,
    etl_time: Column | None = None,
) -> DataFrame | None:
    """Apply a rule; None when the table is to be skipped."""
    if rule.strategy == "skip":
        return None
    if rule.strategy == "tombstones":
        if tombstones is None:
            raise ValueError(f"{rule.tombstone_table} is needed to drop deleted rows")
        return unique_incremental(rows, tombstones, rule.keys, rule.stamp, rule.tombstone_name, etl_time=etl_time)
    if rule.strategy == "latest":
        return unique_latest(rows, rule.keys, rule.stamp, etl_time=etl_time)
    return unique_snapshot(rows, partition_key, day, etl_time)


def current_name(table: str) -> str:
    """Name of the current table of a source table."""
    return relayer(table, "src_", "ods_")


def _has(pattern: str, name: str) -> bool:
    return re.search(pattern, name, re.IGNORECASE) is not None


def _pick(rules, name, default):
    return next((value for pattern, value in rules if _has(pattern, name)), default)
