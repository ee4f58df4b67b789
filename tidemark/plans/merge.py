"""Merge of old-system and new-system tables into the final database."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import relayer, split_name
from ..operators.routing import enrich_dim, merge_middle, merge_routed
from ..sinks.tables import ctas_replace

# Tables to merge, in their listed order, and the name classes
# that decide how. Large tables are listed last and run first.
MERGE_TABLES = (
    "PClientManagement", "PCustomers", "PPets", "SysPMSUsers", "SysRoles", "PSysList", "SysCategory", "SysSettings",
    "CMembersCard", "CMembersCardPayments", "CChargeHistories", "CPreChargeHistories",
    "CMyMoney", "CPayments", "CPaymentDetails",
    "CReg", "CEMRecord", "CPrescriptions", "CPrescriptionDetails", "CEMRecordPhysical", "CLabReport",
    "CLabVirusDetails", "PBCheckList", "PXRaysList", "PPathologyList", "PLabViursResults",
    "PReservation",
    "PMedicines", "PMedicineRelations", "Manufacturer", "PProvider", "Brand", "IInstoreRecipe", "IInstoreList",
    "IInstockCheckRecipea", "IInstockCheckList", "IInstockRecheckList", "PProductHistories", "T_OutStore",
)
OLD_ONLY = (
    "CEMRecord|CPrescriptions|CPrescriptionDetails|CPhysical|CEMRecordPhysical|CLabReport|CLabVirusDetails"
    "|PBCheckList|PXRaysList|PPathologyList"
)
NEW_ONLY = "SysCategory"
KEYED_BY_ID = "PClientManagement"
OLD_LAYER = "ods_pms_"
NEW_LAYER = "ods_pmsweb_"


def merge_dispatch(table: str) -> str:
    """Branch for a table: ``passthrough``, ``prefer_new``, ``routed_self`` or ``routed``."""
    for pattern, branch in ((OLD_ONLY, "passthrough"), (NEW_ONLY, "prefer_new"), (KEYED_BY_ID, "routed_self")):
        if re.search(pattern, table, re.IGNORECASE):
            return branch
    return "routed"


def merge_passthrough(old: DataFrame, new: DataFrame | None = None) -> DataFrame:
    """The old system's table, unchanged."""
    return old


def merge_prefer_new(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """The new system's table, unchanged."""
    return new


def merge_routed_self(old: DataFrame, new: DataFrame, dimension: DataFrame) -> DataFrame:
    """Routed merge of the clinic table itself, whose ``id`` is the clinic."""
    return merge_routed(old, new, dimension, key="id")


def merge_frames(branch: str, old: DataFrame | None, new: DataFrame | None, dimension: DataFrame | None) -> DataFrame:
    """Apply a branch to loaded tables."""
    if branch == "passthrough":
        return merge_passthrough(old)
    if branch == "prefer_new":
        return merge_prefer_new(old, new)
    if branch == "routed_self":
        return merge_routed_self(old, new, dimension)
    return merge_routed(old, new, dimension)


def merge_table(
    spark: SparkSession,
    old_name: str,
    dimension: DataFrame,
    final_database: str,
    keep_layers: bool = False,
) -> str:
    """Merge ``<db>.ods_pms_<t>`` with its new-system twin into ``<final>.<t>``.

    ``dimension`` comes from ``routing_dimension``. With ``keep_layers`` the
    middle table (which still holds unknown clinics) and the enriched table
    are stored as ``mid_<t>`` and ``mir_<t>``, and the final one reads the
    stored rows.
    """
    database, name = split_name(old_name)
    if not name.startswith(OLD_LAYER):
        raise ValueError(f"{old_name!r}: the table to merge must be an {OLD_LAYER} table")
    final = f"{final_database}.{name[len(OLD_LAYER):]}"
    branch = merge_dispatch(name)
    old = spark.table(old_name) if branch != "prefer_new" else None
    new = spark.table(relayer(old_name, OLD_LAYER, NEW_LAYER)) if branch != "passthrough" else None
    if keep_layers and branch.startswith("routed"):
        key = "id" if branch == "routed_self" else "orgid"
        middle, enriched = relayer(old_name, OLD_LAYER, "mid_"), relayer(old_name, OLD_LAYER, "mir_")
        ctas_replace(merge_middle(old, new, dimension, key), middle)
        ctas_replace(enrich_dim(spark.table(middle), dimension, key), enriched)
        merged = spark.table(enriched)
    else:
        merged = merge_frames(branch, old, new, dimension)
    ctas_replace(merged, final)
    return final
