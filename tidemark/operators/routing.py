"""Merge of two lineages of a table, routed by a clinic dimension.

The dimension holds ``clinic_id, pmsweb_id, brand_code, clinic_name``; a clinic
with a ``pmsweb_id`` has moved to the new system. No join here is hinted: Spark
broadcasts the dimension while its measured size is under the threshold and
sort-merges beyond it, splitting hot clinics by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .projections import project_common, project_dim_first

DIMENSION = ("clinic_id", "pmsweb_id", "brand_code", "clinic_name")
ATTRIBUTES = ("brand_code", "clinic_name")


def routing_dimension(df: DataFrame) -> DataFrame:
    """Cut a table to the routing columns and refuse repeated clinics.

    A repeated ``clinic_id`` would repeat every row of that clinic. Do this
    once per dimension and share the result among the merges.
    """
    dimension = df.select(*DIMENSION).where(F.col("clinic_id").isNotNull())
    repeated = dimension.groupBy("clinic_id").count().where("count > 1").limit(3).collect()
    if repeated:
        raise ValueError(f"clinic_id is not unique in the dimension, e.g. {[r['clinic_id'] for r in repeated]}")
    return dimension


def route_not_migrated(df: DataFrame, dimension: DataFrame, key: str = "orgid") -> DataFrame:
    """Rows of clinics that have not moved, or that the dimension lacks."""
    return df.join(_migrated(dimension), F.col(key) == F.col("_moved"), "left_anti")


def route_migrated(df: DataFrame, dimension: DataFrame, key: str = "orgid") -> DataFrame:
    """Rows of clinics that have moved."""
    return df.join(_migrated(dimension), F.col(key) == F.col("_moved"), "left_semi")


def enrich_dim(df: DataFrame, dimension: DataFrame, key: str = "orgid") -> DataFrame:
    """Put brand and clinic name first; rows of unknown clinics go."""
    clinics = dimension.select(F.col("clinic_id").alias("_clinic"), *ATTRIBUTES)
    joined = df.join(clinics, F.col(key) == F.col("_clinic"), "inner")
    return project_dim_first(joined, ATTRIBUTES, df.columns)


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Stack two tables on their shared columns, in the order of the left.

    Numeric types widen; any other pair of different types becomes string.
    """
    left, right = project_common(left, right)
    kinds = {f.name: f.dataType for f in right.schema.fields}
    clash = [f.name for f in left.schema.fields if not _compatible(f.dataType, kinds[f.name])]
    to_text = {c: F.col(f"`{c}`").cast("string") for c in clash}
    return left.withColumns(to_text).unionByName(right.withColumns(to_text))


def merge_middle(old: DataFrame, new: DataFrame, dimension: DataFrame, key: str = "orgid") -> DataFrame:
    """Each clinic's rows from the system it is on; unknown clinics from the old."""
    return union_all(route_not_migrated(old, dimension, key), route_migrated(new, dimension, key))


def merge_routed(old: DataFrame, new: DataFrame, dimension: DataFrame, key: str = "orgid") -> DataFrame:
    """Merged and enriched table in one pass over one join.

    Equal to ``enrich_dim(merge_middle(...))``: the enrichment drops unknown
    clinics anyway, so the route can be read from the dimension row that the
    enrichment needs, as a second key of the same join.
    """
    both = union_all(old.withColumn("_new", F.lit(False)), new.withColumn("_new", F.lit(True)))
    clinics = dimension.select(
        F.col("clinic_id").alias("_clinic"), F.col("pmsweb_id").isNotNull().alias("_moved"), *ATTRIBUTES
    )
    joined = both.join(clinics, [F.col(key) == F.col("_clinic"), F.col("_new") == F.col("_moved")], "inner")
    return project_dim_first(joined, ATTRIBUTES, [c for c in both.columns if c != "_new"])


def _migrated(dimension: DataFrame) -> DataFrame:
    return dimension.where(F.col("pmsweb_id").isNotNull()).select(F.col("clinic_id").alias("_moved"))


def _compatible(left: T.DataType, right: T.DataType) -> bool:
    return left == right or (isinstance(left, T.NumericType) and isinstance(right, T.NumericType))
