"""Tables stored so that joins need no shuffle of them, hot keys being split all the same.

Bucketing by the join key alone would put a hot key into one bucket. Rows get a
salt beside the key, from the columns that tell them apart, and are bucketed
and sorted by both. The small side is repeated once for each salt; it alone
travels to the buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import quoted
from ..sinks.tables import ctas_replace
from .projections import project_dim_first
from .routing import ATTRIBUTES, union_all

SALT = "key_salt"
# Parts of a hot key: it takes so many tasks at most.
SALTS = 16


def store_salted(
    df: DataFrame, table: str, key: str, spread: Sequence[str], buckets: int | None = None, salts: int = SALTS
) -> None:
    """Store rows bucketed and sorted by ``key`` and a salt from the columns ``spread``.

    At least as many buckets as shuffle partitions, else Spark would rather
    shuffle both sides of a join. The number of salts is kept in the table's properties.
    """
    spark = df.sparkSession
    if SALT in {c.lower() for c in df.columns}:
        raise ValueError(f"{SALT} is the name of the layout's own column")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread]), F.lit(salts)).cast("int")
    ctas_replace(df.withColumn(SALT, salt), table, bucket_by=[key, SALT], buckets=max(least, buckets or 0))
    spark.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ('salts' = '{salts}')")


def salts_of(spark: SparkSession, table: str) -> int:
    """Number of salts of a stored table."""
    return int(spark.sql(f"SHOW TBLPROPERTIES {quoted(table)} ('salts')").first()["value"])


def salted(dimension: DataFrame, salts: int) -> DataFrame:
    """Every row once for each salt."""
    return dimension.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def enrich_stored(spark: SparkSession, table: str, dimension: DataFrame, key: str = "orgid") -> DataFrame:
    """As ``enrich_dim`` on a stored table, which is not shuffled however large the dimension is."""
    rows = spark.table(table)
    clinics = salted(dimension, salts_of(spark, table)).select(F.col("clinic_id").alias(key), SALT, *ATTRIBUTES)
    clinics = clinics.withColumn(key, F.col(key).cast(rows.schema[key].dataType))
    joined = rows.join(clinics, [key, SALT])
    return project_dim_first(joined, ATTRIBUTES, [c for c in rows.columns if c != SALT])


def merge_stored(spark: SparkSession, old_table: str, new_table: str, dimension: DataFrame, key: str = "orgid") -> DataFrame:
    """As ``merge_routed`` on two stored tables: each lineage meets the clinics that are on its system, in its buckets."""
    moved = F.col("pmsweb_id").isNotNull()
    old = enrich_stored(spark, old_table, dimension.where(~moved), key)
    new = enrich_stored(spark, new_table, dimension.where(moved), key)
    return union_all(old, new)
