"""Alignment of two column lists by their longest common subsequence.

A comparison by position calls every column after an inserted one drift. Here
columns that both sides have in the same order are kept, and only the others
are changes. Names are unique within a table, so the longest common subsequence
is the longest run of matched columns whose places rise on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEPT, MOVED, INSERTED, REMOVED = "kept", "moved", "inserted", "removed"


def _better(chain: Column, other: Column) -> Column:
    """Whether a chain is longer than another, or as long with earlier columns."""
    return (F.size(chain) > F.size(other)) | ((F.size(chain) == F.size(other)) & (chain < other))


def rising_chain(pairs: Column) -> Column:
    """The longest run of pairs ``s, t`` in order of ``s`` whose ``t`` rise, as an array of ``s``; of equal ones the first.

    For every pair the best chain that ends there is held; the next pair
    continues the best of those that end lower. Quadratic in a table's columns.
    """
    none = F.array().cast("array<int>")

    def best(held: Column) -> Column:
        return F.aggregate(held, none, lambda chain, x: F.when(_better(x["chain"], chain), x["chain"]).otherwise(chain))

    def step(held: Column, pair: Column) -> Column:
        lower = F.filter(held, lambda x: x["t"] < pair["t"])
        ended = F.named_struct(F.lit("t"), pair["t"], F.lit("chain"), F.concat(best(lower), F.array(pair["s"])))
        return F.concat(held, F.array(ended))

    empty = F.array().cast("array<struct<t: int, chain: array<int>>>")
    return best(F.aggregate(F.array_sort(pairs), empty, step))


def schema_alignment(source: DataFrame, target: DataFrame) -> DataFrame:
    """table_name, name, source_ordinal, target_ordinal, change for every column of either side.

    ``change`` is kept, moved (both sides have it, at another place among the
    kept ones), inserted (source only) or removed (target only). Names match in
    any case; ``name`` is the source's where it has one. A table that one side
    lacks has only inserted or only removed columns. Of a name that occurs twice
    in a table the first place counts for both.
    """
    left, right = (
        side.groupBy("table_name", F.lower("name").alias("key")).agg(
            F.min("ordinal").alias(f"{mark}_ordinal"), F.min_by("name", "ordinal").alias(f"{mark}_name")
        )
        for side, mark in ((source, "source"), (target, "target"))
    )
    met = left.join(right, ["table_name", "key"], "full")
    both = F.col("source_ordinal").isNotNull() & F.col("target_ordinal").isNotNull()
    pair = F.when(both, F.struct(F.col("source_ordinal").cast("int").alias("s"), F.col("target_ordinal").cast("int").alias("t")))
    column = F.struct(F.coalesce("source_name", "target_name").alias("name"), "source_ordinal", "target_ordinal")
    tables = met.groupBy("table_name").agg(F.collect_list(pair).alias("pairs"), F.collect_list(column).alias("columns"))
    chained = tables.select("table_name", F.explode("columns").alias("c"), rising_chain(F.col("pairs")).alias("chain"))
    change = (
        F.when(F.col("c.target_ordinal").isNull(), INSERTED)
        .when(F.col("c.source_ordinal").isNull(), REMOVED)
        .when(F.array_contains("chain", F.col("c.source_ordinal")), KEPT)
        .otherwise(MOVED)
    )
    return chained.select("table_name", "c.name", "c.source_ordinal", "c.target_ordinal", change.alias("change"))


def alignment_report(alignment: DataFrame) -> DataFrame:
    """Numbers of inserted, removed and moved columns for each table that has any."""
    counts = alignment.groupBy("table_name").agg(*[
        F.count_if(F.col("change") == change).alias(change) for change in (INSERTED, REMOVED, MOVED)
    ])
    return counts.where(F.col(INSERTED) + F.col(REMOVED) + F.col(MOVED) > 0)
