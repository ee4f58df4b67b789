"""Table sync and consolidation on Spark DataFrames.

Import relational tables into a layered warehouse, keep the latest row per
key, drop deleted rows, merge two lineages through a routing dimension and
export the result, with the registry, run ledger and schema drift held as
ordinary tables.
"""
