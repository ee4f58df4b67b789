"""Query registration and access to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL twin."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def given(spark: SparkSession, sf_dir: str, *names: str):
    """The given tables by name."""
    frames = [spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names]
    return frames[0] if len(frames) == 1 else frames
