"""Run a function on Arrow batches and append its columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Rows handled at a time: Python objects of few texts live at once, however large the Arrow batch.
TEXT_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that no extra column can clash with an internal one."""
    return df.select(*[F.col(f"`{name}`") for name in names])


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of the DataFrame is called so, in any case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def extend(
    df: DataFrame, fields: Sequence[StructField], compute: Callable[[pa.RecordBatch], Sequence[pa.Array]]
) -> DataFrame:
    """Append ``fields`` as computed per batch; columns of the same name, in any case, are replaced.

    No shuffle: every task maps its own rows, batch by batch.
    """
    new = {field.name.lower() for field in fields}
    base = pick(df, *[name for name in df.columns if name.lower() not in new])
    schema = StructType([*base.schema.fields, *fields])
    names = [field.name for field in schema.fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXT_ROWS):
                part = batch.slice(at, TEXT_ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns, *compute(part)], names=names)

    return base.mapInArrow(work, schema)


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """The strings of a column; null counts as empty."""
    return [text or "" for text in batch.column(name).to_pylist()]
