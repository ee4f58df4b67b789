"""Bounded training samples of labelled documents, and fitting inside one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id belongs to none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, bound: int) -> DataFrame:
    """At most ``bound`` documents with a label outside the held-out fold: doc_id, text, label.

    The labelled ids are taken in the order of a hash, so they are a sample of
    all sources and languages. Repeated labels count as their largest, null
    labels and ids and labels of absent documents do not count.
    """
    known = labels.select(F.col("doc_id"), F.col(f"`{label}`").cast("int").alias("label")).dropna()
    known = known.where(fold(F.col("doc_id"), parts) != held_out).groupBy("doc_id").agg(F.max("label").alias("label"))
    present = docs.select("doc_id").distinct()
    chosen = known.join(present, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``bound`` ids and labels
    return texts.groupBy("doc_id", "label").agg(F.max("text").alias("text")).select("doc_id", "text", "label")


def fit(rows: DataFrame, train: Callable[[list[str], np.ndarray], bytes]) -> bytes:
    """Train on a bounded sample in one task of the cluster and fetch the model's bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(
            ((row["doc_id"], row["text"] or "", row["label"]) for batch in batches for row in batch.to_pylist()),
            key=lambda row: (row[0], row[1]),
        )
        model = train([text for _, text, _ in found], np.asarray([label for *_, label in found], np.int64))
        yield pa.RecordBatch.from_pydict({"model": pa.array([model], pa.binary())})

    row = rows.repartition(1).mapInArrow(work, "model binary").first()
    return bytes(row["model"]) if row else train([], np.zeros(0, np.int64))
