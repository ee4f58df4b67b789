"""From raw documents to packed training bins, one stage after another.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet in the shared folder and reads it again for the next one.
All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import quality, toxicity
from tidemark.llm.batches import pick, table, unused
from tidemark.llm.jaccard_join import jaccard_join
from tidemark.llm.packing import pack_documents, sized_documents
from tidemark.llm.secrets import redact_secrets
from tidemark.session import remove_folder, scratch_folder

# Near duplicates share four fifths of their five-word shingles.
PERCENT, WIDTH = 80, 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold; the scorer is trained on this input's labels.

    Null and empty texts are scored like others, texts of any length whole;
    repeated rows fare alike; all columns come back, whatever their names.
    """
    score = unused(docs, "score")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, score=score)
    return pick(scored.where(F.col(score) < toxicity.THRESHOLD), *docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality reaches the threshold; the classifier is trained on this input's labels.

    Null and empty texts are scored like others, texts of any length whole;
    repeated rows fare alike; all columns come back, whatever their names.
    """
    score = unused(docs, "score")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, model, score=score)
    return pick(scored.where(F.col(score) >= quality.THRESHOLD), *docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every group of near duplicates.

    Texts without words are in no group. Repeated rows leave one; rows with a
    null id stay unless they are linked with a document that has one, or equal.
    The texts are shuffled once: rows of one id lie together, and repeated ones
    are told there.
    """
    groups = jaccard_join(docs, PERCENT, WIDTH)
    known, lacks = unused(docs, "known_id"), unused(docs, "lacks_id")
    keys = {known: F.coalesce(F.col("doc_id"), F.lit(0)), lacks: F.col("doc_id").isNull()}
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).withColumns(keys).select(known, lacks).distinct()
    return docs.withColumns(keys).join(kept, [known, lacks], "left_semi").dropDuplicates([known, lacks, "text"]).select(
        *[F.col(f"`{name}`") for name in docs.columns]
    )


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark; null texts and those without a secret come back as they are."""
    return redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A bin for every document, repeated rows each; a text longer than a bin is cut into pieces. No documents, no rows."""
    return pack_documents(sized_documents(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact),
    ("packing", pack),
]

# Trained models and packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents`` and return the last one's rows; a stage's folder goes when the next is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    folder = scratch_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
