"""One registered query for each operator, with production parameters, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality, toxicity
from .batches import table
from .centroids import assign, centroid_sql, fit_centroids
from .embedding_dedup import near_duplicates
from .fingerprints import fingerprint_chain
from .html_extract import extract_text
from .jaccard_join import jaccard_join
from .licenses import license_sql, scan_licenses
from .packing import clustered_documents, pack_documents
from .pieces import decode_ids, encode_texts
from .repeats import remove_repeats, repeats_sql
from .secrets import scan_secrets
from .whitening import fit_whitening, whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _classified(scored: DataFrame, held_out: Column, threshold: float) -> DataFrame:
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


@_query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages)


@_query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share nine tenths of their three-word shingles."""
    return jaccard_join(table(spark, sf_dir, "documents"))


@_query
def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@_query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score_quality(docs.select("doc_id", "text"), quality.fit_quality(docs, labels))
    return _classified(scored, quality.held_out(), quality.THRESHOLD)


@_query
def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@_query
def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices and texts in every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))


SQL["op6_license_scans"] = license_sql()


@_query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text they decode to, as digests."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_texts(table(spark, sf_dir, "documents"), model)
    decoded = decode_ids(encoded, model)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).alias("n_bytes"),
    )


@_query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, of its edit, and their likeness."""
    return fingerprint_chain(table(spark, sf_dir, "documents"))


@_query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), toxicity.fit_toxicity(docs, labels))
    return _classified(scored, toxicity.held_out(), toxicity.THRESHOLD)


@_query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in a bin, near copies in different ones."""
    return pack_documents(clustered_documents(table(spark, sf_dir, "documents")))


@_query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after ten rounds, with distances and inertias."""
    vectors = table(spark, sf_dir, "embeddings")
    return assign(vectors, fit_centroids(vectors))


SQL["op11_centroid_clustering"] = centroid_sql()


@_query
def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 50 bytes or more that earlier documents have."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


SQL["op12_suffix_array_dedup"] = repeats_sql()


@_query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every vector, a row each."""
    vectors = table(spark, sf_dir, "embeddings")
    found = whiten(vectors, fit_whitening(vectors))
    rows = found.select(
        "vec_id", "n", F.expr("try_cast(deviation AS long)").alias("deviation"), "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "of"),
    )
    return rows.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
        "of.whitened", "of.explained", "identity_error",
    )
