"""Lempel-Ziv phrase fingerprints.

A text is parsed into the phrases of an incremental dictionary: each phrase is
the longest known one plus one code point. The set of phrases, hashed, is kept
as a minimum-hash signature, so the share of equal components estimates the
Jaccard similarity of two phrase sets, which follows how well one text's
dictionary compresses the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import pick
from .words import mix, run_hashes

COMPONENTS = 64
# Phrases after which the dictionary starts anew, as compressors do, whatever the text was cut into; bounds a worker's memory.
DICTIONARY = 2_000_000
BLOCK = 1 << 16

_SEED = np.arange(1, COMPONENTS + 1, dtype=np.uint64)
_FACTORS = mix(_SEED * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_SHIFTS = mix(_SEED * np.uint64(0xD1B54A32D192ED03))
_NONE = np.full(COMPONENTS, np.iinfo(np.uint64).max, np.uint64)


class Parse:
    """State of the dictionary while a text is read; can be forked between two characters."""

    def __init__(self, text: str = ""):
        self.known: set[str] = set()
        self.pending = ""
        self.least = _NONE
        self.read(text)

    def fork(self) -> Parse:
        other = Parse()
        other.known, other.pending, other.least = self.known.copy(), self.pending, self.least
        return other

    def read(self, text: str) -> Parse:
        """Go on with more text."""
        for at in range(0, len(text), BLOCK):
            known, phrase, fresh = self.known, self.pending, []
            add, keep = known.add, fresh.append
            for char in text[at : at + BLOCK]:
                phrase += char
                if phrase not in known:
                    add(phrase)
                    keep(phrase)
                    phrase = ""
                    if len(known) >= DICTIONARY:
                        self.known = known = set()
                        add = known.add
            self.pending = phrase
            if fresh:
                self.least = np.minimum(self.least, signature(phrase_hashes(fresh)))
        return self

    def fingerprint(self) -> np.ndarray:
        """Upper halves of the minima; a text without phrases has the largest value everywhere."""
        return (self.least >> np.uint64(32)).astype(np.uint32)


def phrase_hashes(phrases: list[str]) -> np.ndarray:
    """A 64-bit hash of each phrase."""
    ends = np.cumsum(np.fromiter(map(len, phrases), np.int64, len(phrases)))
    return run_hashes(code_points("".join(phrases)), np.concatenate([[0], ends[:-1]]), ends)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minimum of every component's hash function over ``hashes``."""
    least = _NONE
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 4096):
            part = hashes[None, at : at + 4096] * _FACTORS[:, None] + _SHIFTS[:, None]
            least = np.minimum(least, part.min(axis=1))
    return least


def code_points(text: str) -> np.ndarray:
    """The text's code points."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def to_text(fingerprint: np.ndarray) -> str:
    """Eight hex digits for each component."""
    return fingerprint.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal components."""
    return float((a == b).mean())


def edited_text(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the beginning of ``following`` as there is."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class _Row:
    """One document: parsed, with the state at the point where its edit begins."""

    def __init__(self, doc_id: int | None, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        cut = len(self.text) - len(self.text) // 2
        parse = Parse(self.text[:cut])
        self.middle = parse.fork()
        self.print = parse.read(self.text[cut:]).fingerprint()

    def compare(self, following: _Row) -> tuple:
        """The row's result beside its following document."""
        half = len(self.text) // 2
        edited = self.middle.read(following.text[:half]).fingerprint()
        digest = hashlib.sha256(edited_text(self.text, following.text).encode("utf-8", "surrogatepass")).hexdigest()
        return (
            self.doc_id, len(self.text), digest, to_text(self.print), to_text(edited),
            likeness(self.print, edited), likeness(self.print, following.print),
        )


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by part and falling id; a part's last row is the first one of the next part."""
    before: tuple[int, _Row] | None = None
    for batch in batches:
        out = []
        for part, trailer, doc_id, text in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
            if trailer and (before is None or before[0] != part):
                continue  # a repeated trailer
            row = _Row(doc_id, text)
            if before and before[0] == part:
                out.append(before[1].compare(row))
            before = None if trailer else (part, row)
        columns = zip(*out, strict=True) if out else [[]] * len(_ARROW)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def fingerprint_chain(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Fingerprint every text and compare it with its edit and with the following document.

    The following document is the next one by falling id, the first one after
    the last; equal ids follow each other by text, null ids come last. Null text
    counts as empty; a text without phrases is like another such text (1.0) and
    unlike any other (0.0). Columns other than the two named are ignored; an
    empty table gives no rows.

    One shuffle of the texts: ids are cut into parts at percentiles, a part's
    first document is also sent to the end of the part before, and each part is
    read in order. Only the cuts and each part's largest id reach the driver.
    """
    spark = docs.sparkSession
    rows = pick(docs, id_column, text).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)] or [0.5], 10 * parts)).first()[0]
    bounds = np.unique(np.asarray(cuts or [], np.int64))

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        found = len(bounds) - np.searchsorted(bounds, ids.where(known, 0).astype("int64"), "left")
        return pd.Series(np.where(known, found, len(bounds) + 1)).astype("int32")

    rows = rows.withColumn("part", part_of("doc_id"))
    firsts = rows.groupBy("part").agg(F.max("doc_id").alias("first_id")).orderBy("part").collect()
    if not firsts:
        return spark.createDataFrame([], RESULT)
    before = {row.part: firsts[k - 1].part for k, row in enumerate(firsts)}
    heads = spark.createDataFrame(
        [(row.part, row.first_id, before[row.part]) for row in firsts], "part int, first_id long, part_before int"
    )
    heads = F.broadcast(heads)  # one row for each part, and there are as many parts as shuffle partitions
    sent = rows.join(heads, "part").select(
        "doc_id",
        "text",
        F.explode(
            F.when(
                F.col("doc_id").eqNullSafe(F.col("first_id")),
                F.array(
                    F.struct("part", F.lit(False).alias("trailer")),
                    F.struct(F.col("part_before").alias("part"), F.lit(True).alias("trailer")),
                ),
            ).otherwise(F.array(F.struct("part", F.lit(False).alias("trailer"))))
        ).alias("to"),
    )
    ordered = (
        sent.select("to.part", "to.trailer", "doc_id", "text")
        .repartitionByRange(parts, "part")
        .sortWithinPartitions("part", "trailer", F.desc_nulls_last("doc_id"), "text")
    )
    return ordered.mapInArrow(_walk, RESULT)
