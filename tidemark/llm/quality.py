"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

Three streams of words are hashed to n-grams of one and two (shapes also
three): the words themselves, their shapes (runs of capitals, small letters,
digits and single marks), and whether a word repeats one of the two before it.
A feature's value is the root of its share of its stream, so every stream of
every text has length one whatever the text's size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from .batches import extend, texts_of
from .training import fit, fold, labelled_rows
from .words import PIECE, mix, run_hashes, word_bounds

BUCKETS = 1 << 18
# Bound on the labelled rows that training reads.
SAMPLE = 8000
EPOCHS = 4
# FTRL-proximal: learning rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.05, 0.5
THRESHOLD = 0.3
# Folds by crc32 of the id, and the one whose labels are never learned.
FOLDS, HELD_OUT = 5, 0

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a") : ord("z") + 1] = ord("x")
_SHAPE[ord("A") : ord("Z") + 1] = ord("X")
_SHAPE[ord("0") : ord("9") + 1] = ord("9")
_SHAPE[0x80:] = ord("x")


def _streams(raw: bytes) -> list[np.ndarray]:
    """Hashes of the n-grams of each stream of a piece of text."""
    data = np.frombuffer(raw, np.uint8)
    starts, ends = word_bounds(data)
    if not len(starts):
        return [np.zeros(0, np.uint64)] * 3
    words = run_hashes(data, starts, ends)
    shape = _SHAPE[data]
    keep = np.append(True, shape[1:] != shape[:-1])
    keep[starts] = True
    at = np.cumsum(keep) - keep
    shapes = run_hashes(shape[keep], at[starts], at[ends - 1] + keep[ends - 1])
    repeats = np.zeros(len(words), np.uint64)
    repeats[1:] += words[1:] == words[:-1]
    repeats[2:] += np.uint64(2) * (words[2:] == words[:-2])
    with np.errstate(over="ignore"):
        two = mix(words[:-1] * np.uint64(3) + words[1:])
        shape_two = mix(shapes[:-1] * np.uint64(5) + shapes[1:])
        shape_three = mix(shape_two[:-1] * np.uint64(7) + shapes[2:])
        repeat = mix(repeats + np.uint64(11))
        repeat_two = mix(repeats[:-1] * np.uint64(13) + repeats[1:] + np.uint64(17))
    return [np.concatenate([words, two]), np.concatenate([shapes, shape_two, shape_three]), np.concatenate([repeat, repeat_two])]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their values; long texts are read in pieces cut at white space."""
    raw = text.encode("utf-8", "surrogatepass")
    counted: list[list[tuple[np.ndarray, np.ndarray]]] = [[], [], []]
    at = 0
    while at < len(raw):
        end = len(raw)
        if end - at > PIECE:
            end = max(raw.rfind(b" ", at, at + PIECE), raw.rfind(b"\n", at, at + PIECE)) + 1
            end = end if end > at else at + PIECE
        for stream, hashes in zip(counted, _streams(raw[at:end]), strict=True):
            stream.append(np.unique((hashes % np.uint64(BUCKETS)).astype(np.int64), return_counts=True))
        at = end
    buckets, values = [np.zeros(0, np.int64)], [np.zeros(0)]
    for stream in counted:
        if len(stream) > 1:
            every, inverse = np.unique(np.concatenate([b for b, _ in stream]), return_inverse=True)
            stream = [(every, np.bincount(inverse, np.concatenate([c for _, c in stream])))]
        if stream:
            bucket, count = stream[0]
            buckets.append(bucket)
            values.append(np.sqrt(count / max(1, count.sum())))
    return np.concatenate(buckets), np.concatenate(values)


@dataclass
class Model:
    """Weights of the buckets; few are not zero."""

    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        bucket, value = features(text)
        return float(1 / (1 + np.exp(-np.clip(self.weights[bucket] @ value + self.bias, -60, 60))))

    def to_bytes(self) -> bytes:
        return np.append(self.weights, self.bias).astype("<f4").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Model:
        values = np.frombuffer(raw, "<f4").astype(np.float64)
        return cls(values[:-1], float(values[-1]))


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model:
    """Follow the regularised leader over the texts in a shuffled order, several times."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        lead = z[at]
        return np.where(
            np.abs(lead) <= L1, 0.0, -(lead - np.sign(lead) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        )

    rows = []
    for text in texts:
        bucket, value = features(text)
        rows.append((np.append(bucket, BUCKETS).astype(np.int32), np.append(value, 1.0).astype(np.float32)))
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            at, value = rows[k]
            w = weights(at)
            error = 1 / (1 + np.exp(-np.clip(w @ value, -60, 60))) - labels[k]
            gradient = error * value
            rate = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / ALPHA
            # A bucket may stand in two streams of one text.
            np.add.at(z, at, gradient - rate * w)
            np.add.at(n, at, gradient**2)
    every = weights(np.arange(BUCKETS + 1))
    return Model(every[:-1], float(every[-1]))


def _trained(texts: list[str], labels: np.ndarray) -> bytes:
    return train(texts, labels).to_bytes()


def fit_quality(docs: DataFrame, labels: DataFrame) -> bytes:
    """Model trained on at most ``SAMPLE`` documents labelled ``quality`` whose fold is not held out.

    Without any the model tells every text 0.5.
    """
    return fit(labelled_rows(docs, labels, "quality", FOLDS, HELD_OUT, SAMPLE), _trained)


def score_quality(docs: DataFrame, model: bytes, text: str = "text", score: str = "score") -> DataFrame:
    """The rows of ``docs`` with ``score``, from 0 to 1; a column of that name is replaced.

    Only the text enters the score. Null and empty texts have the score of the
    bias alone; repeated rows score alike. One pass over whole texts, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    models: list[Model] = []

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if not models:
            models.append(Model.from_bytes(shared.value))
        return [pa.array([models[0].score(value) for value in texts_of(batch, text)], pa.float64())]

    return extend(docs, [StructField(score, DoubleType())], compute)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document's label was kept from training; a null id was never trained on, but is no test row."""
    return F.coalesce(fold(F.col(doc_id), FOLDS) == HELD_OUT, F.lit(False))
