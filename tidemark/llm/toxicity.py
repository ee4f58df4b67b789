"""Toxicity by averaged subword embeddings under a linear softmax.

A word is the bag of its character n-grams and of itself, so an unseen
spelling shares most vectors with known ones. The vectors of a passage's words
are averaged and scored by a linear softmax; embeddings and softmax are trained
together. A text is read in passages of equal size, and its score is that of
its most toxic passage, so a few words do not drown in a long text. A passage's
average counts each distinct word once, and what it lacks to a full passage of
distinct words as zero vectors: one word repeated does not speak for all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from .batches import extend, texts_of
from .training import fit, fold, labelled_rows
from .words import run_hashes

BUCKETS = 1 << 17
GRAMS = (3, 4, 5)
DIMENSIONS = 8
# Words in a passage.
PASSAGE = 8
# Bound on the labelled rows that training reads, and on the passages of one of them that enter it.
SAMPLE = 8000
PASSAGES = 256
ROUNDS = 8
RATE = 0.3
THRESHOLD = 0.3
# Folds by crc32 of the id, and the one whose labels are never learned.
FOLDS, HELD_OUT = 4, 2
# Words whose score a worker remembers; the results do not depend on it.
REMEMBERED = 300_000
_BLOCK = 1 << 20
_WORD = re.compile(r"\w+")


def words_of(text: str) -> Iterator[list[str]]:
    """Lower-case words, in blocks that are cut at white space."""
    at = 0
    while at < len(text):
        end = at + _BLOCK
        if end < len(text):
            gap = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            end = gap if gap > at else end
        yield _WORD.findall(text[at:end].lower())
        at = end


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word's n-grams and of the word itself, and where each word's buckets begin."""
    marked = [f"<{word}>" for word in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    starts, stops, owners = [begins], [ends], [np.arange(len(words))]
    for n in GRAMS:
        at = np.arange(len(codes))
        at = at[at + n <= ends[owner]]
        starts.append(at)
        stops.append(at + n)
        owners.append(owner[at])
    of = np.concatenate(owners)
    order = np.argsort(of, kind="stable")
    hashes = run_hashes(codes, np.concatenate(starts), np.concatenate(stops))
    buckets = (hashes % np.uint64(BUCKETS)).astype(np.int64)[order]
    counts = np.bincount(of, minlength=len(words))
    return buckets, np.cumsum(counts) - counts


@dataclass
class Passages:
    """Passages of texts as distinct words; a word's buckets stand once in the vocabulary's table."""

    word: np.ndarray
    begin: np.ndarray
    text: np.ndarray
    bucket: np.ndarray
    first: np.ndarray
    grams: np.ndarray


def passages_of(texts: list[str], most: int) -> Passages:
    """Passages of the texts; of a text with more than ``most``, evenly spread ones."""
    vocabulary: dict[str, int] = {}
    numbers, sizes, owners = [], [], []
    for k, text in enumerate(texts):
        own = [vocabulary.setdefault(word, len(vocabulary)) for block in words_of(text) for word in block]
        cuts = range(0, len(own), PASSAGE)
        if len(cuts) > most:
            cuts = [cuts[i] for i in np.linspace(0, len(cuts) - 1, most).astype(int)]
        for at in cuts:
            part = set(own[at : at + PASSAGE])
            numbers.append(np.fromiter(sorted(part), np.int32, len(part)))
            sizes.append(len(part))
            owners.append(k)
    ends = np.cumsum(sizes, dtype=np.int64)
    buckets, counts, known = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], list(vocabulary)
    for at in range(0, len(known), 1 << 15):
        bucket, first = subwords(known[at : at + (1 << 15)])
        buckets.append(bucket.astype(np.int32))
        counts.append(np.diff(np.append(first, len(bucket))))
    bucket, grams = np.concatenate(buckets), np.concatenate(counts)
    first = np.cumsum(grams) - grams
    word = np.concatenate(numbers) if numbers else np.zeros(0, np.int32)
    return Passages(word, ends - np.asarray(sizes, np.int64), np.asarray(owners, np.int64), bucket, first, grams)


def _ranges(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All indices of the given ranges, and where each range begins among them."""
    ends = np.cumsum(size)
    return np.arange(ends[-1]) + np.repeat(begin - (ends - size), size), ends - size


@dataclass
class Model:
    """Trained scorer; since the softmax is linear, a bucket's vector folds into one number."""

    fold: np.ndarray
    bias: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        bucket, begin = subwords(words)
        return np.add.reduceat(self.fold[bucket], begin) / np.diff(np.append(begin, len(bucket)))

    def to_bytes(self) -> bytes:
        return np.append(self.fold, self.bias).astype("<f8").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Model:
        values = np.frombuffer(raw, "<f8")
        return cls(values[:-1], float(values[-1]))


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model:
    """Fit embeddings and softmax by Adagrad, after two rounds on each text's most toxic passage.

    A clean text's worst passage is clean, a toxic text's worst one is toxic, so
    these are the passages whose label is known.
    """
    data = passages_of(texts, PASSAGES)
    prior = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-3, 1 - 1e-3))
    start = float(np.log(prior / (1 - prior)))
    if not len(data.begin) or len(set(labels.tolist())) < 2:
        return Model(np.zeros(BUCKETS), start)
    rng = np.random.default_rng(seed)
    vectors = (rng.random((BUCKETS, DIMENSIONS), np.float32) - 0.5) / DIMENSIONS
    softmax = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.array([0.0, start], np.float32)
    seen_v, seen_s, seen_b = (np.full(shape, 1e-6, np.float32) for shape in (BUCKETS, softmax.shape, 2))
    size = np.diff(np.append(data.begin, len(data.word)))

    def scores() -> np.ndarray:
        fold = vectors @ (softmax[:, 1] - softmax[:, 0])
        word = np.add.reduceat(fold[data.bucket], data.first) / data.grams
        return np.add.reduceat(word[data.word], data.begin)

    for round_ in range(ROUNDS):
        if round_ < 2:  # every passage, with its text's label
            chosen = np.arange(len(data.begin))
        else:
            order = np.lexsort((-scores(), data.text))
            worst = order[np.append(True, np.diff(data.text[order]) > 0)]
            clean = np.flatnonzero(labels[data.text] == 0)
            chosen = np.union1d(worst, rng.choice(clean, min(len(clean), len(worst)), replace=False))
        chosen = rng.permutation(chosen)
        for at in range(0, len(chosen), 64):
            part = chosen[at : at + 64]
            pick, begin = _ranges(data.begin[part], size[part])
            words, inverse = np.unique(data.word[pick], return_inverse=True)
            grams = data.grams[words]
            pick, first = _ranges(data.first[words], grams)
            bucket = data.bucket[pick]
            of_word = np.add.reduceat(vectors[bucket], first) / grams[:, None]
            hidden = np.add.reduceat(of_word[inverse], begin) / PASSAGE
            score = hidden @ softmax + bias
            chance = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -60, 60)))
            error = (chance - labels[data.text[part]]).astype(np.float32)
            error = np.stack([-error, error], 1)
            down = np.repeat(error @ softmax.T / PASSAGE, size[part], axis=0)
            to_word = np.stack([np.bincount(inverse, down[:, d], len(words)) for d in range(DIMENSIONS)], 1) / grams[:, None]
            used, inverse = np.unique(bucket, return_inverse=True)
            down = np.repeat(to_word, grams, axis=0)
            step = np.stack([np.bincount(inverse, down[:, d], len(used)) for d in range(DIMENSIONS)], 1).astype(np.float32)
            to_softmax, to_bias = hidden.T @ error, error.sum(0)
            seen_v[used] += (step**2).mean(1)
            seen_s += to_softmax**2
            seen_b += to_bias**2
            vectors[used] -= RATE * step / np.sqrt(seen_v[used])[:, None]
            softmax -= RATE * to_softmax / np.sqrt(seen_s)
            bias -= 0.1 * RATE * to_bias / np.sqrt(seen_b)
    return Model((vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


class Scorer:
    """Scores texts; remembers the scores of words."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def score(self, text: str) -> float:
        """Probability of the most toxic passage; an empty text has the score of an empty passage."""
        known, worst, rest = self.known, None, []
        for words in words_of(text):
            missing = list({word for word in words if word not in known})
            if missing:
                if len(known) + len(missing) > REMEMBERED:
                    known.clear()
                    missing = list({*words, *rest})
                known.update(zip(missing, self.model.word_scores(missing).tolist(), strict=True))
            rest += words
            full = len(rest) // PASSAGE * PASSAGE
            for at in range(0, full, PASSAGE):
                total = sum([known[word] for word in set(rest[at : at + PASSAGE])])
                worst = total if worst is None else max(worst, total)
            rest = rest[full:]
        if rest:
            total = sum([known[word] for word in set(rest)])
            worst = total if worst is None else max(worst, total)
        worst = (worst or 0.0) / PASSAGE
        return float(1 / (1 + np.exp(-np.clip(worst + self.model.bias, -60, 60))))


def _trained(texts: list[str], labels: np.ndarray) -> bytes:
    return train(texts, labels).to_bytes()


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> bytes:
    """Model trained on at most ``SAMPLE`` documents labelled ``toxic`` whose fold is not held out.

    Without documents of both labels the model tells every text the same score.
    """
    return fit(labelled_rows(docs, labels, "toxic", FOLDS, HELD_OUT, SAMPLE), _trained)


def score_toxicity(docs: DataFrame, model: bytes, text: str = "text", score: str = "score") -> DataFrame:
    """The rows of ``docs`` with ``score``, from 0 to 1; a column of that name is replaced.

    Only the text enters the score. Null and empty texts have the score of an
    empty passage; repeated rows score alike. One pass over whole texts, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scorers: list[Scorer] = []

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if not scorers:
            scorers.append(Scorer(Model.from_bytes(shared.value)))
        return [pa.array([scorers[0].score(value) for value in texts_of(batch, text)], pa.float64())]

    return extend(docs, [StructField(score, DoubleType())], compute)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document's label was kept from training; a null id was never trained on, but is no test row."""
    return F.coalesce(fold(F.col(doc_id), FOLDS) == HELD_OUT, F.lit(False))
