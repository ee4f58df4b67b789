"""Passages that stand in earlier documents, found by prefix-free parsing.

Texts are packed into chunks of some megabytes, written once; a chunk's number
stands for its documents from then on. Every string of ``depth`` bytes has a
trigger: the smallest rolling hash of ``GRAM`` bytes within it. It depends on
the string alone, so equal strings have equal triggers. Neighbouring strings
of one trigger make a phrase, which overlaps the next one in ``depth - 1``
bytes.

1. Chunks tell their triggers; a trigger that only one document has ends here.
2. Phrases of the other triggers go to buckets of triggers. A bucket's distinct
   phrases are its dictionary; prefix-free parsing puts all their suffixes in
   order, equal strings come to lie together, and the smallest document of each
   is known.
3. Strings whose smallest document is smaller than their own go back to their
   chunk as spans.

Very common passages would bring all their neighbourhoods to one trigger. So a
gram that many documents have comes after all others: a string that is not
altogether common has a trigger that is not, and phrases of common triggers are
the same bytes everywhere. Of the same phrase in one chunk only the smallest
document's travels; in larger ones it is a repeat whatever else is found.

Hashes only choose where strings meet; that they are equal is decided on bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_folder

from .prefix_free import Corpus
from .words import _power_tables, mix

DEPTH = 50
GRAM = 20
# Bytes of text in a chunk, in a slice that is hashed at a time, and for each bucket.
CHUNK, SLICE, BUCKET = 4 << 20, 1 << 16, 1 << 20
# Bytes of distinct phrases whose suffixes are put in order at a time.
PORTION = 1 << 16
# Strings in a phrase at most: text that repeats itself has one trigger throughout.
LONGEST = 64
# A gram is common if it occurs once for so many documents, and the longest list of such grams that is sent to tasks.
COMMON, MOST_COMMON = 256, 1 << 20
# Times that a gram must occur in a chunk to be reported.
LEAST_COMMON = 8
# A null id counts as larger than every other.
NULL_ID = np.iinfo(np.int64).max

CHUNKS = "chunk long, n_bytes long, ids binary, nulls binary, sizes binary, text binary"
_CODEC = "zstd"


def _pack(*arrays: np.ndarray) -> bytes:
    raw = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.Codec(_CODEC).compress(raw, asbytes=True)


def _unpack(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.Codec(_CODEC).decompress(data[8:], decompressed_size=size, asbytes=True) if size else b""


def chunked(docs: DataFrame, id_column: str, text: str, chunk: int) -> DataFrame:
    """Whole documents packed into rows of about ``chunk`` bytes; a longer document is a row of its own."""
    rows = docs.select(F.col(f"`{id_column}`").cast("long"), F.col(f"`{text}`").cast("binary"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[bytes] = []
        held, made = 0, TaskContext.get().partitionId() << 32

        def row() -> pa.RecordBatch:
            known = np.array([NULL_ID if i is None else i for i in ids], np.int64)
            return pa.RecordBatch.from_pydict({
                "chunk": [made], "n_bytes": [held], "ids": [known.tobytes()],
                "nulls": [bytes(i is None for i in ids)],
                "sizes": [np.array([len(t) for t in texts], np.int64).tobytes()],
                "text": [_pack(np.frombuffer(b"".join(texts), np.uint8))],
            })

        for batch in batches:
            for doc_id, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                content = content.as_py() or b""
                if ids and held + len(content) > chunk:
                    yield row()
                    ids, texts, held, made = [], [], 0, made + 1
                ids.append(doc_id)
                texts.append(content)
                held += len(content)
        if ids:
            yield row()

    return rows.mapInArrow(work, CHUNKS)


class Chunk:
    """One row of the chunk table."""

    def __init__(self, row: dict):
        self.number = row["chunk"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.nulls = np.frombuffer(row["nulls"], bool)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.raw = _unpack(row["text"])
        self.text = np.frombuffer(self.raw, np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def runs(self, depth: int, common: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Trigger, first string, number of strings and document of every phrase."""
        places = range(0, max(len(self.text), 1), SLICE)
        parts = [_runs(self.text, self.starts, self.ends, at, depth, common) for at in places]
        return tuple(np.concatenate(columns) for columns in zip(*parts, strict=True))

    def common_grams(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Grams that occur for many of the chunk's documents, and how often.

        Looked for only in phrases of such triggers, since the smallest gram of
        a common string is its trigger.
        """
        trigger, start, count, _ = self.runs(depth, Grams(_NONE))
        _, code, times = np.unique(trigger, return_inverse=True, return_counts=True)
        least = max(LEAST_COMMON, len(self.ids) // (2 * COMMON))
        hot = times[code] >= least
        gram = min(GRAM, depth)
        begin, end = _merged(start[hot], start[hot] + count[hot] + depth - gram)
        found = [_NONE]
        for a, b in zip(begin.tolist(), end.tolist(), strict=True):
            found.append(_hashes(self.text[a : b + gram - 1], gram))
        values, times = np.unique(np.concatenate(found), return_counts=True)
        return values[times >= least], times[times >= least]


_NONE = np.zeros(0, np.uint64)
_TOP = np.uint64(1 << 63)


class Grams:
    """A set of hashes; most others are told apart by a table of bits."""

    def __init__(self, values: np.ndarray):
        self.values, self.size = np.sort(values), len(values)
        self.mask = np.uint64(max(1 << 16, 1 << (32 * self.size).bit_length()) - 1 if self.size else 0)
        self.table = np.zeros(int(self.mask) + 1, bool)
        self.table[(self.values & self.mask).astype(np.int64)] = True

    def among(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes that are in the set."""
        some = np.flatnonzero(self.table[(hashes & self.mask).astype(np.int64)])
        near = np.minimum(np.searchsorted(self.values, hashes[some]), self.size - 1)
        return some[self.values[near] == hashes[some]]


def _hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` bytes, without the top bit; at most ``SLICE`` of them and a little more at a time."""
    if len(data) > 2 * SLICE:
        parts = [_hashes(data[at : at + SLICE + gram - 1], gram) for at in range(0, len(data) - gram + 1, SLICE)]
        return np.concatenate(parts)
    power, inverse = _power_tables(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
        return mix((sums[gram:] - sums[:-gram]) * inverse[: len(data) - gram + 1]) & ~_TOP


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours."""
    have = 1
    count = len(values) - width + 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[:count], values[width - have : width - have + count])


def _runs(
    text: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: int, depth: int, common: Grams
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phrases whose strings begin in the slice at ``at``."""
    data = text[at : at + SLICE + depth - 1]
    gram = min(GRAM, depth)
    if len(data) < depth:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = _hashes(data, gram)
    if common.size:
        hashes[common.among(hashes)] |= _TOP
    trigger = _minima(hashes, depth - gram + 1)
    count = len(trigger)
    # Documents of the slice: the last one that begins at or before a place, for empty ones end at once.
    first, beyond = np.searchsorted(starts, [at, at + count - 1], "right")
    marks = np.bincount(starts[first:beyond] - at, minlength=count)
    owner = np.cumsum(marks[:count]) + first - 1
    inside = np.arange(at, at + count) + depth <= ends[owner]
    change = np.ones(count, bool)
    change[1:] = (trigger[1:] != trigger[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
    begin = np.flatnonzero(change & inside)
    stop = np.append(np.flatnonzero(change | ~inside), count)
    size = stop[np.searchsorted(stop, begin, "right")] - begin
    pieces = -(-size // LONGEST)
    step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin, size = np.repeat(begin, pieces) + step * LONGEST, np.repeat(size, pieces) - step * LONGEST
    return trigger[begin], begin + at, np.minimum(size, LONGEST), owner[begin]


def _places(triggers: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and print of a trigger in one number, the bucket above."""
    prints = (triggers >> np.uint64(20)) & np.uint64(0xFFFFFFFF)
    return (triggers % np.uint64(buckets)) << np.uint64(32) | prints


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of batches as dictionaries, one at a time."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _split(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of sorted keys, and where each begins, with the end."""
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[begins], np.append(begins, len(keys))


def _by_bucket(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Bucket and lists of columns for each bucket of batches that are sorted by it."""
    bucket, lists = None, [[] for _ in names]
    for batch in batches:
        numbers = batch.column("bucket").to_numpy()
        columns = [batch.column(name).to_pylist() for name in names]
        found, begins = _split(numbers)
        for k, number in enumerate(found.tolist()):
            if bucket is not None and number != bucket:
                yield bucket, *lists
                lists = [[] for _ in names]
            bucket = number
            for held, column in zip(lists, columns, strict=True):
                held += column[begins[k] : begins[k + 1]]
    if bucket is not None:
        yield bucket, *lists


def _common(chunks: DataFrame, documents: int, depth: int) -> Grams:
    """Grams that occur once for ``COMMON`` documents, as far as chunks report them; they bear on the cost alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            values, docs = Chunk(row).common_grams(depth)
            yield pa.RecordBatch.from_pydict({"gram": values.astype(np.int64), "docs": docs.astype(np.int64)})

    told = chunks.mapInArrow(work, "gram long, docs long").groupBy("gram").agg(F.sum("docs").alias("docs"))
    frequent = told.where(F.col("docs") * COMMON >= documents).where(F.col("docs") > LEAST_COMMON)
    found = frequent.orderBy(F.desc("docs"), "gram").limit(MOST_COMMON).select("gram").collect()
    return Grams(np.array([row.gram for row in found], np.int64).astype(np.uint64))


def _prints(chunks: DataFrame, buckets: int, depth: int, common: Grams) -> DataFrame:
    """bucket, chunk and the distinct prints of the chunk's triggers in that bucket, ascending."""
    shared_common = chunks.sparkSession.sparkContext.broadcast(common)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            places = np.unique(_places(Chunk(row).runs(depth, shared_common.value)[0], buckets))
            found, begins = _split((places >> np.uint64(32)).astype(np.int32))
            offsets = pa.py_buffer((4 * begins).astype(np.int32).tobytes())
            held = pa.py_buffer((places & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found),
                    pa.array(np.full(len(found), row["chunk"], np.int64)),
                    pa.Array.from_buffers(pa.binary(), len(found), [None, offsets, held]),
                ],
                names=["bucket", "chunk", "prints"],
            )

    return chunks.mapInArrow(work, "bucket int, chunk long, prints binary")


def _shared(prints: DataFrame) -> DataFrame:
    """bucket, chunk and a bit for each of the chunk's prints that another chunk has too; none, no row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, numbers, lists in _by_bucket(batches, "chunk", "prints"):
            sizes = np.array([len(p) // 4 for p in lists])
            values = np.frombuffer(b"".join(lists), np.uint32)
            _, code, counts = np.unique(values, return_inverse=True, return_counts=True)
            common = counts[code] > 1
            owner = np.repeat(np.arange(len(lists)), sizes)
            some = np.flatnonzero(np.bincount(owner, common, len(lists)))
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([bucket] * len(some), pa.int32()),
                "chunk": pa.array([numbers[k] for k in some], pa.int64()),
                "bits": pa.array([np.packbits(common[ends[k] - sizes[k] : ends[k]]).tobytes() for k in some], pa.binary()),
            })

    return prints.mapInArrow(work, "bucket int, chunk long, bits binary")


def _told(chunk: Chunk, runs: tuple, bits: list[dict], buckets: int) -> np.ndarray:
    """Whether each phrase's trigger is in two documents or in two chunks."""
    trigger, owner = runs[0], chunk.ids[runs[3]]
    order = np.argsort(trigger)
    _, begins = _split(trigger[order])
    told = np.zeros(len(trigger), bool)
    if len(trigger):
        docs, sizes = owner[order], np.diff(begins)
        least, largest = np.minimum.reduceat(docs, begins[:-1]), np.maximum.reduceat(docs, begins[:-1])
        told[order] = np.repeat(least < largest, sizes)
    if bits:
        places = _places(trigger, buckets)
        known = np.unique(places)
        found, begins = _split((known >> np.uint64(32)).astype(np.int64))
        common = np.zeros(len(known), bool)
        for row in bits:
            k = int(np.searchsorted(found, row["bucket"]))
            size = int(begins[k + 1] - begins[k])
            common[begins[k] : begins[k + 1]] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=size).astype(bool)
        told |= common[np.searchsorted(known, places)]
    return told


def _repeats_within(chunk: Chunk, start: np.ndarray, count: np.ndarray, owner: np.ndarray, depth: int) -> np.ndarray:
    """Whether each phrase also stands in a document of the chunk with a smaller id."""
    code, codes = np.zeros(len(start), np.int64), {}
    for k, (a, n) in enumerate(zip(start.tolist(), count.tolist(), strict=True)):
        code[k] = codes.setdefault(chunk.raw[a : a + n + depth - 1], len(codes))
    ids = chunk.ids[owner]
    least = np.full(len(codes), NULL_ID)
    np.minimum.at(least, code, ids)
    return ids > least[code]


def _phrases(chunks: DataFrame, shared: DataFrame, buckets: int, depth: int, common: Grams) -> DataFrame:
    """bucket, chunk, the chunk's phrases there (documents, places, tags of triggers, numbers of strings, bytes), and
    spans that are repeats within the chunk."""
    shared_common = chunks.sparkSession.sparkContext.broadcast(common)
    bits = shared.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("bits"))
    joined = chunks.join(bits, "chunk", "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk(row)
            runs = chunk.runs(depth, shared_common.value)
            told = _told(chunk, runs, row["bits"] or [], buckets)
            trigger, start, count, owner = (column[told] for column in runs)
            order = np.lexsort([trigger, trigger % np.uint64(buckets)])
            start, count, owner = start[order], count[order], owner[order]
            tags = (trigger[order] >> np.uint64(48)).astype(np.uint16)
            again = _repeats_within(chunk, start, count, owner, depth)
            found, begins = _split((trigger[order] % np.uint64(buckets)).astype(np.int32))
            sizes = count + depth - 1
            for k in range(0, len(found), 256):  # few buckets at a time
                numbers, packed, known = found[k : k + 256], [], []
                edges = begins[k : k + 257].tolist()
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    some = np.arange(a, b)[~again[a:b]]
                    ends = np.cumsum(sizes[some])
                    place = np.arange(ends[-1]) + np.repeat(start[some] - ends + sizes[some], sizes[some])
                    packed.append(_pack(
                        np.array([len(some)]), chunk.ids[owner[some]], start[some], np.diff(tags[some], prepend=np.uint16(0)),
                        count[some].astype(np.uint8), chunk.text[place],
                    ))
                    gone = np.arange(a, b)[again[a:b]]
                    known.append(_pack(start[gone], start[gone] + sizes[gone]) if len(gone) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers), pa.array(np.full(len(numbers), chunk.number)), pa.array(packed, pa.binary()),
                        pa.array(known, pa.binary()),
                    ],
                    names=["bucket", "chunk", "phrases", "known"],
                )

    return joined.mapInArrow(work, "bucket int, chunk long, phrases binary, known binary")


def first_documents(phrases: list[bytes], counts: np.ndarray, docs: np.ndarray, depth: int) -> np.ndarray:
    """For every string of distinct phrases, in order: the smallest document of any phrase that holds it."""
    corpus = Corpus(phrases)
    offsets = np.cumsum(counts) - counts
    step = np.arange(counts.sum()) - np.repeat(offsets, counts)
    places = np.repeat(corpus.starts, counts) + step
    ordered = corpus.ordered(places)
    same = corpus.repeats(ordered, depth)
    owner = np.searchsorted(corpus.starts, ordered, "right") - 1
    groups = np.cumsum(~same) - 1
    least = np.minimum.reduceat(docs[owner], np.flatnonzero(~same)) if len(ordered) else docs[:0]
    found = np.empty(len(ordered), np.int64)
    found[offsets[owner] + ordered - corpus.starts[owner]] = least[groups]
    return found


def _portions(phrases: np.ndarray, tag: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Phrases in order of their tags, cut between tags into portions of about ``PORTION`` bytes."""
    if not len(phrases):
        return
    part = np.cumsum(sizes[phrases]) // PORTION
    first = np.concatenate([[True], tag[phrases[1:]] != tag[phrases[:-1]]])
    part = part[np.maximum.accumulate(np.where(first, np.arange(len(phrases)), 0))]  # a tag lies where it begins
    begins = _split(part)[1]
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        yield phrases[a:b]


def _repeated(phrases: DataFrame, depth: int) -> DataFrame:
    """chunk and spans of its text whose strings a smaller document has too."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, numbers, packed, known in _by_bucket(batches, "chunk", "phrases", "known"):
            codes: dict[bytes, int] = {}
            ids, starts, tags, counts, sizes, code = [], [], [], [], [], []
            for data in packed:
                raw = _unpack(data)
                n = int.from_bytes(raw[:8], "little")
                ids.append(np.frombuffer(raw, np.int64, n, 8))
                starts.append(np.frombuffer(raw, np.int64, n, 8 + 8 * n))
                tags.append(np.cumsum(np.frombuffer(raw, np.uint16, n, 8 + 16 * n), dtype=np.uint16))
                counts.append(np.frombuffer(raw, np.uint8, n, 8 + 18 * n).astype(np.int64))
                ends = (8 + 19 * n + np.cumsum(counts[-1] + depth - 1)).tolist()
                code += [codes.setdefault(raw[a:b], len(codes)) for a, b in zip([8 + 19 * n, *ends[:-1]], ends, strict=True)]
                sizes.append(n)
            ids, starts, counts = np.concatenate(ids), np.concatenate(starts), np.concatenate(counts)
            code = np.array(code)
            least = np.full(len(codes), NULL_ID)
            np.minimum.at(least, code, ids)
            lengths = np.zeros(len(codes), np.int64)
            lengths[code] = counts
            tag = np.zeros(len(codes), np.uint16)
            tag[code] = np.concatenate(tags)
            # A phrase whose trigger no other one has shares no string with another.
            several = np.flatnonzero(np.bincount(tag, minlength=1 << 16)[tag] > 1)
            firsts, begins, distinct = np.repeat(least, lengths), np.cumsum(lengths) - lengths, list(codes)
            several = several[np.argsort(tag[several], kind="stable")]
            for some in _portions(several, tag, lengths + depth - 1):  # few at a time stay in a processor's memory
                counts_ = lengths[some]
                at = np.arange(counts_.sum()) + np.repeat(begins[some] - np.cumsum(counts_) + counts_, counts_)
                firsts[at] = first_documents([distinct[k] for k in some.tolist()], counts_, least[some], depth)
            # Every string of every phrase of the bucket, by its distinct phrase.
            step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            later = firsts[np.repeat((np.cumsum(lengths) - lengths)[code], counts) + step] < np.repeat(ids, counts)
            place, owner = np.repeat(starts, counts) + step, np.repeat(np.repeat(np.arange(len(packed)), sizes), counts)
            fresh = later & ~np.concatenate([[False], later[:-1] & (place[1:] == place[:-1] + 1) & (owner[1:] == owner[:-1])])
            last = later & ~np.concatenate([later[1:] & ~fresh[1:], [False]])
            begin, end, of = place[fresh], place[last] + depth, owner[fresh]
            found, begins = _split(of)
            told = [(numbers[k], spans) for k, spans in enumerate(known) if spans is not None]
            told += [
                (numbers[k], _pack(begin[a:b], end[a:b]))
                for k, a, b in zip(found.tolist(), begins[:-1].tolist(), begins[1:].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([number for number, _ in told], pa.int64()),
                "spans": pa.array([spans for _, spans in told], pa.binary()),
            })

    return phrases.mapInArrow(work, "chunk long, spans binary")


def _merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans joined where they overlap or touch."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    fresh = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
    return begin[fresh], np.append(reach[fresh[1:] - 1], reach[-1:])


def _kept(chunks: DataFrame, spans: DataFrame, id_type: str) -> DataFrame:
    joined = chunks.join(spans.groupBy("chunk").agg(F.collect_list("spans").alias("spans")), "chunk", "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk(row)
            pairs = [np.frombuffer(_unpack(s), np.int64).reshape(2, -1) for s in row["spans"] or []]
            begin, end = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
            order = np.argsort(begin, kind="stable")
            begin, end = begin[order], end[order]
            low = np.searchsorted(begin, chunk.starts)
            high = np.searchsorted(begin, chunk.ends)
            removed, kept = [], []
            for a, b, start, stop in zip(low.tolist(), high.tolist(), chunk.starts.tolist(), chunk.ends.tolist(), strict=True):
                if a >= b:
                    removed.append([])
                    kept.append(chunk.raw[start:stop])
                    continue
                cuts = [(x, y) for x, y in zip(*(v.tolist() for v in _merged(begin[a:b], end[a:b])), strict=True)]
                edges = [start, *[e for cut in cuts for e in cut], stop]
                kept.append(b"".join(chunk.raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
                removed.append([{"start": x - start, "end": y - start} for x, y in cuts])
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(chunk.ids, mask=chunk.nulls),
                    pa.array(chunk.sizes),
                    pa.array(removed, pa.list_(span)),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "removed", "kept"],
            )

    return joined.mapInArrow(work, "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary")


def remove_repeats(
    docs: DataFrame,
    depth: int = DEPTH,
    id_column: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    bucket: int = BUCKET,
) -> DataFrame:
    """doc_id, n_bytes, removed, kept: texts without what stands in documents of smaller ids.

    A byte goes if a string of ``depth`` bytes of UTF-8 that covers it also
    begins in a document with a smaller id. ``removed`` holds the longest runs
    of such bytes, ``kept`` the others joined. Strings lie within one document,
    and are judged on the input. Rows of one id remove nothing from each other;
    a null id counts as larger than every other. Null and empty texts have no
    bytes; a text of any length is one document. No rows, no result; other
    columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark, "repeats")
    chunked(docs, id_column, text, chunk).write.option("parquet.block.size", 16 << 20).parquet(f"{folder}/chunks")
    chunks = spark.read.parquet(f"{folder}/chunks")
    summed = chunks.agg(F.sum("n_bytes").alias("total"), F.sum(F.octet_length("nulls")).alias("documents")).first()
    buckets = max(1, (summed["total"] or 0) // bucket)
    common = _common(chunks, summed["documents"] or 0, depth)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), buckets // 32)

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, "bucket").sortWithinPartitions("bucket")

    shared = _shared(dealt(_prints(chunks, buckets, depth, common)))
    phrases = dealt(_phrases(chunks, shared, buckets, depth, common))
    return _kept(chunks, _repeated(phrases, depth), "long")


def repeats_sql(depth: int = DEPTH) -> str:
    """The same in SQL: every string in full, as hexadecimal digits."""
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), strings AS (
  SELECT r, doc_id, unnest(range(0, len(h) // 2 - {depth - 1})) AS p, h FROM texts
), placed AS (
  SELECT r, doc_id, p, substr(h, 2 * p + 1, {2 * depth}) AS s FROM strings
), firsts AS (
  SELECT s, min(doc_id) AS least FROM placed GROUP BY s HAVING min(doc_id) < max(doc_id)
), covered AS (
  SELECT r, p, CASE WHEN p > lag(p) OVER (PARTITION BY r ORDER BY p) + {depth} THEN 1 ELSE 0 END AS fresh
  FROM placed JOIN firsts USING (s) WHERE least < doc_id
), numbered AS (
  SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS span FROM covered
), spans AS (
  SELECT r, min(p) AS a, max(p) + {depth} AS b FROM numbered GROUP BY r, span
), before AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS done FROM spans
), cut AS (
  SELECT r, sum(b - a) AS removed, count(*) AS n, max(b) AS done,
    string_agg(substr(h, 2 * done + 1, 2 * (a - done)), '' ORDER BY a) AS kept
  FROM before JOIN texts USING (r) GROUP BY r
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, 2 * done + 1), h))) AS kept_sha256
FROM texts LEFT JOIN cut USING (r)"""
