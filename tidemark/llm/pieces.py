"""SentencePiece encoding that keeps the source bytes of every piece.

The normaliser is rebuilt from the model file: the compiled character map is a
double-array trie over UTF-8 bytes, and the longest matching prefix at each
position is replaced by its mapped string. Every normalised byte remembers the
source byte it came from, so each piece projects to a span of source bytes.

No piece of a word model holds a word boundary after other characters, so
merges never cross one: the normalised text is cut there and the ids of each
distinct segment are looked up once per worker.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from .batches import extend, pick, texts_of

SPACE = "▁"
# Distinct segments that a worker remembers; the results do not depend on it.
REMEMBERED = 400_000


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(raw):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        elif tag & 7 == 2:
            size = number()
            yield tag >> 3, raw[at : at + size]
            at += size
        else:
            size = 8 if tag & 7 == 1 else 4
            yield tag >> 3, raw[at : at + size]
            at += size


class CharacterMap:
    """The compiled map: a double-array trie from byte strings to replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.strings = blob[4 + size :]

    def longest(self, raw: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest key that begins at ``at``."""
        units = self.units
        if not units:
            return None
        node = (units[0] >> 10) << ((units[0] & 0x200) >> 6)
        found = None
        for k in range(at, len(raw)):
            node ^= raw[k]
            if node >= len(units) or units[node] & 0x800000FF != raw[k]:
                break
            unit = units[node]
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit & 0x100:
                found = units[node] & 0x7FFFFFFF, k + 1 - at
        if found is None:
            return None
        start = found[0]
        return self.strings[start : self.strings.index(b"\0", start)], found[1]


class Normaliser:
    """Longest-prefix normalisation with the source byte of every normalised byte."""

    def __init__(self, spec: bytes, suffix: bool = False, symbols: tuple[bytes, ...] = ()):
        found = dict(_fields(spec))
        self.map = CharacterMap(found.get(2, b""))
        self.dummy = bool(found.get(3, 1))
        self.squeeze = bool(found.get(4, 1))
        self.escape = bool(found.get(5, 1))
        self.suffix = suffix
        self.symbols = tuple(sorted(symbols, key=len, reverse=True))

    @property
    def plain(self) -> bool:
        """Whether only spaces are escaped and a boundary is put in front."""
        return not (self.map.units or self.squeeze or self.suffix or self.symbols) and self.dummy and self.escape

    def _prefix(self, raw: bytes, at: int) -> tuple[bytes, int]:
        for symbol in self.symbols:
            if raw.startswith(symbol, at):
                return symbol, len(symbol)
        found = self.map.longest(raw, at)
        if found:
            return found
        first = raw[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return raw[at : at + size], size

    def normalise(self, raw: bytes) -> tuple[bytes, list[int]]:
        """Normalised bytes, and for each of them (and the end) its source byte."""
        space = SPACE.encode() if self.escape else b" "
        at, out, source = 0, bytearray(), []

        def put(data: bytes) -> None:
            out.extend(data)
            source.extend([at] * len(data))

        if self.squeeze:
            while at < len(raw):
                text, size = self._prefix(raw, at)
                if text != b" ":
                    break
                at += size
        if at >= len(raw):
            return b"", [at]
        if self.dummy and not self.suffix:
            put(space)
        after_space = self.squeeze
        while at < len(raw):
            text, size = self._prefix(raw, at)
            if after_space:
                text = text.lstrip(b" ")
            if text:
                put(text.replace(b" ", space))
                after_space = text.endswith(b" ")
            at += size
            if not self.squeeze:
                after_space = False
        if self.squeeze:
            while out.endswith(space):
                at = source[len(out) - len(space)]
                del out[len(out) - len(space) :]
            del source[len(out) :]
        if self.dummy and self.suffix:
            put(space)
        return bytes(out), [*source, at]


class Encoder:
    """Ids and source spans of texts under one model file."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, trainer, spec = [], {}, b""
        with open(path, "rb") as file:
            for field, value in _fields(file.read()):
                if field == 1:
                    piece = dict(_fields(value))
                    pieces.append((piece.get(1, b""), piece.get(3, 1)))
                elif field == 2:
                    trainer = dict(_fields(value))
                elif field == 3:
                    spec = value
        if not trainer.get(35):
            raise ValueError(f"{path}: pieces without byte fallback have no exact byte spans")
        symbols = tuple(text for text, kind in pieces if kind == 4)
        self.normaliser = Normaliser(spec, bool(trainer.get(24)), symbols)
        inner = re.compile(f"[^{SPACE}]{SPACE}".encode())
        self.by_segment = self.normaliser.plain and not any(inner.search(text) for text, kind in pieces if kind == 1)
        # Normalised bytes of each piece: one for a byte piece, none for a control piece.
        self.lengths = [1 if kind == 6 else 0 if kind in (2, 3) else len(text) for text, kind in pieces]
        # The same in source bytes, where every boundary stands for one space.
        self.sizes = np.array([
            size - 2 * text.count(SPACE.encode()) if size > 1 else size
            for size, (text, _) in zip(self.lengths, pieces, strict=True)
        ])
        self.boundary = self.model.piece_to_id(SPACE)
        self._forget()

    def _forget(self) -> None:
        """Start an empty memory: a number for each segment, and all their ids and sizes in a row."""
        self.known: dict[str, int] = {}
        self.count, self.used = 0, 0
        self.begin, self.length = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.ids, self.steps = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int64)

    def _whole(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of a text and the source byte at which each piece ends."""
        ids = self.model.encode(text)
        _, source = self.normaliser.normalise(text.encode())
        at, ends = 0, []
        for piece in ids:
            at += self.lengths[piece]
            ends.append(source[min(at, len(source) - 1)])
        return ids, ends

    _SEGMENT = re.compile(f"[ {SPACE}]*[^ {SPACE}]+|[ {SPACE}]+")

    def _learn(self, segments: list[str]) -> None:
        """Remember ids and piece sizes in source bytes of segments that begin with a boundary."""
        found = [ids or [self.boundary] for ids in self.model.encode([s[1:] for s in segments], num_threads=1)]
        length = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(length.sum()))
        ends = np.cumsum(length)
        steps = self.sizes[ids]
        for k, segment in enumerate(segments):
            if SPACE in segment:  # a boundary sign of the text itself is not one byte
                steps[ends[k] - length[k] : ends[k]] = self._project(segment, found[k])
        self.begin = _put(self.begin, self.count, ends - length + self.used)
        self.length = _put(self.length, self.count, length)
        self.ids, self.steps = _put(self.ids, self.used, ids), _put(self.steps, self.used, steps)
        self.known.update(zip(segments, range(self.count, self.count + len(segments)), strict=True))
        self.count += len(segments)
        self.used += len(ids)

    def _project(self, segment: str, ids: list[int]) -> list[int]:
        source, at = [], 0
        for char in segment:
            size = len(char.encode())
            source += [at] * 3 if char == " " else range(at, at + size)
            at += size
        source.append(at)
        sizes, begin, done = [], 0, 0
        for piece in ids:
            begin += self.lengths[piece]
            sizes.append(source[begin] - done)
            done = source[begin]
        return sizes

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids, and the source byte at which each piece ends; it begins where the one before ends."""
        ids, ends = self.arrays(text)
        return ids.tolist(), ends.tolist()

    def arrays(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`encode` as arrays."""
        if not text:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        whole = None
        if self.by_segment:
            first, *segments = self._SEGMENT.findall(text)
            numbers = list(map(self.known.get, segments))
            if None in numbers:
                missing = {s for s, number in zip(segments, numbers, strict=True) if number is None}
                if self.count + len(missing) > REMEMBERED:
                    self._forget()
                    missing = set(segments)
                if len(missing) <= REMEMBERED:
                    self._learn(list(missing))
                    numbers = [self.known[s] for s in segments]
                else:
                    whole = text
        else:
            whole = text
        ids, ends = self._whole(first if whole is None else whole)
        ids, ends = np.array(ids, np.int32), np.array(ends, np.int64)
        if whole is None and segments:
            at = np.array(numbers)
            length = self.length[at]
            stops = np.cumsum(length)
            pick = np.arange(stops[-1]) + np.repeat(self.begin[at] - (stops - length), length)
            ids = np.concatenate([ids, self.ids[pick]])
            ends = np.concatenate([ends, len(first.encode()) + np.cumsum(self.steps[pick])])
        return ids, ends


def _put(held: np.ndarray, at: int, new: np.ndarray) -> np.ndarray:
    """Write into an array that grows by doubling."""
    if at + len(new) > len(held):
        grown = np.zeros(max(2 * len(held), at + len(new)), held.dtype)
        grown[:at] = held[:at]
        held = grown
    held[at : at + len(new)] = new
    return held


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """The encoder of a model file, once per worker."""
    return Encoder(path)


def encode_texts(docs: DataFrame, model: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``id_column``, ``ids`` and ``ends`` of every row.

    ``ends[i]`` is the source byte (of the UTF-8 text) at which piece i ends; it
    begins at ``ends[i - 1]``, so the pieces tile the text. Null and empty texts
    have no ids; repeated rows are encoded alike; other columns are ignored.
    ``model`` is the path of the model file on every executor. No shuffle.
    """

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [encoder(model).arrays(value) for value in texts_of(batch, text)]
        offsets = pa.array(np.cumsum([0, *[len(ids) for ids, _ in found]]), pa.int32())
        return [
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(values)))
            for values in zip(*found, strict=True)
        ]

    fields = [StructField("ids", ArrayType(IntegerType(), False)), StructField("ends", ArrayType(LongType(), False))]
    return extend(pick(docs, id_column, text), fields, compute).drop(text)


def decode_ids(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """Append ``decoded``, the text of each row's ids; null ids decode to the empty text."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        column = batch.column(ids)
        rows = [[] if row is None else row.to_numpy().tolist() for row in (cell.values for cell in column)]
        return [pa.array(encoder(model).model.decode(rows, num_threads=1), pa.string())]

    return extend(encoded, [StructField("decoded", StringType())], compute)
