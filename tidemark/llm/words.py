"""Hash every word of a batch of texts with a few numpy passes.

A word is a longest run of bytes other than space and 0x09-0x0D. Its hash takes
eight bytes at a time; that of a run, or of a long word, is a polynomial modulo
2**64, read off prefix sums, then mixed. Texts are cut at separators into pieces
of bounded size, so memory does not grow with the longest text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np

PIECE = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEPARATORS = b" \t\n\x0b\x0c\r"
_BLANK = re.compile(rb"[ \t\n\x0b\x0c\r]*")

_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[list(_SEPARATORS)] = True
_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
# Bytes from which on a word is hashed as a run.
LONG_WORD = 64
# The first k bytes of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``size`` of them."""
    have = next(iter(_powers.values()), None)
    if have is None or len(have[0]) < size:
        size = max(size, PIECE + 1)
        with np.errstate(over="ignore"):
            tables = tuple(
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)]), dtype=np.uint64)
                for x in (_BASE, _INVERSE)
            )
        _powers.clear()
        _powers[size] = tables
        have = tables
    return have


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    with np.errstate(over="ignore"):
        values = values ^ (values >> np.uint64(33))
        values *= np.uint64(0xFF51AFD7ED558CCD)
        values ^= values >> np.uint64(33)
        values *= np.uint64(0xC4CEB9FE1A85EC53)
        values ^= values >> np.uint64(33)
        return values


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run ``data[start:end]`` of small integers."""
    power, inverse = _power_tables(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * inverse[starts])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end."""
    inside = np.concatenate([[False], ~_IS_SEPARATOR[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _pieces(texts: Iterable[str]) -> Iterator[tuple[bytes, list[int], list[int]]]:
    """Pieces of about ``PIECE`` bytes with the texts that begin in them and where."""
    data, owners, begins = bytearray(), [], []
    for index, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass")
        at = 0
        while True:
            owners.append(index)
            begins.append(len(data))
            room = max(PIECE - len(data), 1)
            at = _BLANK.match(raw, at).end()  # so that a cut lies behind at least one word
            if len(raw) - at <= room:
                data += raw[at:]
                data += b" "
                break
            cut = max(raw.rfind(bytes([s]), at, at + room) for s in _SEPARATORS)
            if cut < at and not begins[-1]:  # one word longer than a piece
                found = [raw.find(bytes([s]), at) for s in _SEPARATORS]
                cut = min((x for x in found if x >= 0), default=len(raw))
            if cut >= at:
                data += raw[at:cut]
                data += b" "
                at = cut
            yield bytes(data), owners, begins
            data, owners, begins = bytearray(), [], []
        if len(data) >= PIECE:
            yield bytes(data), owners, begins
            data, owners, begins = bytearray(), [], []
    if data:
        yield bytes(data), owners, begins


def _hashes_of_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word ``data[start:end]``; at least eight bytes of ``data`` follow the last one."""
    lengths = ends - starts
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    hashes = mix(lengths.astype(np.uint64)) ^ (eight[starts] & _FIRST[np.minimum(lengths, 8)])
    hashes = mix(hashes)
    for k in range(8, LONG_WORD, 8):
        rest = np.flatnonzero(lengths > k)
        if not len(rest):
            return hashes
        hashes[rest] = mix(hashes[rest] ^ (eight[starts[rest] + k] & _FIRST[np.minimum(lengths[rest] - k, 8)]))
    rest = np.flatnonzero(lengths > LONG_WORD)
    if len(rest):
        hashes[rest] = run_hashes(data, starts[rest], ends[rest])
    return hashes


def word_hashes(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the offsets at which each text's words begin."""
    counts, found = np.zeros(len(texts) + 1, np.int64), []
    for raw, owners, begins in _pieces(texts):
        data = np.frombuffer((raw.translate(_LOWER) if lower else raw) + bytes(8), np.uint8)
        starts, ends = word_bounds(data[: len(raw)])
        found.append(_hashes_of_words(data, starts, ends))
        counts[np.asarray(owners) + 1] += np.diff(np.searchsorted(starts, [*begins, len(raw)]))
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), np.cumsum(counts)
