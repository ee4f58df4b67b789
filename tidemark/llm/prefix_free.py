"""Order of all suffixes of many strings by prefix-free parsing.

A rolling hash over a few symbols names trigger places; a phrase runs from one
trigger to the end of the next, so neighbouring phrases overlap in it. The
distinct phrases are the dictionary, the strings as numbers of phrases are the
parse. What is left of a phrase from any place on, with the trigger that ends
it, is never the beginning of another such rest. So two suffixes of the text
compare as the rests of their phrases do, and if these are equal as the
suffixes of the parse that follow. Both are ranked by prefix doubling: the
dictionary holds repeated text once, and the parse is shorter than the text.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

# Symbols of the rolling hash, and one place in so many is a trigger.
WINDOW, SPACING = 4, 8
# Symbols are bytes plus one, so that 0 ends a string: nine bits each, seven to a word.
_BITS, _WORD = 9, 7
_FACTOR = np.uint32(0x9E3779B1)


def _triggers(symbols: np.ndarray) -> np.ndarray:
    """Whether a trigger begins at a place; the last ``WINDOW - 1`` places have none."""
    found = np.zeros(len(symbols), bool)
    size = len(symbols) - WINDOW + 1
    if size > 0:
        value = np.zeros(size, np.uint32)
        for k in range(WINDOW):
            value = value * _FACTOR + symbols[k : k + size]
        value = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        found[:size] = (value >> np.uint32(13)) % np.uint32(SPACING) == 0
    return found


def _words(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The symbols from each place on as one number, 0 beyond the place's end."""
    places = np.arange(len(symbols))
    value = np.zeros(len(symbols), np.uint64)
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros(_WORD, np.uint64)])
    for k in range(_WORD):
        here = padded[k : k + len(symbols)]
        value = (value << np.uint64(_BITS)) | np.where(places + k < ends, here, np.uint64(0))
    return value


def _doubled(rank: np.ndarray, ends: np.ndarray, reach: int) -> np.ndarray:
    """Ranks of whole suffixes from ranks of their first ``reach`` symbols; equal suffixes have equal ranks."""
    places, longest = np.arange(len(rank)), int((ends - np.arange(len(rank))).max(initial=0))
    open_ = np.ones(len(rank), bool)
    while reach < longest:
        some = np.flatnonzero(open_ & (places + reach < ends))
        if not len(some):
            break
        # No suffix is the beginning of another, since ends have symbols of their own: members of a group end together.
        keys = rank[some] * len(rank) + rank[some + reach]
        order = np.argsort(keys)
        keys, of = keys[order], rank[some[order]]
        at = np.arange(len(some))
        fresh_group = np.concatenate([[True], of[1:] != of[:-1]])
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        group, start = np.maximum.accumulate(np.where(fresh_group, at, 0)), np.maximum.accumulate(np.where(fresh, at, 0))
        rank = rank.copy()
        rank[some[order]] = of + start - group
        alone = fresh & np.concatenate([fresh[1:], [True]])
        open_[some[order[alone]]] = False
        reach *= 2
    return rank


def _ranked(keys: np.ndarray) -> np.ndarray:
    """Place of each key's first equal in sorted order."""
    order = np.argsort(keys)
    ordered = keys[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), 0))
    return rank


class Corpus:
    """Strings in one text, each followed by ``WINDOW`` zeros."""

    def __init__(self, strings: Sequence[bytes]):
        sizes = np.array([len(s) for s in strings], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes + WINDOW)[:-1]]).astype(np.int64) if len(sizes) else sizes
        self.sizes = sizes
        gap = b"\0" * WINDOW
        raw = np.frombuffer(gap.join(strings) + gap, np.uint8)
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[self.starts] += 1
        np.subtract.at(inside, self.starts + sizes, 1)
        self.symbols = raw.astype(np.uint16) + np.cumsum(inside[:-1], dtype=np.int8).astype(np.uint16)
        self._parse()

    def _parse(self) -> None:
        symbols = self.symbols
        cut = _triggers(symbols)
        cut[np.flatnonzero(symbols == 0)] = False
        for k in range(1, WINDOW):  # a trigger lies within its string
            cut[:-k] &= symbols[k:] != 0
        cut[self.starts[self.sizes > 0]] = True
        begins = np.flatnonzero(cut)
        owner = np.searchsorted(self.starts, begins, "right") - 1
        last = np.concatenate([owner[1:] != owner[:-1], [True]]) if len(begins) else np.zeros(0, bool)
        finish = np.where(last, self.starts[owner] + self.sizes[owner], np.append(begins[1:], 0)) + WINDOW
        raw = symbols.astype(">u2").tobytes()
        phrases = [raw[2 * a : 2 * b] for a, b in zip(begins.tolist(), finish.tolist(), strict=True)]
        dictionary = sorted(set(phrases))
        number = dict(zip(dictionary, range(len(dictionary)), strict=True))
        self.begins, self.parse = begins, np.array([number[p] for p in phrases], np.int64)
        places = np.arange(len(begins))
        ends = np.append(np.flatnonzero(last) + 1, len(begins))[np.cumsum(last) - last] if len(begins) else places
        # Suffixes of the parse, each up to the end of its string.
        self.parse_rank = _doubled(_ranked(self.parse), ends, 1)
        self.last = last
        # Suffixes of the dictionary's phrases.
        lengths = np.array([len(p) // 2 for p in dictionary], np.int64)
        held = np.frombuffer(b"".join(dictionary), ">u2").astype(np.uint16)
        self.phrase_starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else lengths
        phrase_ends = np.repeat(self.phrase_starts + lengths, lengths)
        self.rest_rank = _doubled(_ranked(_words(held, phrase_ends)), phrase_ends, _WORD)

    def ordered(self, places: np.ndarray) -> np.ndarray:
        """Places of the text in the order of the suffixes that begin there."""
        if not len(places):
            return places
        phrase = np.searchsorted(self.begins, places, "right") - 1
        rest = self.rest_rank[self.phrase_starts[self.parse[phrase]] + places - self.begins[phrase]]
        follows = np.where(self.last[phrase], 0, 1 + self.parse_rank[np.minimum(phrase + 1, len(self.parse_rank) - 1)])
        return places[np.argsort(rest * (len(self.begins) + 1) + follows)]

    def repeats(self, ordered: np.ndarray, depth: int) -> np.ndarray:
        """For places in suffix order: whether the ``depth`` symbols there equal those of the place before."""
        same = np.ones(len(ordered), bool)
        same[:1] = False
        words = _words(self.symbols, np.full(len(self.symbols), len(self.symbols)))
        for k in [*range(0, depth - _WORD + 1, _WORD), depth - _WORD]:
            found = words[ordered + k]
            same[1:] &= found[1:] == found[:-1]
        return same
