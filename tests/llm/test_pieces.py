import hashlib
import struct

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.pieces import CharacterMap, Encoder, Normaliser, decode_ids, encode_texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ENCODER = Encoder(MODEL)

CASES = [
    "", " ", "  ", " a", "a ", "a  ", "▁", "▁▁a", "a▁b ▁ c", " ▁", "\n", " \n ", "日本 語🙂x", "é  x", "a b",
    "\x00a b\x00", "x" * 300, "   lead  trail   ", "﻿bom", "a\tb\r\nc",
]


def check(text):
    ids, ends = ENCODER.encode(text)
    assert ids == LIBRARY.encode(text)
    assert len(ids) == len(ends) and (not text or ends[-1] == len(text.encode()))
    for piece, end in zip(LIBRARY.encode(text, return_type="proto").pieces, ends, strict=True):
        if piece.surface:
            assert piece.end == end


@pytest.mark.parametrize("text", CASES)
def test_ids_and_spans_equal_the_library(text):
    check(text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab e▁ \n\té日🙂Z9.,"), max_size=40))
def test_any_text(text):
    check(text)


def test_clearing_the_memory_changes_nothing(monkeypatch):
    import tidemark.llm.pieces as pieces

    monkeypatch.setattr(pieces, "REMEMBERED", 8)
    small = Encoder(MODEL)
    for text in ["one two three four", "five six seven eight nine ten", "one two"] * 2 + [" ".join(map(str, range(50)))]:
        assert small.encode(text)[0] == LIBRARY.encode(text)


def trie(keys):
    """A compiled map of single-byte chains, laid out with an offset of 256 for each node."""
    units, strings = [0] * (256 * 64), b""
    free = 1

    def place(node, children):
        nonlocal free
        base = free * 256
        free += 1
        offset = node ^ base
        units[node] |= offset << 10
        return base

    tree = {}
    for key, value in keys.items():
        at = tree
        for byte in key:
            at = at.setdefault(byte, {})
        at[None] = value
    stack = [(0, tree)]
    while stack:
        node, children = stack.pop()
        base = place(node, children)
        for byte, below in children.items():
            if byte is None:
                units[node] |= 0x100
                units[base] = 0x80000000 | len(strings)
                strings += below + b"\0"
            else:
                units[base ^ byte] |= byte
                stack.append((base ^ byte, below))
    return struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + strings


def spec(blob, dummy=1, squeeze=1, escape=1):
    out = b"\x12" + varint(len(blob)) + blob
    return out + bytes([0x18, dummy, 0x20, squeeze, 0x28, escape])


def varint(value):
    out = b""
    while value > 0x7F:
        out += bytes([value & 0x7F | 0x80])
        value >>= 7
    return out + bytes([value])


def test_character_map_takes_the_longest_prefix():
    blob = trie({b"a": b"x", b"ab": b"yy", "é".encode(): b"e", b"\t": b" "})
    found = CharacterMap(blob)
    assert found.longest(b"abc", 0) == (b"yy", 2)
    assert found.longest(b"ac", 0) == (b"x", 1)
    assert found.longest(b"c", 0) is None
    text, source = Normaliser(spec(blob, squeeze=0)).normalise("zabé\ta".encode())
    assert text.decode() == "▁zyye▁x"
    assert source == [0, 0, 0, 0, 1, 1, 3, 5, 5, 5, 6, 7]


def test_extra_spaces_are_squeezed_with_their_sources():
    text, source = Normaliser(spec(b"", squeeze=1)).normalise(b"  a  b ")
    assert text.decode() == "▁a▁b"
    assert source[3] == 2 and source[-2] == 5 and source[-1] == 6
    assert Normaliser(spec(b"", squeeze=1)).normalise(b"   ") == (b"", [3])


def test_tables(spark):
    texts = ["Hello  world", None, "", "Hello  world", "a " * 200_000, "日本\n語"]
    docs = spark.createDataFrame([(k, t, [1]) for k, t in enumerate(texts)], "doc_id long, text string, ids array<int>")
    rows = {r.doc_id: r for r in decode_ids(encode_texts(docs, MODEL), MODEL).collect()}
    for k, text in enumerate(texts):
        expected = LIBRARY.encode(text or "")
        assert rows[k].ids == expected and rows[k].decoded == LIBRARY.decode(expected)
        assert hashlib.sha256(rows[k].decoded.encode()).hexdigest()
    assert encode_texts(docs.limit(0), MODEL).count() == 0
    repeated = decode_ids(encode_texts(docs.unionAll(docs), MODEL), MODEL)
    assert repeated.count() == 2 * len(texts)
