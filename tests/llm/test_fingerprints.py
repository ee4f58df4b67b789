import hashlib

import numpy as np

from tidemark.llm import fingerprints
from tidemark.llm.fingerprints import Parse, edited_text, fingerprint_chain, likeness, signature, to_text, phrase_hashes


def phrases(text):
    known, phrase = [], ""
    for char in text:
        phrase += char
        if phrase not in known:
            known.append(phrase)
            phrase = ""
    return known


def brute(text):
    found = phrases(text)
    least = signature(phrase_hashes(found)) if found else np.full(64, 2**64 - 1, np.uint64)
    return (least >> np.uint64(32)).astype(np.uint32)


def test_parse_in_parts_equals_the_whole():
    text = "abracadabra é🙂 abracadabra " * 5
    for cut in (0, 1, 7, 50, len(text)):
        parse = Parse(text[:cut])
        fork = parse.fork().read("something else")
        assert (parse.read(text[cut:]).fingerprint() == brute(text)).all()
        assert (fork.fingerprint() == brute(text[:cut] + "something else")).all()
    assert phrases("aababc") == ["a", "ab", "abc"]


def test_likeness_follows_the_jaccard_similarity():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]
    text = " ".join(words)
    changed = " ".join(w if k % 20 else "zzzzz" for k, w in enumerate(words))
    other = " ".join("".join(rng.choice(list("qrstuvwx"), 5)) for _ in range(400))
    a, b, c = brute(text), brute(changed), brute(other)
    both, either = set(phrases(text)) & set(phrases(changed)), set(phrases(text)) | set(phrases(changed))
    assert abs(likeness(a, b) - len(both) / len(either)) < 0.2
    assert likeness(a, a) == 1 and likeness(a, b) > likeness(a, c)


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    out = []
    for k, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        edited = edited_text(text, following)
        out.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), to_text(brute(text)), to_text(brute(edited)),
            likeness(brute(text), brute(edited)), likeness(brute(text), brute(following)),
        ))
    return sorted(out, key=str)


def test_chain_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(int(k), "".join(rng.choice(list("ab cdé🙂"), rng.integers(0, 90)))) for k in rng.permutation(3000)[:150]]
    rows += [(9000, None), (9001, ""), (-5, "x"), (9002, "long " * 40_000), (9003, rows[0][1])]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, part string").repartition(5)
    assert sorted((tuple(r) for r in fingerprint_chain(docs).collect()), key=str) == expected(rows)


def test_small_and_odd_tables(spark):
    for rows in ([], [(1, "abc")], [(1, "abc"), (1, "abc")], [(2, "abcd"), (1, "wxyz")], [(None, "a b"), (3, "c d")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert sorted((tuple(r) for r in fingerprint_chain(docs).collect()), key=str) == expected(rows) if rows else True
        assert fingerprint_chain(docs).count() == len(rows)


def test_new_dictionaries_do_not_depend_on_cuts(monkeypatch):
    """Small constants: texts of many dictionaries and blocks, read whole or in parts, have one fingerprint."""
    monkeypatch.setattr(fingerprints, "DICTIONARY", 37)
    monkeypatch.setattr(fingerprints, "BLOCK", 64)
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcdé "), 3000))
    whole = Parse(text).fingerprint()
    for cut in (1, 63, 64, 65, 1000, 2999):
        parse = Parse(text[:cut])
        assert (parse.fork().read(text[cut:]).fingerprint() == whole).all()
        assert (parse.read(text[cut:]).fingerprint() == whole).all()
    assert (whole != brute(text)).any()
