import random

import pytest

from tidemark.llm import repeats as rp


def brute(rows, depth=50):
    texts = [((float("inf") if i is None else i), i, (t or "").encode()) for i, t in rows]
    least = {}
    for key, _, raw in texts:
        for at in range(len(raw) - depth + 1):
            part = raw[at : at + depth]
            least[part] = min(least.get(part, key), key)
    found = []
    for key, doc_id, raw in texts:
        gone = [False] * len(raw)
        for at in range(len(raw) - depth + 1):
            if least[raw[at : at + depth]] < key:
                gone[at : at + depth] = [True] * depth
        edges = [k for k in range(len(raw) + 1) if (k < len(raw) and gone[k]) != (k > 0 and gone[k - 1])]
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        found.append((doc_id, len(raw), list(zip(edges[::2], edges[1::2], strict=True)), kept))
    return sorted(found, key=repr)


def removed(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS chunk", "'x' AS kept", "2 AS bucket")
    found = rp.remove_repeats(docs.repartition(3), **options).collect()
    return sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.removed], bytes(r.kept)) for r in found), key=repr)


def texts_of(rng, alphabet):
    word = lambda: "".join(rng.choices(alphabet, k=rng.randint(1, 9)))
    shared = [" ".join(word() for _ in range(rng.randint(5, 60))) for _ in range(6)]
    rows = []
    for _ in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            cut = rng.randint(0, 20)
            parts += [passage[cut : len(passage) - rng.randint(0, 20)], word()]
        rows.append("".join(parts))
    return rows


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghijklmnop", "aé漢🙂\0"])
@pytest.mark.parametrize("sizes", [{}, {"chunk": 700, "bucket": 300}])
def test_equals_brute_force(spark, monkeypatch, alphabet, sizes):
    if sizes:
        monkeypatch.setattr(rp, "SLICE", 997)
        monkeypatch.setattr(rp, "PORTION", 64)
    rng = random.Random(str(alphabet) + str(sizes))
    texts = texts_of(rng, alphabet)
    rows = list(zip(rng.sample(range(-50, 400), len(texts)), texts, strict=True))
    rows += [(500, texts[3]), (500, texts[3]), (500, texts[4] + "x" * 60), (501, "x" * 300), (502, "x" * 49), (503, "y" * 50)]
    rows += [(None, texts[5]), (None, "z" * 80), (None, "z" * 90), (600, None), (601, ""), (504, "y" * 50), (505, "ab" * 400)]
    assert removed(spark, rows, **sizes) == brute(rows)


def test_other_depths_and_small_tables(spark):
    rng = random.Random(1)
    rows = list(enumerate(texts_of(rng, "abc")[:25]))
    for depth in (8, 16, 17, 31):
        assert removed(spark, rows, depth=depth) == brute(rows, depth)
    for rows in ([], [(1, None)], [(1, ""), (2, "")], [(2, "q" * 50), (1, "q" * 50)]):
        assert removed(spark, rows) == brute(rows)


def test_long_text(spark):
    rng = random.Random(2)
    text = "".join(rng.choices("abcdefgh ", k=3_000_000))
    found = removed(spark, [(1, text), (2, "tail " + text[1_000_000:1_600_000] + "!"), (3, "a" * 2_000_000), (4, text)])
    spans = {r[0]: r[2] for r in found}
    assert spans[1] == [] and spans[3] == [] and spans[4] == [(0, 3_000_000)]
    assert len(spans[2]) == 1 and spans[2][0][0] in (4, 5) and spans[2][0][1] in (600_005, 600_006)


def test_a_common_passage_spreads(spark, monkeypatch):
    """A passage in most documents: its grams are common, and its neighbourhoods go to triggers of their own."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=6))
    passage = " ".join(word() for _ in range(20))
    rows = [(k, " ".join(word() for _ in range(9)) + passage + " ".join(word() for _ in range(9))) for k in range(120)]
    monkeypatch.setattr(rp, "COMMON", 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    chunks = rp.chunked(docs, "doc_id", "text", rp.CHUNK).collect()
    chunk = rp.Chunk(chunks[0].asDict())
    values, times = chunk.common_grams(50)
    grams = {passage[k : k + rp.GRAM].encode() for k in range(len(passage) - rp.GRAM + 1)}
    hashed = {int(rp._hashes(rp.np.frombuffer(g, rp.np.uint8), rp.GRAM)[0]) for g in grams}
    assert hashed <= set(values.tolist()) and (times >= 30).all()
    plain, told = chunk.runs(50, rp.Grams(rp._NONE)), chunk.runs(50, rp.Grams(values))
    busiest = lambda runs: max(len({chunk.raw[s : s + n + 49] for t, s, n in zip(*runs[:3]) if t == v}) for v in set(runs[0].tolist()))
    assert busiest(plain) > 60 and busiest(told) < 20
    assert removed(spark, rows) == brute(rows)


def test_repeats_within_a_chunk_do_not_travel(spark):
    rows = [(k, "the same text of some length in every document, and more of it") for k in (5, 3, 9, 3, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    chunks = spark.createDataFrame(rp.chunked(docs, "doc_id", "text", rp.CHUNK).collect())
    shared = spark.createDataFrame([], "bucket int, chunk long, bits binary")
    sent = rp._phrases(chunks, shared, 1, 50, rp.Grams(rp._NONE)).collect()
    raw = rp._unpack(bytes(sent[0].phrases))
    n = int.from_bytes(raw[:8], "little")
    assert len(sent) == 1 and set(rp.np.frombuffer(raw, rp.np.int64, n, 8).tolist()) == {3} and sent[0].known is not None
    assert removed(spark, rows) == brute(rows)
