import re
from itertools import islice

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import components as cc
from tidemark.llm import jaccard_join as jj
from tidemark.llm.components import components
from tidemark.llm.unions import Sets
from tidemark.llm.words import word_hashes

UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(UPPER))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def brute(rows, percent=90, width=3):
    """All pairs; rows are nodes, a component's id is its smallest known one."""
    sets = [shingles(text, width) for _, text in rows]
    links, unions = [0] * len(rows), Sets(len(rows))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                unions.join(a, b)
    roots = [unions.find(k) for k in range(len(rows))]
    least = {}
    for root, (doc_id, _) in zip(roots, rows, strict=True):
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    return sorted(((i, len(s), least.get(r), n) for (i, _), s, r, n in zip(rows, sets, roots, links, strict=True)), key=str)


def corpus(seed=3, bases=12, copies=14):
    """Texts with near copies of all degrees, exact copies, shared passages and odd texts."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdefg"), 3))
    passage = " ".join(word() for _ in range(60))
    texts = []
    for _ in range(bases):
        base = [word() for _ in range(int(rng.integers(3, 160)))]
        for _ in range(copies):
            own = list(base)
            for _ in range(int(rng.integers(0, 4))):
                own[int(rng.integers(len(own)))] = word()
            texts.append(" ".join(own) + (" " + passage if rng.random() < 0.2 else ""))
    texts += [texts[0].upper(), texts[0].replace(" ", "\n\t "), "", None, "one", "ONE", "one two", "two one", "one one one one", " \n"]
    return [(int(k) * 7 % 1009, text) for k, text in zip(rng.permutation(len(texts)), texts, strict=True)]


@pytest.mark.parametrize(("percent", "width", "short"), [(90, 3, 32), (80, 5, 2), (90, 3, 1)])
def test_equals_brute_force(spark, monkeypatch, percent, width, short):
    monkeypatch.setattr(jj, "SHORT_LIST", short)
    monkeypatch.setattr(jj, "LEAST_BLOCK", 4 if short < 3 else 64)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "'x' AS token").repartition(3)
    found = jj.jaccard_join(docs, percent, width)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, percent, width)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(5, text), (5, text), (5, "other words are here"), (None, text), (None, None), (None, "lone text of words"), (3, text + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in jj.jaccard_join(docs).collect()), key=str) == brute(rows)
    assert jj.jaccard_join(docs.limit(0)).count() == 0
    assert jj.jaccard_join(docs.where("text IS NULL")).collect()[0].n_links == 0


def test_long_texts(spark):
    text = " ".join(f"w{k * k % 70001}" for k in range(60_000))
    rows = [(1, text), (2, text.replace("w4 ", "zz ")), (3, "x" * 3_000_000), (4, "a " * 1_000_000)]
    found = {r.doc_id: r for r in jj.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[k].component_id for k in (1, 2, 3, 4)] == [1, 1, 3, 4]
    assert found[1].n_shingles == len(shingles(text)) and found[3].n_shingles == found[4].n_shingles == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=25, unique=True), min_size=1, max_size=25), st.integers(40, 95))
def test_prefixes_lose_no_pair(lists, percent):
    sets = [np.unique(np.array(s, np.uint64)) for s in lists]
    expected = {
        (a, b)
        for a in range(len(sets))
        for b in range(a + 1, len(sets))
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= percent * len(np.union1d(sets[a], sets[b]))
    }
    left, right = jj.similar_pairs(sets, np.zeros(len(sets), int), percent)
    assert set(zip(left.tolist(), right.tolist(), strict=True)) == expected
    side = np.arange(len(sets)) % 2
    left, right = jj.similar_pairs(sets, side, percent)
    crossed = {(min(p), max(p)) for p in zip(left.tolist(), right.tolist(), strict=True)}
    if len(sets) > 1:
        assert crossed == {(a, b) for a, b in expected if side[a] != side[b]}


def test_dear_lists_lengthen_the_prefix():
    assert jj.chosen_shared(np.ones(100), 100, 90) == 1
    assert jj.chosen_shared(np.full(100, 5000.0), 100, 90) > 3


def test_words_in_pieces(monkeypatch):
    import tidemark.llm.words as words

    texts = ["a bb  ccc\n" * 50, "", " ", "x" * 500, "é日 本\x0b z", "A a"]
    whole = word_hashes(texts)
    monkeypatch.setattr(words, "PIECE", 37)
    cut = word_hashes(texts)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    assert whole[1].tolist() == np.cumsum([0, 150, 0, 0, 1, 3, 2]).tolist() and whole[0][-1] == whole[0][-2] == whole[0][0]


@pytest.mark.parametrize("text", ["a " + "x" * 3_000_000, " " + "x" * 3_000_000, "a \n b" + "\t " * 900_000 + "x" * 2_000_000 + " a", " " * 3_000_000])
def test_a_word_longer_than_a_piece_after_white_space(text):
    import tidemark.llm.words as words

    pieces = list(islice(words._pieces(["b", text, "c"]), 20))
    assert len(pieces) < 20 and pieces[-1][1][-1] == 2
    hashes, offsets = word_hashes(["b", text, "c"])
    parts = text.split()
    assert offsets.tolist() == [0, 1, 1 + len(parts), 2 + len(parts)]
    assert hashes[1:-1].tolist() == [int(word_hashes([part])[0][0]) for part in parts]


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(300, 400)] + [(5, 5), (400, 399), (2, 7), (2, 7)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(found[k] == 100 for k in range(101, 161)) and all(found[k] == 2 for k in [7, *range(300, 401)])
    assert len(found) == 60 + 102
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("limits", [{"HOT": 2}, {"NODE_BITS": 3}, {"BUCKET_TOKENS": 40, "SENT": 50, "SEEN": 2, "TOKEN_BITS": 8}])
def test_chance_meetings_hot_tokens_and_small_blocks_lose_no_link(spark, monkeypatch, limits):
    for name, value in limits.items():
        assert value < getattr(jj, name)
        monkeypatch.setattr(jj, name, value)
    rows = corpus(seed=5, bases=4, copies=8)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = jj.jaccard_join(docs, 80, 5)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, 80, 5)


def test_long_lists_met_by_chance_make_no_large_group(spark, monkeypatch):
    """With more tokens than the sketch can order, prefixes hold tokens of long lists, by which texts must not gather."""
    monkeypatch.setattr(jj, "SKETCH", 256)
    monkeypatch.setattr(jj, "SHORT_LIST", 4)
    rng = np.random.default_rng(8)
    rows = []
    for k in range(200):
        words = [f"own{k}x{j}" for j in range(400)] + [f"common{j}" for j in rng.choice(1200, 40, replace=False)]
        rows.append((k, " ".join(rng.permutation(words))))
    rows += [(1000 + k, rows[k][1].replace("x7 ", "y ")) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sketch = jj._count_tokens(docs, 1)
    groups = jj._groups(jj._index(docs, sketch, 90, 1), sketch, 90).groupBy("root").count().collect()
    assert groups and max(row["count"] for row in groups) < 5
    assert sorted((tuple(r) for r in jj.jaccard_join(docs, 90, 1).collect()), key=str) == brute(rows, 90, 1)


def test_large_groups_meet_in_rounds(spark, monkeypatch):
    for name, value in {"ROUND_TOKENS": 500, "ROUND_PART": 1 << 20, "TASK_TOKENS": 200, "LEAST_BLOCK": 4}.items():
        monkeypatch.setattr(jj, name, value)
    rows = corpus(seed=6, bases=3, copies=16)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    found = jj.jaccard_join(docs, 80, 5)
    assert spark.conf.get(setting, None) == before
    for _ in range(2):
        assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, 80, 5)


def test_entries_come_back_from_their_blocks():
    token, node, size, at = (np.arange(k, 900 + k) * 7**k % 65_537 for k in range(4))
    sent = jj._sent(token % 4, token + (1 << 40), node, size, at)
    assert sent.column("bucket").to_pylist() == [0, 1, 2, 3]
    back = [jj._received(sent.slice(k, 1), 4) for k in range(4)]
    told = sorted(zip(*np.concatenate(back, axis=1).tolist(), strict=True))
    assert told == sorted(zip((token + (1 << 40)).tolist(), node.tolist(), size.tolist(), at.tolist(), strict=True))


def test_stars_need_no_round(spark, monkeypatch):
    def large_star(edges):
        raise AssertionError("a round")

    monkeypatch.setattr(cc, "_large_star", large_star)
    edges = [(9, 1), (1, 8), (7, 2), (7, 2), (3, 3)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(tuple(r) for r in found.collect()) == [(7, 2), (8, 1), (9, 1)]
    with pytest.raises(AssertionError, match="a round"):
        components(spark.createDataFrame([(3, 2), (2, 1)], "a long, b long"))
