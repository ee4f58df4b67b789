import zlib

import numpy as np
import pytest

from tidemark.llm import quality, toxicity
from tidemark.llm.batches import table
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def held(doc_id, parts, fold):
    return zlib.crc32(str(doc_id).encode()) % parts == fold


@pytest.mark.parametrize(
    ("name", "label", "parts", "fold", "misses", "alarms"),
    [("op4_quality_classifier", "quality", 5, 0, 0.02, 0.05), ("op9_toxicity", "toxic", 4, 2, 0.15, 0.02)],
)
def test_held_out_accuracy_on_the_given_tables(spark, name, label, parts, fold, misses, alarms):
    found = {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}
    docs = table(spark, SF, "documents").count()
    assert len(found) == docs
    assert all(r.held_out == held(r.doc_id, parts, fold) and 0 <= r.score <= 1 for r in found.values())
    assert all(r.predicted == (r.score >= 0.3) for r in found.values())
    labels = [(r.doc_id, r[label]) for r in table(spark, SF, "labels").collect() if found[r.doc_id].held_out]
    ones = [found[i].predicted for i, y in labels if y == 1]
    zeros = [found[i].predicted for i, y in labels if y == 0]
    assert 1 - np.mean(ones) <= misses and np.mean(zeros) <= alarms


WORDS = "the of river stone and to light house in a tree with over field".split()


def texts(seed, n, bad):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        words = list(rng.choice(WORDS, int(rng.integers(5, 120))))
        if k % 2:
            for _ in range(1 + len(words) // 30):
                words[int(rng.integers(len(words)))] = str(rng.choice(bad))
        out.append(" ".join(words))
    return out


def test_unseen_spellings_share_subwords():
    known = texts(1, 600, ["gloopish", "gloopy", "gloopster"])
    model = toxicity.train(known, np.arange(600) % 2)
    scorer = toxicity.Scorer(model)
    words = model.word_scores(["gloopling", "xgloop", *WORDS])
    assert words[:2].min() > words[2:].max()
    unseen = [scorer.score(text) for text in texts(2, 200, ["gloopling", "gloopicious"])]
    assert np.mean(unseen[1::2]) > 5 * np.mean(unseen[0::2])
    long_text = " ".join(WORDS * 3000)
    assert scorer.score(long_text) < 0.3 < scorer.score(long_text + " gloopish gloopy gloopster")
    assert 0 < scorer.score("") < 0.6  # the share of toxic texts in training
    again = toxicity.Model.from_bytes(model.to_bytes())
    assert toxicity.Scorer(again).score(known[1]) == pytest.approx(scorer.score(known[1]))


def test_a_small_memory_changes_nothing(monkeypatch):
    model = toxicity.train(texts(1, 60, ["gloop"]), np.arange(60) % 2)
    plain = [toxicity.Scorer(model).score(text) for text in texts(3, 20, ["gloop"])]
    monkeypatch.setattr(toxicity, "REMEMBERED", 3)
    monkeypatch.setattr(toxicity, "_BLOCK", 50)
    scorer = toxicity.Scorer(model)
    assert [scorer.score(text) for text in texts(3, 20, ["gloop"])] == pytest.approx(plain)


def test_quality_features_do_not_depend_on_pieces(monkeypatch):
    text = "A tree. of THE stone!! " * 40
    whole = quality.features(text)
    assert np.isclose((whole[1] ** 2).sum(), 3)
    model = quality.train(["good words in a line", "BAD!! BAD!! BAD!!"] * 20, np.array([1, 0] * 20))
    assert model.score("more words of a line") > 0.5 > model.score("WORSE!! WORSE!! WORSE!!")
    assert 0 <= model.score("") <= 1
    again = quality.Model.from_bytes(model.to_bytes())
    assert again.score(text) == pytest.approx(model.score(text), abs=1e-6)
    monkeypatch.setattr(quality, "PIECE", 64)
    cut = quality.features(text)
    # Only n-grams across a cut are missing.
    assert len(np.setdiff1d(cut[0], whole[0])) == 0 and len(cut[0]) >= len(whole[0]) - 8


@pytest.mark.parametrize(("fit", "score", "label"), [
    (toxicity.fit_toxicity, toxicity.score_toxicity, "toxic"), (quality.fit_quality, quality.score_quality, "quality"),
])
def test_odd_tables(spark, fit, score, label):
    rows = [(1, "some words", 0.5), (2, None, 1.0), (None, "", 2.0), (4, "w " * 300_000, 3.0), (1, "some words", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, SCORE double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (4, 0), (77, 1)], f"doc_id long, {label} int")
    for known in (labels, labels.limit(0)):
        found = score(docs, fit(docs, known))
        assert found.columns == ["doc_id", "text", "score"]
        got = found.collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 1}) == 1
        assert len({r.score for r in got if not r.text}) == 1
    assert score(docs.limit(0), fit(docs.limit(0), labels)).count() == 0


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    docs = spark.createDataFrame([(k, f"word{k} stays") for k in range(200)], "doc_id long, text string")
    one = docs.selectExpr("doc_id", "int(doc_id % 2) AS toxic")
    other = one.selectExpr("doc_id", "IF(crc32(CAST(string(doc_id) AS BINARY)) % 4 = 2, 1 - toxic, toxic) AS toxic")
    assert toxicity.fit_toxicity(docs, one) == toxicity.fit_toxicity(docs, other)
