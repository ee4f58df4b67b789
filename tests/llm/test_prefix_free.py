import random

import numpy as np
import pytest

from tidemark.llm import prefix_free as pf


def order_of(strings):
    corpus = pf.Corpus(strings)
    places = np.concatenate([s + np.arange(n) for s, n in zip(corpus.starts, corpus.sizes, strict=True)]) if strings else np.zeros(0, np.int64)
    owner = np.searchsorted(corpus.starts, places, "right") - 1
    ordered = corpus.ordered(places.astype(np.int64))
    owner = np.searchsorted(corpus.starts, ordered, "right") - 1
    return corpus, ordered, [strings[k][p - corpus.starts[k] :] for k, p in zip(owner, ordered, strict=True)]


@pytest.mark.parametrize("alphabet", [b"ab", b"\0\1\xff", b"a", bytes(range(256))])
@pytest.mark.parametrize("seed", range(4))
def test_suffixes_are_sorted(alphabet, seed):
    rng = random.Random(seed)
    base = bytes(rng.choices(alphabet, k=300))
    strings = [bytes(rng.choices(alphabet, k=rng.randint(0, 90))) for _ in range(30)]
    strings += [base[rng.randint(0, 200) :][: rng.randint(1, 100)] for _ in range(30)]
    corpus, ordered, suffixes = order_of(strings)
    assert suffixes == sorted(suffixes)
    deep = np.array([len(s) >= 20 for s in suffixes])
    same = corpus.repeats(ordered[deep], 20)
    kept = [s[:20] for s in suffixes if len(s) >= 20]
    assert same.tolist() == [k > 0 and kept[k] == kept[k - 1] for k in range(len(kept))]


def test_no_strings():
    for strings in ([], [b""], [b"", b"a", b""]):
        assert order_of(strings)[2] == sorted(s for s in strings if s)
