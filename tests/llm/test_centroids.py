import hashlib

import numpy as np
import pytest

from tidemark.llm import centroids as ce


def brute(rows, count=8, rounds=10, seed="3"):
    kept = [(i, [int(np.floor(1024 * float(np.float32(c)))) for c in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(c is not None and np.isfinite(c) for c in v)]
    digest = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    centres = [x for _, x in sorted(kept, key=lambda r: (r[0] is None, digest(r[0]), r[1]))[:count]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        centres = [[sum(col) // len(col) for col in zip(*groups[k], strict=True)] if k in groups else c for k, c in enumerate(centres)]
    found = [(i, *nearest(x)) for i, x in kept]
    total = {}
    for _, d, k in found:
        total[k] = total.get(k, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, k, d, total[k], sum(total.values()), sha[k]) for i, d, k in found), key=repr)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS cluster", "1L AS distance")


def clusters(spark, rows):
    vectors = table(spark, rows).repartition(3)
    return sorted((tuple(r) for r in ce.assign(vectors, ce.fit_centroids(vectors)).collect()), key=repr)


@pytest.mark.parametrize("scale", [0.02, 0.2, 3.0])
def test_equals_brute_force(spark, scale):
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(5, 64))
    rows = [(int(k), [float(np.float32(c)) for c in middle[k % 5] * scale + rng.normal(size=64) * 0.1]) for k in range(200)]
    rows += [(300 + k, rows[7][1]) for k in range(40)] + [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1])]
    nan, inf = float("nan"), float("inf")
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [nan] + [1.0] * 63), (904, [inf] + [1.0] * 63), (905, [None] + [1.0] * 63)]
    assert clusters(spark, rows) == brute(rows)


def test_small_tables(spark):
    one = [0.5] * 64
    for rows in ([], [(1, None)], [(1, one)], [(k, one) for k in range(20)], [(1, one), (2, [-0.5] * 64)]):
        assert clusters(spark, rows) == brute(rows)


def test_search_equals_all_distances():
    rng = np.random.default_rng(4)
    for size in (1, 4):  # few values: many ties
        x, c = rng.integers(-size, size + 1, (500, 64)), rng.integers(-size, size + 1, (13, 64))
        c[5] = c[3]
        number, distance = ce.Searcher(c).nearest(x)
        full = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        assert (distance == full.min(axis=1)).all()
        assert (number == full.argmin(axis=1)).all()
    far = np.full((2, 64), ce.LARGEST) * np.array([[1], [-1]])
    assert ce.Searcher(far).nearest(far[::-1])[0].tolist() == [1, 0]
    assert ce.Searcher(far[:1]).nearest(far[1:])[1].tolist() == [64 * (2 * ce.LARGEST) ** 2]
