import numpy as np
import pytest

from tidemark.llm import embedding_dedup as ed
from tidemark.llm.unions import Sets


def brute(rows, threshold=0.95):
    good = {}
    for k, (_, vector) in enumerate(rows):
        if vector and all(x is not None and np.isfinite(x) for x in vector) and any(vector):
            unit = np.asarray(vector, np.float32).astype(float)
            good[k] = unit / np.linalg.norm(unit)
    links, unions = [0] * len(rows), Sets(len(rows))
    for a in good:
        for b in good:
            if a < b and len(good[a]) == len(good[b]):
                equal = rows[a][1] == rows[b][1]
                if equal or good[a] @ good[b] >= threshold:
                    links[a] += 1
                    links[b] += 1
                    unions.join(a, b)
    roots = [unions.find(k) for k in range(len(rows))]
    least = {}
    for root, (vec_id, _) in zip(roots, rows, strict=True):
        least[root] = min(least.get(root, vec_id), vec_id)
    return sorted((i, n, least[r], i == least[r]) for (i, _), r, n in zip(rows, roots, links, strict=True))


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS code", "'x' AS tile")


@pytest.mark.parametrize("tile", [16, 4096])
def test_equals_brute_force(spark, tile):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 48))
    vectors = [c + rng.normal(size=48) * rng.choice([0.0, 0.1, 0.2, 0.25, 0.4]) for c in centres for _ in range(20)]
    vectors += [v * 3 for v in vectors[:10]] + list(rng.normal(size=(60, 48)))
    rows = [(int(i), [float(np.float32(x)) for x in v]) for i, v in zip(rng.permutation(len(vectors)) * 3, vectors, strict=True)]
    nan, inf = float("nan"), float("inf")
    rows += [(9001, None), (9002, []), (9003, [0.0] * 48), (9004, [nan] * 48), (9005, [inf] + [1.0] * 47), (9006, [None] + [1.0] * 47)]
    rows += [(9100, rows[0][1]), (9101, rows[0][1]), (9200, [1.0, 2.0]), (9201, [2.0, 4.0]), (9202, [-2.0, 4.0])]
    found = ed.near_duplicates(table(spark, rows).repartition(4), tile=tile)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_small_tables(spark):
    for rows in ([], [(1, None)], [(1, [1.0])], [(1, [1.0, 1.0]), (1, [1.0, 1.0])], [(4, [1.0]), (2, [5.0]), (3, [-1.0])]):
        assert sorted(tuple(r) for r in ed.near_duplicates(table(spark, rows)).collect()) == brute(rows)


def test_bounds_drop_no_pair():
    rng = np.random.default_rng(6)
    base = rng.normal(size=(40, 64))
    vectors = np.concatenate([base + rng.normal(size=base.shape) * s for s in (0.05, 0.2, 0.3, 0.33)])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    axes = np.linalg.eigh(unit.T @ unit)[1][:, ::-1]
    side = ed.Side(np.arange(len(vectors)), np.ones(len(vectors), np.int64), vectors, axes)
    left, right = ed.compare(side, side, 0.95, True)
    expected = {(a, b) for a, b in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.95, 1)), strict=True)}
    assert set(zip(left.tolist(), right.tolist(), strict=True)) == expected


@pytest.mark.parametrize("rest", [1e-4, 1e-3, 3e-3])
def test_low_rank_vectors_at_the_threshold(rest):
    """Leading axes hold nearly all of a vector, and cosines lie within single precision of the threshold."""
    rng = np.random.default_rng(int(rest * 1e5))
    size, count = 64, 300
    angles = np.arccos(0.95) * rng.integers(0, 3, count) + rng.normal(size=count) * 2e-5
    vectors = np.zeros((count, size))
    vectors[:, 0], vectors[:, 1] = np.cos(angles), np.sin(angles)
    some = rng.random(count) < 0.5
    vectors[some, 2:] = rng.normal(size=(some.sum(), size - 2)) * rest / 8
    vectors = vectors.astype(np.float32).astype(np.float64)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    side = ed.Side(np.arange(count), np.ones(count, np.int64), vectors, np.eye(size))
    expected = {(a, b) for a, b in zip(*np.nonzero(np.triu(np.einsum("ik,jk->ij", unit, unit) >= 0.95, 1)), strict=True)}
    found = set(zip(*(x.tolist() for x in ed.compare(side, side, 0.95, True)), strict=True))
    differ = found ^ expected
    assert all(abs(unit[a] @ unit[b] - 0.95) < 1e-14 for a, b in differ) and len(expected) > 1000


def test_doubles_and_two_vectors_of_one_id(spark):
    """Vectors that differ only beyond single precision are told apart, and links of one id's vectors are not added up."""
    fine = [1.0, 0.328684105, 0.0]
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, fine), (3, [1.0, 0.3286841051, 0.0]), (4, [0.0, 0.9999, 0.001])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(tuple(r) for r in ed.near_duplicates(docs).collect())
    exact = lambda x, y: np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95
    links = [sum(exact(a, b) for j, (_, b) in enumerate(rows) if j != i) for i, (_, a) in enumerate(rows)]
    assert sorted((r[0], r[1]) for r in found) == sorted((i, n) for (i, _), n in zip(rows, links, strict=True))
    assert all(r[2] == 1 for r in found if r[0] in (1, 4))


@pytest.mark.parametrize("limits", [{}, {"STRIP": 2}, {"STRIP": 3, "ROUND_BYTES": 64}])
def test_strips_meet_in_rounds(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(ed, name, value)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(10, 24))
    vectors = [c + rng.normal(size=24) * rng.choice([0.0, 0.1, 0.2]) for c in centres for _ in range(12)] + list(rng.normal(size=(40, 24)))
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(vectors)] + [(500, None), (501, [2.0, 1.0]), (502, [4.0, 2.0])]
    sent = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # so that strips are as large as they may be
    try:
        found = ed.near_duplicates(table(spark, rows).repartition(4), tile=4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", sent)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_a_tile_is_sent_once_for_each_strip():
    """What is sent grows with the strips, not with the tiles; strips hold neighbours, and none within reach is left out."""
    rng = np.random.default_rng(2)
    low = rng.permutation(np.linspace(-1, 1, 640))
    high = low + rng.choice([0.0, 0.004, 0.3], 640)
    strips, first, last = ed.strips_of(low, high, 0.1, 12)
    assert len(first) == 20 and np.bincount(strips).max() == ed.STRIP
    assert (last - first + 1)[strips].max() <= 20
    near = (low[:, None] - high[None] <= 0.1) & (low[None] - high[:, None] <= 0.1)
    a, b = np.nonzero(near)
    assert ((first[strips[a]] <= strips[b]) & (strips[b] <= last[strips[a]])).all()
