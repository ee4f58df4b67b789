import math

import numpy as np
import pytest

from tidemark.llm import queries
from tidemark.llm import whitening as wh


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 AS n", "'x' AS whitened", "2 AS length")


def found(spark, rows, kind="float"):
    vectors = table(spark, rows, kind).repartition(3)
    return wh.whiten(vectors, wh.fit_whitening(vectors)).collect()


def vectors_of(seed, count, size):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(size, size)) * np.linspace(0.05, 1, size)
    return (rng.normal(size=(count, size)) @ mix / 4).astype(np.float32).astype(float)


@pytest.mark.parametrize("count,size", [(300, 64), (90, 20)])
def test_equals_brute_force(spark, count, size):
    values = vectors_of(count, count, size)
    rows = [(k, v.tolist()) for k, v in enumerate(values)]
    nan, inf = float("nan"), float("inf")
    bad = [(9000, None), (9001, []), (9002, [nan] * size), (9003, [inf] + [0.0] * (size - 1)), (9004, [None] * size)]
    rows += [(5, rows[6][1]), (None, rows[7][1])]
    got = found(spark, rows + bad)
    x = np.floor(64 * np.array([v for _, v in rows])).astype(object) + 1_000_000
    n, total = len(rows), x.sum(axis=0)
    spread = ((n * x - total) ** 2).sum(axis=1)
    away = np.array([[float(n * c - s) / n for c, s in zip(row, total, strict=True)] for row in x])
    matrix = away.T @ away / n
    values, axes = np.linalg.eigh(matrix)
    values, axes = values[::-1][:32], axes[:, ::-1][:, :32]
    projected = away @ axes / np.sqrt(values)
    key = lambda r: (repr(r[0]), r[1])
    ours = sorted(((r.vec_id, int(r.deviation), r.whitened, r.explained) for r in got), key=key)
    theirs = sorted(((i, int(d), w) for (i, _), d, w in zip(rows, spread, projected, strict=True)), key=key)
    assert [r[:2] for r in ours] == [r[:2] for r in theirs]
    mine, other = np.array([r[2] for r in ours]), np.array([r[2] for r in theirs])
    signs = np.sign((mine * other).sum(axis=0))
    assert np.abs(mine * signs - other).max() < 1e-8
    assert np.allclose(ours[0][3], values / np.trace(matrix), rtol=1e-9)
    assert {r.n for r in got} == {n} and got[0].identity_error < 1e-9


def test_sums_of_pairs_are_exact():
    rng = np.random.default_rng(2)
    for largest in (100, wh.LARGEST):  # the second needs more than 64 bits
        z = rng.integers(-largest, largest, (50, 9))
        z -= z.sum(axis=0) // 50  # as centring on whole numbers leaves it
        big = z.astype(object)
        rest, squares = big.sum(axis=0).tolist(), wh.pair_squares(z)
        assert squares == [int(((big[:, i] + (big[:, j] if j > i else 0)) ** 2).sum()) for i in range(9) for j in range(i, 9)]
        exact = [[(50 * (big[:, i] * big[:, j]).sum() - rest[i] * rest[j]) / 2500 for j in range(9)] for i in range(9)]
        assert np.array_equal(wh.covariance(50, squares, rest), np.array(exact, float))
    model = wh.Whitening(50, np.zeros(9, np.int64), rest, np.eye(9), np.ones(9), np.ones(9))
    assert model.deviations(z) == [sum((50 * v - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in z.tolist()]


def test_small_and_degenerate_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, [])]) == []
    alone = found(spark, [(1, [0.5, -0.25])])[0]
    assert (alone.n, int(alone.deviation), alone.whitened, alone.explained, alone.identity_error) == (1, 0, [None] * 2, [0.0] * 2, 0.0)
    rows = [(k, [float(k), 2.0 * k, 1.0]) for k in range(8)]
    for row in found(spark, rows):  # one direction only
        assert math.isclose(abs(row.whitened[0]), abs(row.vec_id - 3.5) / math.sqrt(5.25), rel_tol=1e-9)
        assert row.whitened[1:] == [None, None] and math.isclose(row.explained[0], 1.0)
        assert row.identity_error < 1e-9
    huge = found(spark, [(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [0.0, 1.0])], "double")
    assert len(huge) == 3 and huge[0].identity_error < 1e-4
    both = found(spark, rows + [(50 + k, [float(k % 3), float(k)]) for k in range(9)])
    assert sorted({(len(r.whitened), r.n) for r in both}) == [(2, 9), (3, 8)]


def test_query(spark):
    rows = queries.QUERIES["op13_embedding_whitening"](spark, "/root/testdata/sf0.001")
    assert rows.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(rows.dtypes)["deviation"] == "bigint" and rows.count() == 500 * 32
