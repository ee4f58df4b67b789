"""Clusters around centroids, found by equal-average equal-variance search.

Vectors and centroids are whole numbers. Centroids lie sorted by the mean of
their components. A vector starts at its own mean and looks outward on both
sides. With ``s`` the sum of the components, ``v`` the norm of the deviations
from the mean and ``d`` the dimension, the squared distance is at least
``(s_x - s_c)^2 / d``, which ends the search, since means only get further
away, and at least that plus ``(v_x - v_c)^2``, which passes over a centroid.
What is left is decided by the exact distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .whitening import usable, whole_numbers

DIMENSION = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED = "3"
# Whole numbers are held to this magnitude (components of 65,536), so that a distance fits 64 bits.
LARGEST = 1 << 26
# Share by which the bounds, which are not exact, are eased.
SLACK = 1e-9
_ROWS = 4096


class Searcher:
    """Centroids in the order of their means."""

    def __init__(self, centroids: np.ndarray):
        self.sums = centroids.sum(axis=1)
        self.order = np.lexsort([np.arange(len(centroids)), self.sums])
        self.sums = self.sums[self.order]
        self.sorted = centroids[self.order]
        self.spreads = _spread(self.sorted)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each row's nearest centroid; equal distances go to the smaller number."""
        count, size = self.sorted.shape
        sums, spreads = x.sum(axis=1), _spread(x)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(len(x), np.iinfo(np.int64).max)
        number = np.full(len(x), count, np.int64)
        active = np.arange(len(x))
        while len(active):
            lo, hi = left[active], right[active]
            away_lo = np.where(lo >= 0, (sums[active] - self.sums[np.maximum(lo, 0)]).astype(float), np.inf)
            away_hi = np.where(hi < count, (self.sums[np.minimum(hi, count - 1)] - sums[active]).astype(float), np.inf)
            use_lo = away_lo <= away_hi
            by_mean = np.minimum(away_lo, away_hi) ** 2 / size
            going = by_mean * (1 - SLACK) <= best[active]  # beyond this means are only further away
            active, use_lo, by_mean = active[going], use_lo[going], by_mean[going]
            place = np.where(use_lo, left[active], right[active])
            left[active[use_lo]] -= 1
            right[active[~use_lo]] += 1
            bound = by_mean + (spreads[active] - self.spreads[place]) ** 2
            error = SLACK * (by_mean + spreads[active] ** 2 + self.spreads[place] ** 2)
            close = bound - error <= best[active]
            rows, place = active[close], place[close]
            gap = x[rows] - self.sorted[place]
            distance = np.einsum("ij,ij->i", gap, gap)
            named = self.order[place]
            wins = (distance < best[rows]) | ((distance == best[rows]) & (named < number[rows]))
            best[rows[wins]], number[rows[wins]] = distance[wins], named[wins]
        return number, best


def _spread(x: np.ndarray) -> np.ndarray:
    """Norm of each row's deviations from its mean."""
    away = x - x.mean(axis=1, keepdims=True)
    return np.sqrt(np.einsum("ij,ij->i", away, away))


def kept_vectors(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector of the rows that take part."""
    rows = vectors.select(F.col(f"`{id_column}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    return rows.where(usable("vector") & (F.size("vector") == DIMENSION))


def first_centroids(kept: DataFrame, count: int, seed: str) -> np.ndarray:
    """The vectors whose ids have the smallest hashes; null ids come last, equal ids by their components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(digest.asc_nulls_last(), "vector").limit(count).select("vector").collect()
    return _rows(pa.array([row.vector for row in rows], pa.list_(pa.float64()))) if rows else np.zeros((0, DIMENSION), np.int64)


def _rows(column: pa.Array) -> np.ndarray:
    return whole_numbers(column, SCALE, 0, LARGEST)


def _totals(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """For every cluster: rows, sum of distances, sums of components; added up in the tasks first."""
    width = DIMENSION + 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher, totals = Searcher(centroids), np.zeros((len(centroids), width), object)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                x = _rows(batch.column(0).slice(at, _ROWS))
                number, distance = searcher.nearest(x)
                for k in np.unique(number):
                    here = number == k
                    # Distances of one slice can exceed 64 bits together.
                    far = sum(distance[here].tolist())
                    totals[k] += np.array([int(here.sum()), far, *x[here].sum(axis=0).tolist()], object)
        flat = totals.ravel().tolist()
        yield pa.RecordBatch.from_pydict({
            "cell": pa.array(range(len(flat)), pa.int32()),
            "value": pa.array(flat, pa.decimal128(38, 0)),
        })

    added = kept.select("vector").mapInArrow(work, "cell int, value decimal(38,0)")
    found = np.zeros(len(centroids) * width, object)
    for row in added.groupBy("cell").agg(F.sum("value").alias("value")).collect():  # clusters times dimension
        found[row.cell] = int(row.value)
    return found.reshape(len(centroids), width)


def fit_centroids(
    vectors: DataFrame,
    count: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: str = SEED,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> np.ndarray:
    """Centroids after ``rounds`` of assignment and exact floored means; an empty cluster keeps its centroid.

    Every round reads the vectors once; only the sums of the clusters reach the
    driver. Fewer vectors than centroids give as many centroids as vectors.
    """
    kept = kept_vectors(vectors, id_column, vector)
    centroids = first_centroids(kept, count, seed)
    for _ in range(rounds if len(centroids) else 0):
        totals = _totals(kept, centroids)
        fresh = [[s // row[0] for s in row[2:]] if row[0] else old for row, old in zip(totals.tolist(), centroids.tolist(), strict=True)]
        if fresh == centroids.tolist():
            break  # later rounds would find the same
        centroids = np.array(fresh, np.int64)
    return centroids


def assign(
    vectors: DataFrame, centroids: np.ndarray, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every vector that takes part.

    Vectors that are null, of another length, or hold null or non-finite
    components are left out. Components beyond 65,536 count as that bound. A
    null or repeated id gives a row like any other; no rows, no result; other
    columns are ignored. Inertias beyond 64 bits are null.
    """
    kept = kept_vectors(vectors, id_column, vector)
    id_type = kept.schema["vec_id"].dataType.simpleString()
    inertias = [int(v) for v in _totals(kept, centroids)[:, 1]] if len(centroids) else []
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
    fitting = [v if v < 1 << 63 else None for v in [*inertias, sum(inertias)]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(centroids) if len(centroids) else None
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                number, distance = searcher.nearest(_rows(part.column(1)))
                places = pa.array(number)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(number.astype(np.int32)),
                        pa.array(distance),
                        pa.array(fitting[:-1], pa.int64()).take(places),
                        pa.array([fitting[-1]] * len(number), pa.int64()),
                        pa.array(digests).take(places),
                    ],
                    names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    return kept.mapInArrow(
        work,
        f"vec_id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string",
    )


def centroid_sql(count: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> str:
    """The same clusters in SQL: every distance in full, one pair of steps for each round."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x
  FROM embeddings
  WHERE len(embedding) = {DIMENSION} AND len([c FOR c IN embedding IF c IS NOT NULL AND isfinite(c)]) = {DIMENSION}
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS k, x FROM (
    SELECT x, sha256('{seed}:' || vec_id) AS h FROM kept ORDER BY h LIMIT {count})
)""",
    ]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT r, min_by(k, (distance, k)) AS k, min(distance) AS distance FROM (
    SELECT v.r, c.k, CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v.x, c.x)]) AS BIGINT) AS distance
    FROM kept v CROSS JOIN c{n} c)
  GROUP BY r
)""")
        if n < rounds:
            steps.append(f"""c{n + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN (
    SELECT k, list(value ORDER BY place) AS x FROM (
      SELECT k, place, CAST((sum(value) - ((sum(value) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS value FROM (
        SELECT a.k, unnest(v.x) AS value, unnest(range({DIMENSION})) AS place FROM a{n} a JOIN kept v USING (r))
      GROUP BY k, place)
    GROUP BY k) m USING (k)
)""")
    return f"""
WITH {", ".join(steps)}
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, a.distance,
  CAST(sum(a.distance) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept v USING (r) JOIN c{rounds} c ON c.k = a.k"""
