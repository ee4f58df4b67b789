"""Near duplicates among embeddings by tiled comparison in the order of principal components.

Unit vectors are turned onto their principal axes, so leading dimensions carry
most of a product. Tiles of vectors that lie close on the first axis are
compared. Tiles beside each other are a strip, and a pair of strips is a task,
so a tile is sent once for each strip and not for each tile; pairs of strips are
dealt to rounds, of which each sends about as much as the table holds. Within a
pair of tiles the product over the leading dimensions plus the product of the
norms of the rest bounds the cosine from above, and a pair is dropped as soon
as the bound is below the threshold. What is left is decided by the cosine of
the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir, remove_folder, scratch_folder, shuffles_removed

from .components import components
from .unions import Sets

THRESHOLD = 0.95
# Vectors in a tile: a pair of tiles is compared at a time.
TILE = 2048
# Most tiles in a strip: a pair of strips is a task's work and memory.
STRIP = 32
# Bytes of vectors that a round sends: those of the table, but so many at least.
ROUND_BYTES = 1 << 28
# Dimensions after which the bound is tested.
STEPS = (16, 32)
# Rounding of the first axis; by it tiles that are just too far apart are compared all the same.
SLACK = 1e-6
_STRIP = 512

COUNTS = "code long, links long, least long"


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def valid(vector: str) -> Column:
    """Whether a vector can have a cosine: not null, not empty, all components finite, not all zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def principal_axes(vectors: DataFrame, dimension: int) -> np.ndarray:
    """Axes by falling variance, from the second moments of all unit vectors.

    Every task adds up its own rows; only ``dimension`` squared sums reach the driver.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension))
        for batch in batches:
            rows = _matrix(batch.column(0))
            rows /= np.linalg.norm(rows, axis=1, keepdims=True)
            total += rows.T @ rows
        cell = np.arange(dimension * dimension)
        yield pa.RecordBatch.from_pydict({"cell": cell, "value": total.ravel()[cell]})

    cells = vectors.select("vector").mapInArrow(sums, "cell long, value double")
    found = cells.groupBy("cell").agg(F.sum("value").alias("value")).collect()
    moments = np.zeros(dimension * dimension)
    for row in found:
        moments[row.cell] = row.value
    moments = moments.reshape(dimension, dimension)
    return np.linalg.eigh((moments + moments.T) / 2)[1][:, ::-1].copy()


def slack(dimensions: int) -> float:
    """What the bound over ``dimensions`` can lose by single precision; the decision is in double and not eased.

    Entries of unit vectors are rounded to 2^-24 of themselves, as are each
    product and sum: at most (dimensions + 3) * 2^-24 together, taken twice.
    """
    return (dimensions + 3) * 2.0**-23


class Side:
    """The vectors of one tile, turned onto the axes, with the norms of what each step leaves.

    A norm is taken from the entries left, not from what the others lack of one,
    which would cancel where these hold nearly everything; it is rounded up.
    """

    def __init__(self, codes: np.ndarray, weights: np.ndarray, vectors: np.ndarray, axes: np.ndarray):
        self.codes, self.weights = codes, weights
        self.vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        turned = self.vectors @ axes
        self.turned = turned.astype(np.float32)
        self.rest = {}
        for k in steps_of(axes.shape[0]):
            left = np.sqrt(np.einsum("ij,ij->i", turned[:, k:], turned[:, k:])).astype(np.float32)
            self.rest[k] = np.nextafter(left, np.float32(2))


def steps_of(dimension: int) -> list[int]:
    """The steps that are shorter than the vectors."""
    return [k for k in STEPS if k < dimension] or [dimension]


def compare(a: Side, b: Side, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two tiles whose cosine reaches the threshold; within one tile, each pair once."""
    steps = steps_of(a.turned.shape[1])
    first = steps[0]
    lead_a = np.hstack([a.turned[:, :first], a.rest[first][:, None]])
    lead_b = np.ascontiguousarray(np.hstack([b.turned[:, :first], b.rest[first][:, None]]).T)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(lead_a), _STRIP):
        i, j = np.nonzero(lead_a[at : at + _STRIP] @ lead_b >= threshold - slack(first + 1))
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for k in steps[1:]:
            bound = np.einsum("ij,ij->i", a.turned[i, :k], b.turned[j, :k]) + a.rest[k][i] * b.rest[k][j]
            near = bound >= threshold - slack(k + 1)
            i, j = i[near], j[near]
        for cut in range(0, len(i), 1 << 17):
            p, q = i[cut : cut + (1 << 17)], j[cut : cut + (1 << 17)]
            linked = np.einsum("ij,ij->i", a.vectors[p], b.vectors[q]) >= threshold
            left.append(p[linked])
            right.append(q[linked])
    return np.concatenate(left), np.concatenate(right)


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "vec_id",
    vector: str = "embedding",
    tile: int = TILE,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: all links of cosine at least ``threshold``.

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing; vectors are compared with those of their length. Equal vectors
    are one class that is compared once and counts for all its rows; a repeated
    id gives a row each, a null id one that is never ``kept`` and in no
    component's name. No rows, no result; other columns are ignored.

    Tiles meet by strips, and pairs of tiles that are too far apart on the first
    axis are left out. What leaves a pair of strips is one row for each linked
    class: how many rows it met and the smallest class it is connected with,
    never the pairs. The disk holds the vectors a few times, however many strips
    there are; the comparisons grow with the square of the rows.
    """
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    rows = vectors.select(F.col(f"`{id_column}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    checked = rows.withColumn("ok", valid("vector"))
    with shuffles_removed(spark):
        classes = (
            checked.where("ok")
            .groupBy("vector")
            .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("weight"))
            .withColumns({"dimension": F.size("vector"), "code": F.monotonically_increasing_id()})
            .checkpoint()
        )
        # Equal vectors lie together: the hot side of this join is split by Spark. What follows needs no vectors for the rows.
        keys = classes.select(F.when(F.col("dimension") > 0, F.col("vector")).alias("key"), "code")
        codes = checked.withColumn("key", F.when(F.col("ok"), F.col("vector"))).join(keys, "key", "left").select("vec_id", "code").checkpoint()
        counted = None
        for row in classes.select("dimension").distinct().orderBy("dimension").collect():  # one length, as a rule
            compared = classes.where(F.col("dimension") == row.dimension).select("code", "weight", "vector")
            some = _count_links(compared, principal_axes(compared, row.dimension), threshold, tile)
            counted = some if counted is None else counted.unionAll(some)
        counted = spark.createDataFrame([], COUNTS) if counted is None else counted
        roots = components(counted.select(F.col("code").alias("a"), F.col("least").alias("b")))
        met = counted.groupBy("code").agg(F.sum("links").alias("met"))
        placed = classes.select("code", "first_id", "weight").join(roots, F.col("code") == F.col("node"), "left")
        placed = placed.withColumn("root", F.coalesce("root", "code"))
        smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
        told = (
            placed.join(smallest, "root")
            .join(met, "code", "left")
            .select("code", "component_id", (F.col("weight") - 1 + F.coalesce("met", F.lit(0))).alias("links"))
            .checkpoint()
        )
    return codes.join(told, "code", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("long").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"),
    )


def _count_links(classes: DataFrame, axes: np.ndarray, threshold: float, tile: int) -> DataFrame:
    """``code``, ``links``, ``least``: partial sums for each pair of strips a class has links in."""
    spark = classes.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dimension = axes.shape[0]
    kind = "<f8" if "double" in classes.schema["vector"].dataType.simpleString() else "<f4"
    shared = spark.sparkContext.broadcast(axes)
    total = classes.count()
    tiles = max(1, -(-total // tile))
    # The first axis orders the vectors; cuts at its percentiles make tiles of like size.
    weights = F.array(*[F.lit(float(x)) for x in axes[:, 0]])
    lead = F.aggregate(F.zip_with("vector", weights, lambda x, w: x.cast("double") * w), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    placed = classes.withColumn("lead", lead / norm)
    cuts = placed.agg(F.percentile_approx("lead", [k / tiles for k in range(1, tiles)] or [0.5], 100 * tiles)).first()[0]
    bounds = np.unique(np.asarray(cuts if tiles > 1 and cuts else [], np.float64))

    @F.pandas_udf("int")
    def part(values):
        import pandas as pd

        return pd.Series(np.searchsorted(bounds, values.to_numpy(), "right")).astype("int32")

    def to_tiles(group: pa.Table) -> pa.Table:
        lead = group.column("lead").to_numpy()
        return pa.table({
            "tile": pa.array([group.column("tile")[0].as_py()], pa.int32()),
            "low": pa.array([float(lead.min())]), "high": pa.array([float(lead.max())]),
            "codes": pa.array([group.column("code").to_numpy().astype("<i8").tobytes()], pa.binary()),
            "weights": pa.array([group.column("weight").to_numpy().astype("<i8").tobytes()], pa.binary()),
            "vectors": pa.array([_matrix(group.column("vector")).astype(kind).tobytes()], pa.binary()),
        })

    # Equal leads can make a tile larger than meant; a second number splits it.
    split = placed.withColumn("tile", part("lead"))
    sizes = split.groupBy("tile").count()
    parts = F.ceil(F.col("count") / tile).cast("int")
    split = split.join(F.broadcast(sizes.withColumn("parts", parts)), "tile")  # one row for each tile
    split = split.withColumn("tile", F.col("tile") * F.lit(1 << 12) + F.pmod(F.xxhash64("code"), F.col("parts")).cast("int"))
    folder = scratch_folder(spark, "tiles")  # removed when all have met
    split.select("tile", "lead", "code", "weight", "vector").groupBy("tile").applyInArrow(
        to_tiles, "tile int, low double, high double, codes binary, weights binary, vectors binary"
    ).write.parquet(folder)
    packed = spark.read.parquet(folder)
    # |x1 - y1| of two unit vectors is at most the distance that the threshold allows.
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    spans = packed.select("low", "high", "tile").collect()  # three numbers for each tile
    strips, first, last = strips_of(np.array([r.low for r in spans]), np.array([r.high for r in spans]), reach, partitions)
    sent = int((last - first + 1)[strips].sum()) * total * dimension * np.dtype(kind).itemsize // len(spans)
    rounds = min(len(first), -(-sent // max(ROUND_BYTES, total * dimension * np.dtype(kind).itemsize)))
    places = [(row.tile, int(k), int(first[k]), int(last[k])) for row, k in zip(spans, strips, strict=True)]
    places = spark.createDataFrame(places, "tile int, strip int, first int, last int")
    meetings = places.select("tile", "strip", F.explode(F.sequence("first", "last")).alias("other")).select(
        "tile", "strip", F.least("strip", "other").alias("i"), F.greatest("strip", "other").alias("j")
    )

    def count(group: pa.Table) -> pa.Table:
        at = {name: group.column(name).to_numpy() for name in ("strip", "low", "high")}
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        codes = [np.frombuffer(raw.as_buffer(), "<i8") for raw in group.column("codes")]
        weights = [np.frombuffer(raw.as_buffer(), "<i8") for raw in group.column("weights")]
        begin = np.cumsum([0, *map(len, codes)])
        order = np.argsort(np.concatenate(codes))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        links, sets, sides = np.zeros(len(order), np.int64), Sets(len(order)), {}

        def side(k: int) -> Side:
            if k not in sides:
                values = np.frombuffer(group.column("vectors")[k].as_buffer(), kind).astype(np.float64).reshape(len(codes[k]), dimension)
                sides[k] = Side(codes[k], weights[k], values, shared.value)
            return sides[k]

        for p in np.flatnonzero(at["strip"] == i).tolist():
            for q in np.flatnonzero(at["strip"] == j).tolist():
                if i == j and q < p or at["low"][q] - at["high"][p] > reach or at["low"][p] - at["high"][q] > reach:
                    continue
                left, right = compare(side(p), side(q), threshold, p == q)
                if not len(left):
                    continue
                links[begin[p] : begin[p + 1]] += np.bincount(left, weights[q][right], len(codes[p])).astype(np.int64)
                links[begin[q] : begin[q + 1]] += np.bincount(right, weights[p][left], len(codes[q])).astype(np.int64)
                sets.join_all(rank[left + begin[p]], rank[right + begin[q]])
            if i != j:
                sides.pop(p, None)
        some = np.flatnonzero(links)
        codes = np.concatenate(codes)
        return pa.table({"code": codes[some], "links": links[some], "least": codes[order][sets.roots()[rank[some]]]})

    met = None
    for k in range(rounds):
        now = meetings.where(F.pmod(F.col("i") + F.col("j"), F.lit(rounds)) == k)
        tasks = max(1, min(len(first) ** 2, 4 * partitions))
        dealt = packed.join(F.broadcast(now), "tile").drop("tile").repartition(tasks, "i", "j")
        some = dealt.groupBy("i", "j").applyInArrow(count, COUNTS).checkpoint()
        met = some if met is None else met.unionAll(some)
    remove_folder(spark, folder)
    return met


def strips_of(low: np.ndarray, high: np.ndarray, reach: float, partitions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The strip of each tile, and the first and last strip that each strip has to meet.

    Tiles of a strip are neighbours on the first axis. All strips within reach lie
    between a strip's first and last; others may, if spans overlap.
    """
    n = max(-(-len(low) // STRIP), min(len(low), int(np.ceil(np.sqrt(8 * partitions)))))
    strips = np.empty(len(low), np.int64)
    strips[np.lexsort([high, low])] = np.arange(len(low)) * n // len(low)
    least, most = np.full(n, np.inf), np.full(n, -np.inf)
    np.minimum.at(least, strips, low)
    np.maximum.at(most, strips, high)
    first, last = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k in range(n):
        near = np.flatnonzero((least - most[k] <= reach) & (least[k] - most <= reach))
        first[k], last[k] = near[0], near[-1]
    return strips, first, last
