"""Best-fit packing of documents into bins under conflicts.

A bin holds at most one document of a source and at most one of a duplicate
cluster. Documents are dealt to shards by a hash; each shard is packed by
decreasing size. Its bins stand in the order of their residual space and carry
bitmaps of the sources and clusters inside; from the tightest bin that has room
the search goes on to its successors until one is compatible.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import shuffles_removed

from .components import components
from .jaccard_join import linked_rows

CAPACITY = 2048
# Pieces in one shard: packing one is a task's work, and the loss from half-full bins is a few bins in each.
SHARD = 4096
# Near copies share four fifths of their five-word shingles.
PERCENT, WIDTH = 80, 5

RESULT = "bin_id long, doc_id long, piece long, start_word long, n_words long, source string, cluster long"
_ARROW = pa.schema([
    ("bin_id", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int64()), ("start_word", pa.int64()),
    ("n_words", pa.int64()), ("source", pa.string()), ("cluster", pa.int64()),
])


def pack(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """The bin of each item; items come in packing order, None conflicts with nothing."""
    source_bit = {key: 1 << k for k, key in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    cluster_bit = {key: 1 << k for k, key in enumerate(dict.fromkeys(c for c in clusters if c is not None))}
    space: list[tuple[int, int]] = []  # residual and number of every bin, ascending
    held: list[list[int]] = []
    bins = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        a, b = source_bit.get(source, 0), cluster_bit.get(cluster, 0)
        at = bisect_left(space, (size, -1))
        while at < len(space) and (held[space[at][1]][0] & a or held[space[at][1]][1] & b):
            at += 1
        if at < len(space):
            residual, number = space.pop(at)
        else:
            residual, number = capacity, len(held)
            held.append([0, 0])
        held[number][0] |= a
        held[number][1] |= b
        insort(space, (residual - size, number))
        bins.append(number)
    return bins


def pack_documents(
    items: DataFrame,
    capacity: int = CAPACITY,
    shard: int = SHARD,
    id_column: str = "doc_id",
    size: str = "n_words",
    source: str = "source",
    cluster: str = "cluster",
) -> DataFrame:
    """Place every item: bin_id, doc_id, piece, start_word, n_words, source, cluster.

    An item larger than ``capacity`` is cut into pieces of it, which lie in
    different bins, as they share a cluster; null size counts as 0, null source
    or cluster conflicts with nothing (pieces of one item still do). Repeated
    rows are placed each. Other columns are ignored; no items, no rows.

    One small shuffle of ids and sizes, no texts. The number of shards follows
    the number of pieces, which is the only figure that reaches the driver; a
    shard is dealt by a hash of id, piece and cluster, so neither a hot source
    nor a large cluster gathers in one.
    """
    rows = items.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.greatest(F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)), F.lit(0)).alias("size"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.col(f"`{cluster}`").cast("long").alias("cluster"),
    )
    whole = rows.withColumn("pieces", F.greatest(F.ceil(F.col("size") / capacity), F.lit(1)))
    total = whole.agg(F.sum("pieces")).first()[0] or 0
    shards = max(1, -(-int(total) // shard))
    pieces = whole.select("doc_id", "size", "source", "cluster", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    dealt = pieces.select(
        F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(shards)).alias("shard"),
        "doc_id",
        F.col("piece").cast("long").alias("piece"),
        (F.col("piece") * capacity).cast("long").alias("start_word"),
        F.least(F.col("size") - F.col("piece") * capacity, F.lit(capacity)).cast("long").alias("n_words"),
        "source",
        "cluster",
    )

    def place(group: pa.Table) -> pa.Table:
        group = group.sort_by([("n_words", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        at = {name: group.column(name).to_pylist() for name in group.column_names}
        # Pieces of an item without a cluster must not meet either.
        groups = [
            c if c is not None else (f"doc {d}" if d is not None and n > 0 else None)
            for c, d, n in zip(at["cluster"], at["doc_id"], at["piece"], strict=True)
        ]
        bins = pack(at["n_words"], at["source"], groups, capacity)
        number = [(shard_no << 32) + k for shard_no, k in zip(at["shard"], bins, strict=True)]
        columns = [pa.array(number, pa.int64()), *[group.column(f.name).cast(f.type) for f in _ARROW if f.name != "bin_id"]]
        return pa.Table.from_arrays(columns, schema=_ARROW)

    return dealt.groupBy("shard").applyInArrow(place, RESULT)


def sized_documents(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", source: str = "source", *keep: str
) -> DataFrame:
    """Items of a table of texts: words between white space, and equal word sequences as one cluster.

    Null and empty texts have no words and no cluster. Columns named in ``keep`` stay.
    """
    words = F.filter(F.split(F.lower(F.col(f"`{text}`")), "[\\x20\\x09-\\x0D]+"), lambda word: word != "")
    return docs.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), words.alias("words"), *keep
    ).select(
        "doc_id",
        "source",
        F.coalesce(F.size("words"), F.lit(0)).alias("n_words"),
        F.when(F.size("words") > 0, F.xxhash64("words")).alias("cluster"),
        *keep,
    )


def clustered_documents(
    docs: DataFrame,
    percent: int = PERCENT,
    width: int = WIDTH,
    text: str = "text",
    id_column: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """Items of a table of texts whose clusters are the components of near copies.

    Near copies share ``percent`` hundredths of their ``width``-word shingles of
    lower-case words; equal word sequences always do. A row with a null id is
    known by its text's hash instead, so it is in a cluster as well. If rows of
    one id are in several clusters, these are one. Null and empty texts have no
    words and no cluster. Words are counted where the join hashes them.
    """
    low, own = F.lower(F.col(f"`{text}`")), F.col(f"`{id_column}`")
    known = F.coalesce(own.cast("long"), F.xxhash64(low))
    docs = docs.select(known.alias("doc_id"), low.alias("text"), own.alias("own_id"), F.col(f"`{source}`").alias("source"))
    with shuffles_removed(docs.sparkSession):
        rows = linked_rows(docs, percent, width).drop("n_links").checkpoint()
        placed = rows.where("n_shingles > 0")
        first = placed.groupBy("doc_id").agg(F.min("component_id").alias("first"), F.max("component_id").alias("last")).where("first < last")
        several = placed.join(first, "doc_id").where("component_id <> first")
        roots = components(several.select(F.col("component_id").alias("a"), F.col("first").alias("b"))).toDF("component_id", "root")
        cluster = F.when(F.col("n_words") > 0, F.coalesce("root", "component_id")).alias("cluster")
        found = rows.join(roots, "component_id", "left").select(F.col("own_id").alias("doc_id"), "source", "n_words", cluster)
        return found.checkpoint()
