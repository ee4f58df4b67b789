"""Jaccard self-join of word n-gram sets by adaptive multi-match prefixes.

The tokens of a set stand in one global order, rare ones first. If two sets are
similar enough to share ``alpha`` tokens, then their prefixes that leave out all
but the last ``alpha - l`` tokens share at least ``l`` of them. Each document
chooses its own ``l``: a longer prefix costs more index entries, but a pair must
then share more of it before it is looked at any further. For two documents the
smaller of their two ``l`` is required.

The join runs in three steps, all linear in the index:

1. The longest prefixes are indexed in buckets of tokens, the lists' lengths go
   back to the documents, and each chooses its prefix by them: tokens of long
   lists come last in the order, so a document passes over them while its
   longest prefix has other tokens to put in their place. Pairs in short lists
   are counted and kept if they share enough. A document without enough tokens
   of short lists is linked to its long lists' tokens, and with it whoever has
   such a token. Components of these links are groups that hold every similar
   pair. Entries travel as blocks of bytes, a row for a task and bucket.
2. The sets of grouped documents are sent to their group: small groups are put
   together, large ones are cut into blocks and every pair of blocks is a task.
   Where large groups send their sets more often than the disk should hold at a
   time, pairs of blocks are dealt to rounds.
3. A task indexes prefixes again, with lengths chosen by the true lists, and
   verifies what shares enough by exact intersection. What leaves it is a count
   of links and one connected node for each document, never the pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tidemark.session import ensure_checkpoint_dir, shuffles_removed

from .batches import TEXT_ROWS, texts_of
from .components import components
from .unions import Sets
from .words import mix, word_hashes

PERCENT = 90
WIDTH = 3
# Counters of the token sketch; it only orders tokens, so its size changes cost and never the result.
SKETCH = 1 << 21
_STEP, _FIRST = np.uint64(0x9E3779B97F4A7C15), np.ones(1, bool)
_SLICES = 256
# Largest number of prefix tokens that a pair may be asked to share.
MOST_SHARED = 8
# Cost of an index entry and of a candidate, in steps along a list; outside a task a candidate sends two texts.
ENTRY, CANDIDATE = 8.0, 1000.0
TASK_CANDIDATE = 64.0
# Lists up to this length give pairs, so pairs are at most 16 times the entries; longer ones may link to their token.
SHORT_LIST = 32
# Of a prefix, the share that is indexed besides, to be taken in place of tokens whose lists prove long.
SPARE = 8
# Tokens of the table for one bucket of entries, and entries that a task sends at a time.
BUCKET_TOKENS = 1 << 20
SENT = 1 << 20
# A token counted this often, and 16 times as often as others, is a long list without being brought together.
HOT = 1 << 18
# Bits of tokens and classes that groups are found by: what falls together by chance only adds to what is verified.
TOKEN_BITS, NODE_BITS = 48, 40
# Added to a token to stand for it among classes.
_HUB = 1 << 60
# Bytes of an entry's token, node and size, and of the two figures that follow.
_WIDTHS = (6, 5, 4, 4, 4)
# Classes whose prefixes a task remembers having sent.
SEEN = 1 << 20
# Tokens that small groups share a task with, and documents in a block of a large group.
TASK_TOKENS = 1 << 20
BLOCK = 1024
LEAST_BLOCK = 64
# Tokens that pairs of blocks are sent in a round: this part of the table's tokens, but so many at least.
ROUND_PART, ROUND_TOKENS = 4, 1 << 26


def shingle_sets(texts: list[str], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word n-grams; a text of fewer words is one n-gram."""
    return _sets(*word_hashes(texts), width)


def _sets(words: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sets of texts whose words begin at ``offsets``."""
    grams = words
    sets = []
    with np.errstate(over="ignore"):
        for k in range(1, width):
            grams = grams[: max(len(words) - k, 0)] * _STEP
            grams += words[k:]
        grams = mix(grams)
        for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if end - begin >= width:
                found = grams[begin : end - width + 1]
                found.sort()
                sets.append(found[np.concatenate([_FIRST, found[1:] != found[:-1]])])
            else:  # marked by its length, so that it equals no longer n-gram
                one = words[begin:end]
                joined = one[:1]
                for word in one[1:]:
                    joined = mix(joined * np.uint64(3) + word)
                sets.append(mix(joined ^ np.uint64(len(one) << 32 | 0xA5A5)))
    return sets


def least_shared(size: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Tokens that a set of ``size`` must share with any similar set."""
    return (percent * size + 99) // 100


def most_shared(size: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Tokens that the longest indexed prefix of a set of ``size`` must share with that of any similar set."""
    alpha = least_shared(size, percent)
    return np.minimum(alpha, MOST_SHARED + (size - alpha) // SPARE)


def chosen_shared(lists: np.ndarray, size: int, percent: int) -> int:
    """How many prefix tokens to require, by the least estimated cost.

    ``lists`` are the lengths of the lists of the tokens in order. A
    candidate is met in at least as many lists as are required, so the steps
    divided by that number bound the candidates.
    """
    alpha = int(least_shared(size, percent))
    most = min(MOST_SHARED, alpha)
    shared = np.arange(1, most + 1)
    length = size - alpha + shared
    steps = np.cumsum(np.maximum(lists[: length[-1]] - 1, 0))[length - 1]
    return int(shared[np.argmin(ENTRY * shared + steps + TASK_CANDIDATE * steps / shared)])


def _count_tokens(docs: DataFrame, width: int) -> np.ndarray:
    """Approximate document counts of all tokens: counters summed over the whole table."""
    per_slice = SKETCH // _SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(SKETCH, np.int64), [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, TEXT_ROWS):
                found = shingle_sets(texts_of(batch.slice(at, TEXT_ROWS), "text"), width)
                held += found
                size += sum(map(len, found))
                if size >= SKETCH:
                    total += np.bincount((np.concatenate(held) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
                    held, size = [], 0
        if held:
            total += np.bincount((np.concatenate(held) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
        for k in range(_SLICES):
            part = total[k * per_slice : (k + 1) * per_slice]
            if part.any():
                least = np.min_scalar_type(int(part.max()))
                yield pa.RecordBatch.from_pydict({
                    "slice": pa.array([k], pa.int32()), "kind": [least.itemsize], "counts": [part.astype(least).tobytes()],
                })

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(per_slice, np.uint64)
        for kind, raw in zip(group.column("kind").to_pylist(), group.column("counts"), strict=True):
            total += np.frombuffer(raw.as_buffer(), f"u{kind}")
        counts = np.minimum(total, np.iinfo(np.uint32).max).astype("<u4").tobytes()
        return pa.table({"slice": group.column("slice").slice(0, 1), "counts": pa.array([counts], pa.binary())})

    parts = docs.select("text").mapInArrow(count, "slice int, kind long, counts binary")
    sketch = np.zeros(SKETCH, np.uint32)
    for row in parts.groupBy("slice").applyInArrow(add, "slice int, counts binary").collect():
        sketch[row.slice * per_slice : (row.slice + 1) * per_slice] = np.frombuffer(row.counts, "<u4")
    return sketch


def _index(docs: DataFrame, sketch: np.ndarray, percent: int, width: int) -> DataFrame:
    """One row for each document: its words, its set's size and class, and the longest prefix it may be indexed by.

    All columns but the text stay. A task gives the prefix of a class once.
    """
    shared_sketch = docs.sparkSession.sparkContext.broadcast(sketch)
    kept = [name for name in docs.columns if name != "text"]
    names = [*kept, "n_words", "n_shingles", "node", "prefix"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = shared_sketch.value, set()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXT_ROWS):
                part = batch.slice(at, TEXT_ROWS)
                words, offsets = word_hashes(texts_of(part, "text"))
                sizes, nodes, prefixes = [], [], []
                for tokens in _sets(words, offsets, width):
                    node = class_of(tokens) if len(tokens) else None
                    sizes.append(len(tokens))
                    nodes.append(node)
                    prefixes.append(None)
                    if node is None or node in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(node)
                    order = np.argsort(counts[(tokens % np.uint64(SKETCH)).astype(np.int64)], kind="stable")
                    alpha = int(least_shared(len(tokens), percent))
                    length = len(tokens) - alpha + int(most_shared(len(tokens), percent))
                    prefixes[-1] = tokens[order[:length]].astype("<u8").view(np.uint8).reshape(-1, 8)[:, : TOKEN_BITS // 8].tobytes()
                found = [
                    pa.array(np.diff(offsets), pa.int64()), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                    pa.array(prefixes, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([*[part.column(name) for name in kept], *found], names=names)

    added = [StructField(name, LongType()) for name in ("n_words", "n_shingles", "node")]
    return docs.mapInArrow(work, StructType([*[docs.schema[name] for name in kept], *added, StructField("prefix", BinaryType())]))


def class_of(tokens: np.ndarray) -> int:
    """64 bits that stand for a set."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "big", signed=True)


def _sent(bucket: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket: its entries' bytes of one rank after another, so that equal ones lie together."""
    order = np.argsort(bucket, kind="stable")
    buckets, begin = np.unique(bucket[order], return_index=True)
    cuts = [*begin.tolist(), len(order)]
    planes = np.concatenate(
        [c[order].astype("<i8").view(np.uint8).reshape(-1, 8)[:, :n] for c, n in zip(columns, _WIDTHS, strict=False)], axis=1
    )
    blocks = [planes[x:y].T.tobytes() for x, y in pairwise(cuts)]
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(blocks, pa.binary())], names=["bucket", "entries"])


def _received(group: pa.Table, n_columns: int) -> list[np.ndarray]:
    """The columns of a bucket's entries."""
    widths = _WIDTHS[:n_columns]
    planes = [np.frombuffer(raw.as_buffer(), np.uint8).reshape(sum(widths), -1) for raw in group.column("entries")]
    planes, columns, at = np.concatenate(planes, axis=1), [], 0
    for n in widths:
        column = np.zeros((planes.shape[1], 8), np.uint8)
        column[:, :n] = planes[at : at + n].T
        columns.append(column.view("<i8").ravel())
        at += n
    return columns


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _pairs_of_lists(entries: list[np.ndarray], starts: np.ndarray, lengths: np.ndarray, percent: int) -> list[np.ndarray]:
    """``a``, ``b``, how often they meet and how often they must, for all pairs of each list."""
    _, node, size, shared = entries
    found = [np.zeros((0, 4), np.int64)]
    for length in np.unique(lengths).tolist():
        i, j = np.triu_indices(length, 1)
        some = starts[lengths == length]
        a, b = (some[:, None] + i).ravel(), (some[:, None] + j).ravel()
        like = (100 * np.minimum(size[a], size[b]) >= percent * np.maximum(size[a], size[b])) & (node[a] != node[b])
        a, b = a[like], b[like]
        required = np.minimum(shared[a], shared[b])
        found.append(np.stack([np.minimum(node[a], node[b]), np.maximum(node[a], node[b]), np.ones(len(a), np.int64), required], 1))
    a, b, met, required = np.concatenate(found).T
    order = np.lexsort((b, a))
    a, b, met, required = a[order], b[order], met[order], required[order]
    at = _starts(a, b)
    return [a[at], b[at], np.add.reduceat(met, at), np.minimum.reduceat(required, at)] if len(at) else [a, b, met, required]


def _groups(indexed: DataFrame, sketch: np.ndarray, percent: int) -> DataFrame:
    """``short``, ``root``: components of the pairs that share enough of their prefixes, and of the long lists that are needed."""
    partitions = int(indexed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, int(sketch.sum(dtype=np.int64)) // BUCKET_TOKENS)
    # Tokens of these counters are in lists too long to be brought together; they are told by the bucket's number.
    hot = np.flatnonzero(sketch >= max(HOT, 16 * int(sketch.mean())))
    blocks = "bucket long, entries binary"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def flush() -> pa.RecordBatch:
            token, node, size, at = (np.concatenate(c) for c in zip(*held, strict=True))
            bucket = token % buckets
            if len(hot):
                bucket = np.where(np.isin(token % SKETCH, hot), buckets + node % buckets, bucket)
            return _sent(bucket, token, node, size, at)

        for batch in batches:
            prefixes = batch.column("prefix").to_pylist()
            lengths = np.array([len(raw) * 8 // TOKEN_BITS for raw in prefixes], np.int64)
            for cut in range(0, len(prefixes), TEXT_ROWS):
                n = lengths[cut : cut + TEXT_ROWS]
                token = np.zeros((n.sum(), 8), np.uint8)
                token[:, : TOKEN_BITS // 8] = np.frombuffer(b"".join(prefixes[cut : cut + TEXT_ROWS]), np.uint8).reshape(-1, TOKEN_BITS // 8)
                node = batch.column("node").slice(cut, TEXT_ROWS).to_numpy() & ((1 << NODE_BITS) - 1)
                size = batch.column("n_shingles").slice(cut, TEXT_ROWS).to_numpy()
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                held.append((token.view("<i8").ravel(), np.repeat(node, n), np.repeat(size, n), at))
                count += len(at)
                if count >= SENT:
                    yield flush()
                    held, count = [], 0
        if count:
            yield flush()

    def list_up(group: pa.Table) -> pa.Table:
        """Entries of tokens that several classes have, with their lists' lengths, to their classes' buckets."""
        entries = _received(group, 4)
        if group.column("bucket")[0].as_py() >= buckets:
            lengths = np.full(len(entries[0]), HOT)
        else:
            order = np.argsort(entries[0])
            begin = _starts(entries[0][order])
            several = order[np.repeat(np.diff(np.append(begin, len(order))) > 1, np.diff(np.append(begin, len(order))))]
            entries = [c[several] for c in entries]
            order = np.lexsort(entries[::-1])
            entries = [c[order] for c in entries]
            once = _starts(*entries)  # copies that other tasks have sent
            entries = [c[once] for c in entries]
            begin = _starts(entries[0])
            lengths = np.diff(np.append(begin, len(entries[0])))
            lengths = np.repeat(lengths, lengths)
            entries = [c[lengths > 1] for c in entries]
            lengths = lengths[lengths > 1]
        return pa.Table.from_batches([_sent(entries[1] % buckets, *entries, lengths)])

    def choose(group: pa.Table) -> pa.Table:
        """Every class weighs its prefixes by the true lengths of their lists, and sends the entries of the best one.

        In the order by which a class is known tokens of long lists come last,
        which is the same for all classes as a token's list is. Of a class with
        too many of them no whole prefix is known: it sends all its entries,
        with a mark at those of long lists, where partners may have to be met.
        """
        entries = _received(group, 5)
        order = np.lexsort([entries[k] for k in (0, 3, 2, 1)])
        entries = [c[order] for c in entries]
        once = _starts(*entries)
        token, node, size, at, length = (c[once] for c in entries)
        begin = _starts(node, size)
        if not len(begin):
            return pa.Table.from_batches([_sent(token, token, node, size, at)])
        per_class = np.diff(np.append(begin, len(node)))
        long = length > SHORT_LIST
        before = np.cumsum(long) - long
        rank = at - before + np.repeat(before[begin], per_class)
        most = most_shared(size[begin], percent) - np.add.reduceat(long.astype(np.int64), begin)
        spared = size - least_shared(size, percent)
        costs = []
        for k in range(1, MOST_SHARED + 1):
            steps = np.add.reduceat(np.where(~long & (rank < spared + k), length - 1, 0), begin)
            costs.append(np.where(most >= k, ENTRY * k + steps * (1 + CANDIDATE / k), np.inf))
        shared = np.repeat(np.argmin(costs, axis=0) + 1, per_class)
        taken = long | (rank < spared + shared)
        bucket = np.where(long, buckets + node % buckets, token % buckets)
        figure = np.where(long, np.repeat(most < 1, per_class), shared)
        return pa.Table.from_batches([_sent(*(c[taken] for c in (bucket, token, node, size, figure)))])

    def pair(group: pa.Table) -> pa.Table:
        entries = _received(group, 4)
        if group.column("bucket")[0].as_py() >= buckets:
            token, node, _, mark = entries
            columns = [node, token + _HUB, mark, np.zeros(len(node), np.int64)]
        else:
            order = np.argsort(entries[0], kind="stable")
            entries = [c[order] for c in entries]
            begin = _starts(entries[0])
            columns = _pairs_of_lists(entries, begin, np.diff(np.append(begin, len(order))), percent)
        return pa.table(dict(zip(("a", "b", "met", "required"), columns, strict=True)))

    sent = indexed.where("prefix IS NOT NULL").select("node", "n_shingles", "prefix").mapInArrow(send, blocks)
    listed = sent.groupBy("bucket").applyInArrow(list_up, blocks)
    chosen = listed.groupBy("bucket").applyInArrow(choose, blocks)
    met = chosen.groupBy("bucket").applyInArrow(pair, "a long, b long, met long, required long")
    pairs = met.groupBy("a", "b").agg(F.sum("met").alias("met"), F.min("required").alias("required")).where("met >= required").checkpoint()
    long = pairs.where(F.col("b") >= _HUB)
    links = pairs.where(F.col("b") < _HUB).unionByName(long.join(long.where("met > 0").select("b"), "b", "left_semi"))
    return components(links.select("a", "b")).where(F.col("node") < _HUB).withColumnsRenamed({"node": "short"})


class _Documents:
    """Sets of a task's documents over a local numbering of tokens, rare ones first."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        tokens, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(tokens), np.int64)
        order = np.argsort(counts, kind="stable")
        rank[order] = np.arange(len(tokens))
        counts = counts[order]
        cuts = np.cumsum([len(s) for s in sets])[:-1]
        self.sets = [np.sort(part) for part in np.split(rank[inverse], cuts)]
        self.sizes = np.array([len(s) for s in sets])
        self.vocabulary = len(tokens)
        self.shared = np.array([chosen_shared(counts[s], len(s), percent) for s in self.sets])
        length = self.sizes - least_shared(self.sizes, percent) + self.shared
        self.prefixes = [s[:n] for s, n in zip(self.sets, length, strict=True)]


def similar_pairs(sets: list[np.ndarray], side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of similar sets, each once; between sides 0 and 1 if both are there, else all."""
    docs = _Documents(sets, percent)
    cross = len(np.unique(side)) > 1
    token = np.concatenate(docs.prefixes)
    owner = np.repeat(np.arange(len(sets)), [len(p) for p in docs.prefixes])
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    begin = np.searchsorted(token, np.arange(docs.vocabulary + 1))
    flat = np.concatenate(docs.sets)
    starts = np.cumsum(docs.sizes) - docs.sizes
    marked = np.zeros(docs.vocabulary, bool)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, prefix in enumerate(docs.prefixes):
        if cross and side[k]:
            continue
        lists = prefix[begin[prefix + 1] - begin[prefix] > 1]
        if not len(lists):
            continue
        hits = np.concatenate([owner[begin[t] : begin[t + 1]] for t in lists.tolist()])
        hits = hits[side[hits] == 1] if cross else hits[hits > k]
        if not len(hits):
            continue
        found, met = np.unique(hits, return_counts=True)
        enough = met >= np.minimum(docs.shared[k], docs.shared[found])
        small, large = np.minimum(docs.sizes[k], docs.sizes[found]), np.maximum(docs.sizes[k], docs.sizes[found])
        found = found[enough & (100 * small >= percent * large)]
        if not len(found):
            continue
        marked[docs.sets[k]] = True
        for cut in range(0, len(found), 1024):
            some = found[cut : cut + 1024]
            sizes = docs.sizes[some]
            ends = np.cumsum(sizes)
            pick = np.arange(ends[-1]) + np.repeat(starts[some] - (ends - sizes), sizes)
            both = np.add.reduceat(marked[flat[pick]].astype(np.int64), ends - sizes)
            linked = some[100 * both >= percent * (docs.sizes[k] + sizes - both)]
            left.append(np.full(len(linked), k))
            right.append(linked)
        marked[docs.sets[k]] = False
    return np.concatenate(left), np.concatenate(right)


def _verify(docs: DataFrame, nodes: DataFrame, roots: DataFrame, total: int, percent: int, width: int) -> DataFrame:
    """``node``, ``links``, ``least``: partial sums of verified links for each task a node takes part in.

    ``total`` is the number of tokens of the table, by which rounds are made.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nodes = nodes.withColumn("short", F.col("node").bitwiseAND(F.lit((1 << NODE_BITS) - 1)))
    grouped = nodes.join(roots.unionAll(roots.select(F.col("root").alias("short"), "root").distinct()), "short")
    sizes = grouped.groupBy("root").agg(F.count("*").alias("documents"), F.sum("size").alias("tokens"))
    by_size = F.greatest(F.ceil(F.col("documents") / BLOCK), F.ceil(F.col("tokens") / TASK_TOKENS))
    spread = F.least(F.lit(int(np.ceil(np.sqrt(2 * partitions)))), F.floor(F.col("documents") / LEAST_BLOCK))
    sizes = sizes.withColumn("blocks", F.greatest(by_size, spread, F.lit(1)).cast("int")).checkpoint()
    sent = F.sum(F.when(F.col("blocks") > 1, F.col("tokens") * F.col("blocks")))
    small, large = (int(x or 0) for x in sizes.agg(F.sum(F.when(F.col("blocks") == 1, F.col("tokens"))), sent).first())
    tasks = max(partitions, -(-small // TASK_TOKENS))
    rounds = max(1, -(-large // max(ROUND_TOKENS, total // ROUND_PART)))
    members = grouped.select("node", "first_id", "weight", "root").join(sizes.select("root", "blocks"), "root")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXT_ROWS):
                part = batch.slice(at, TEXT_ROWS)
                sets = shingle_sets(texts_of(part, "text"), width)
                right = [k for k, node in enumerate(part.column("node").to_pylist()) if len(sets[k]) and class_of(sets[k]) == node]
                part = part.take(pa.array(right, pa.int64()))
                columns = [part.column(name) for name in ("node", "weight", "root", "blocks")]
                blobs = pa.array([sets[k].tobytes() for k in right], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, blobs], names=["node", "weight", "root", "blocks", "tokens"])

    docs = docs.select("doc_id", "text")
    texts = members.join(docs, members["first_id"].eqNullSafe(docs["doc_id"])).select("node", "weight", "root", "blocks", "text")
    filled = texts.mapInArrow(fill, "node long, weight long, root long, blocks int, tokens binary")
    if rounds > 1:
        filled = filled.checkpoint()
    # A large group's documents meet block by block: (i, j) with i <= j, each document on the side of its block.
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    meetings = F.transform(
        others,
        lambda other: F.struct(
            F.least(F.col("own"), other).alias("i"), F.greatest(F.col("own"), other).alias("j"),
            F.when(F.col("own") > other, 1).otherwise(0).alias("side"),
        ),
    )
    dealt = filled.withColumn("own", own).select("node", "weight", "root", "blocks", "tokens", F.explode(meetings).alias("m"))
    alone = F.col("blocks") == 1
    dealt = dealt.select(
        F.when(alone, F.pmod(F.xxhash64("root"), F.lit(tasks))).otherwise(F.col("root")).alias("task"),
        F.when(alone, -1).otherwise(F.col("m.i")).alias("i"),
        F.when(alone, -1).otherwise(F.col("m.j")).alias("j"),
        F.col("m.side").alias("side"),
        "node",
        "weight",
        "tokens",
    )

    def verify(group: pa.Table) -> pa.Table:
        nodes_, at = np.unique(group.column("node").to_numpy(), return_index=True)  # repeated rows of one text
        weight = group.column("weight").to_numpy()[at]
        side = group.column("side").to_numpy()[at]
        tokens = group.column("tokens")
        sets = [np.frombuffer(tokens[k].as_buffer(), np.uint64) for k in at.tolist()]
        lone = group.column("i")[0].as_py() != group.column("j")[0].as_py() and len(np.unique(side)) < 2
        none = np.zeros(0, np.int64)
        left, right = (none, none) if lone else similar_pairs(sets, side, percent)
        links = np.bincount(left, weight[right], len(sets)) + np.bincount(right, weight[left], len(sets))
        unions = Sets(len(sets))
        unions.join_all(left, right)
        least = nodes_[unions.roots()]
        some = np.flatnonzero(links)
        return pa.table({"node": nodes_[some], "links": links[some].astype(np.int64), "least": least[some]})

    counted = "node long, links long, least long"
    if rounds == 1:
        return dealt.groupBy("task", "i", "j").applyInArrow(verify, counted).checkpoint()
    met = None
    for k in range(rounds):
        now = dealt.where(F.pmod(F.xxhash64("task", "i", "j"), F.lit(rounds)) == k)
        some = now.groupBy("task", "i", "j").applyInArrow(verify, counted).checkpoint()
        met = some if met is None else met.unionAll(some)
    return met


def jaccard_join(
    docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every row.

    Two documents link if the Jaccard similarity of their sets of ``width``-word
    shingles is at least ``percent`` hundredths, decided in whole numbers. Texts
    with equal sets are one class that is compared once and counts for all its
    rows. ``component_id`` is the smallest id reachable by links; ``n_links``
    counts the other rows linked directly. Null and empty texts have no shingles
    and link with nothing, a row with a null id takes part in links like any
    other; repeated rows link; other columns are ignored.
    """
    docs = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return linked_rows(docs, percent, width).select("doc_id", "n_shingles", "component_id", "n_links")


def linked_rows(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """``jaccard_join`` of the columns ``doc_id`` and ``text``; n_words counts the words.

    All other columns stay; none may be named like what is added, or ``node`` or ``prefix``.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    with shuffles_removed(docs.sparkSession):
        sketch = _count_tokens(docs, width)
        indexed = _index(docs, sketch, percent, width).checkpoint()
        nodes = (
            indexed.where("node IS NOT NULL")
            .groupBy("node")
            .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("weight"), F.max("n_shingles").alias("size"))
            .checkpoint()
        )
        roots = _groups(indexed, sketch, percent)
        counted = _verify(docs, nodes, roots, int(sketch.sum(dtype=np.int64)), percent, width)
        linked = components(counted.select(F.col("node").alias("a"), F.col("least").alias("b")))
    met = counted.groupBy("node").agg(F.sum("links").alias("met"))
    placed = nodes.select("node", "first_id", "weight").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    told = (
        placed.join(smallest, "root")
        .join(met, "node", "left")
        .select("node", "component_id", (F.col("weight") - 1 + F.coalesce("met", F.lit(0))).alias("n_links"))
    )
    kept = [name for name in docs.columns if name != "text"]
    return indexed.drop("prefix").join(told, "node", "left").select(
        *kept,
        "n_words",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
