import time
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.jaccard_join import linked_rows
from tidemark.llm.packing import clustered_documents, pack, pack_documents, sized_documents


def brute(sizes, sources, clusters, capacity):
    """The tightest compatible bin by looking at all; the first opened one on a tie."""
    bins, out = [], []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        fits = [
            (room, k)
            for k, (room, own, groups) in enumerate(bins)
            if room >= size and (source is None or source not in own) and (cluster is None or cluster not in groups)
        ]
        if fits:
            k = min(fits)[1]
        else:
            bins.append([capacity, set(), set()])
            k = len(bins) - 1
        bins[k][0] -= size
        bins[k][1].add(source)
        bins[k][2].add(cluster)
        out.append(k)
    return out


items = st.lists(st.tuples(st.integers(0, 10), st.sampled_from("abc") | st.none(), st.integers(0, 3) | st.none()), max_size=60)


@settings(max_examples=200, deadline=None)
@given(items)
def test_takes_the_tightest_compatible_bin(rows):
    rows.sort(key=lambda row: -row[0])
    sizes, sources, clusters = ([row[k] for row in rows] for k in range(3))
    assert pack(sizes, sources, clusters, 10) == brute(sizes, sources, clusters, 10)


def check(rows, capacity, sizes):
    """No bin too full, no conflict inside, and every word of every document placed once."""
    bins, placed = defaultdict(list), defaultdict(list)
    for row in rows:
        bins[row.bin_id].append(row)
        placed[row.doc_id].append((row.start_word, row.n_words))
    for inside in bins.values():
        assert sum(row.n_words for row in inside) <= capacity
        for name in ("source", "cluster"):
            held = [row[name] for row in inside if row[name] is not None]
            assert len(held) == len(set(held))
    for doc, size in sizes.items():
        at = 0
        for start, n in sorted(placed[doc]):
            assert start == at
            at += n
        assert at == size


def test_documents_with_a_hot_source_and_copies(spark):
    rows = [(k, f"s{k % 3}" if k % 3 else "hot", "w " * (k % 40) + f"t{k % 7}") for k in range(600)]
    rows += [(1000, None, None), (1001, "hot", ""), (1002, "hot", "long " * 1000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "7L AS cluster", "'x' AS shard")
    found = pack_documents(sized_documents(docs), capacity=64, shard=100).collect()
    check(found, 64, {k: len((text or "").split()) for k, _, text in rows})
    assert len({row.bin_id >> 32 for row in found}) > 3
    assert sorted(row.n_words for row in found if row.doc_id == 1002)[-1] == 64


def test_pieces_without_a_cluster_stay_apart_and_empty_tables(spark):
    items_ = spark.createDataFrame([(1, 25, None, None), (2, None, "a", 5)], "doc_id long, n_words long, source string, cluster long")
    found = pack_documents(items_, capacity=10).collect()
    check(found, 10, {1: 25, 2: 0})
    assert pack_documents(items_.limit(0)).count() == 0
    assert pack_documents(items_.unionAll(items_.where("doc_id = 2")), capacity=10).count() == 5


def test_near_copies_lie_in_different_bins(spark):
    base = [f"w{k}" for k in range(80)]
    near = [" ".join([*base[:k], "other", *base[k + 1 :]]) for k in (0, 79)]
    other = " ".join(f"v{k}" for k in range(80))
    rows = [(1, "a", " ".join(base)), (2, "b", near[0]), (3, "c", near[1].upper()), (None, "d", near[0]), (5, "e", other)]
    rows += [(6, "f", " ".join(base)), (6, "g", other + " x"), (7, "h", ""), (8, None, None), (None, "i", "ÉÀ é"), (9, "j", "éà  É")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "'x' AS known", "1 AS cluster")
    items_ = clustered_documents(docs)
    cluster = {(r.doc_id, r.source): r.cluster for r in items_.collect()}
    assert len(cluster) == len(rows) == items_.count()
    # 6 is the id of a copy of 1 and of a near copy of 5, so these clusters are one.
    assert len({cluster[k] for k in [(1, "a"), (2, "b"), (3, "c"), (None, "d"), (5, "e"), (6, "f"), (6, "g")]}) == 1
    assert cluster[7, "h"] is cluster[8, None] is None
    assert cluster[None, "i"] == cluster[9, "j"] not in (None, cluster[1, "a"])
    found = pack_documents(items_, capacity=1000).collect()
    assert len({r.bin_id for r in found if r.n_words >= 80}) == 7
    plain = clustered_documents(docs.where("doc_id < 6"))
    assert len({r.cluster for r in plain.collect()}) == 2
    assert clustered_documents(docs.limit(0)).count() == 0


def test_words_and_columns_come_with_the_clusters(spark):
    rows = [(1, "a", "One two\tthree\n"), (1, "b", "one TWO three"), (None, None, " Été \x0b x\x1fy"), (4, "d", None), (5, "e", " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("doc_id n_words", "source node", "text prefix")
    named = docs.selectExpr("n_words doc_id", "node source", "prefix text")
    found = linked_rows(named, 80, 5).collect()
    assert sorted((r.source or "", r.n_words, r.n_shingles) for r in found) == [("", 2, 1), ("a", 3, 1), ("b", 3, 1), ("d", 0, 0), ("e", 0, 0)]
    odd = clustered_documents(docs, text="prefix", id_column="n_words", source="node").collect()
    assert sorted((r.source or "", r.doc_id, r.n_words) for r in odd) == [("", None, 2), ("a", 1, 3), ("b", 1, 3), ("d", 4, 0), ("e", 5, 0)]
    assert [r.cluster is None for r in sorted(odd, key=lambda r: r.source or "")] == [False, False, False, True, True]


def test_clusters_leave_no_shuffle_on_the_disk(spark):
    """While the next steps run, the disk must not hold what the join has shuffled."""

    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("|")
        return {path for path in files.split("|") if "/shuffle_" in path}

    words = [f"w{k}" for k in range(60)]
    rows = [(k, "a", " ".join([*words[:k], "other", *words[k + 1 :]])) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    before = shuffled()
    items_ = clustered_documents(docs)
    end = time.time() + 10
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffled() - before
    assert items_.count() == 40 and len({r.cluster for r in items_.collect()}) == 1
