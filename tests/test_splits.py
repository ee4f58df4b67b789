"""Equal-count ranges of a split column."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import splits
from tidemark.sources.jdbc import Connection
from tidemark.sources.splits import Step

CONNECTIONS = [Connection("01", kind, "h", 1, "d") for kind in ("mysql", "sqlserver", "oracle")]


def counter(keys, asked):
    """Counts of a list of keys as a database gives them."""

    def count(low, high, steps):
        asked.append((low, high))
        width, groups = splits.step_width(low, high, steps), {}
        for key in keys:
            if low <= key <= high:
                groups.setdefault(int((key - low) // width), []).append(key)
        assert len(groups) <= steps
        return [Step(min(g), max(g), len(g)) for g in groups.values()]

    return count


def ranges(keys, readers):
    asked = []
    steps = splits.key_histogram(counter(keys, asked), min(keys), max(keys), readers)
    assert sum(s.rows for s in steps) == len(keys)
    cuts = splits.equal_cuts(steps, readers)
    filled = [sum(1 for k in keys if (a is None or k >= a) and (b is None or k < b)) for a, b in zip([None, *cuts], [*cuts, None])]
    assert sum(filled) == len(keys) and len(filled) <= readers
    return filled, asked


def test_dense_range_hot_key_and_far_keys():
    rng = random.Random(1)
    dense = [10**6 + rng.randint(0, 5000) for _ in range(20_000)]
    sparse = [rng.randint(0, 10**12) for _ in range(500)]
    filled, asked = ranges(dense + sparse, 8)
    assert max(filled) <= 1.2 * 20_500 / 8 and len(asked) < 60
    filled, _ = ranges(dense + sparse + [1_002_500] * 20_000, 8)  # one key with half of the rows
    assert max(filled) < 20_100 and len(filled) == 8 and sorted(filled)[-2] <= 1.2 * 20_500 / 7
    assert ranges([5] * 1000, 8)[0] == [1000]
    assert ranges([1.5, 2.5, 2.5000001, 9e9], 4)[0] == [1, 1, 1, 1]
    assert max(ranges(list(range(100)), 4)[0]) <= 27


def test_fullest_range_is_as_small_as_it_can_be():
    rng = random.Random(2)
    for _ in range(200):
        sizes = [rng.randint(1, 9) for _ in range(rng.randint(1, 9))]
        readers, steps = rng.randint(1, 5), [Step(k, k, n) for k, n in enumerate(sizes)]

        def least(at, left):
            if at == len(sizes):
                return 0
            if left == 1:
                return sum(sizes[at:])
            return min(max(sum(sizes[at:to]), least(to, left - 1)) for to in range(at + 1, len(sizes) + 1))

        cuts = [0, *splits.equal_cuts(steps, readers), len(sizes)]
        assert len(cuts) <= readers + 1
        assert max(sum(sizes[a:b]) for a, b in zip(cuts, cuts[1:])) == least(0, readers)
    assert splits.equal_cuts([], 4) == []


def test_predicates_part_all_rows(spark):
    rows = [(k % 7 * 10 if k % 3 else 50,) for k in range(100)] + [(None,)]
    df = spark.createDataFrame(rows, "k int")
    filters = splits.equal_predicates(df, "k", 4)
    assert sum(df.where(f).count() for f in filters) == 101 and len(filters) > 1
    assert [r[0] for r in df.where(filters[0]).where("k IS NULL").collect()] == [None]
    assert splits.equal_predicates(df.where("k IS NULL"), "k", 4) == ["1=1"]
    times = spark.range(1000).select(F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * id)").alias("at"))
    for column in ("at", "day"):
        frame = times.withColumn("day", F.to_date("at"))
        counts = [frame.where(f).count() for f in splits.equal_predicates(frame, column, 4)]
        assert sum(counts) == 1000 and max(counts) < (400 if column == "at" else 600)


def test_statements():
    day = dt.date(2024, 1, 1)
    by_number = splits.histogram_query(CONNECTIONS[1], "id", 5, 104, 10, "t", where="a = 1")
    assert by_number == (
        "SELECT MIN(id) AS lo, MAX(id) AS hi, COUNT(1) AS n FROM (SELECT * FROM t WHERE a = 1) src"
        " WHERE id >= 5 AND id <= 104 GROUP BY FLOOR((id - (5.0)) / 10.0)"
    )
    texts = [splits.histogram_query(c, "at", day, dt.datetime(2024, 1, 2, 3), 4, "t") for c in CONNECTIONS]
    assert "at >= '2024-01-01' AND at <= '2024-01-02 03:00:00.000000'" in texts[0] and "TIMESTAMPDIFF(SECOND" in texts[0]
    assert "CAST('2024-01-02 03:00:00.000000' AS datetime2)" in texts[1] and "DATEDIFF_BIG(SECOND" in texts[1]
    assert "FROM T WHERE at >= TIMESTAMP '2024-01-01 00:00:00'" in texts[2] and "* 86400 - (1704067200.000000000)" in texts[2]
    assert splits.literal(decimal.Decimal("1E+3")) == "1000" and splits.literal(2.5) == "2.5"
    with pytest.raises(ValueError, match="numbers, dates or times"):
        splits.literal("x")


def test_scan_asks_for_counts_then_reads_ranges(monkeypatch):
    asked, read = [], {}

    class Answer:
        def __init__(self, rows):
            self.rows = rows

        def first(self):
            return self.rows[0] if self.rows else None

        def collect(self):
            return self.rows

    def scan(spark, connection, query):
        asked.append(query)
        return Answer([(1, 100)] if "GROUP BY" not in query else [(1, 50, 10), (51, 100, 30)] if len(asked) == 2 else [(51, 60, 15), (61, 100, 15)])

    class Session:
        @property
        def read(self):
            return self

        def jdbc(self, url, what, predicates, properties):
            read.update(what=what, predicates=predicates)
            return "frame"

    monkeypatch.setattr(splits, "jdbc_scan", scan)
    assert splits.even_scan(Session(), CONNECTIONS[0], "id", 2, "t") == "frame"
    assert len(asked) == 3 and read == {"what": "t", "predicates": ["(id < 61 OR id IS NULL)", "(id >= 61)"]}
    monkeypatch.setattr(splits, "jdbc_scan", lambda *a, **k: Answer([(None, None)]))
    assert splits.jdbc_histogram(Session(), CONNECTIONS[0], "id", 2, "t") == []
