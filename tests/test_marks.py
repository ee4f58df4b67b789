"""Marks with an overlap: late rows are neither lost nor doubled."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import marks

AT = dt.datetime(2024, 1, 1, 12)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_mark_of_stamps_and_keys(spark):
    rows = [(1, AT), (9, AT), (4, AT - dt.timedelta(hours=1)), (99, None)]
    target = spark.createDataFrame(rows, "id int, at timestamp_ntz")
    mark = marks.read_composite_mark(target, "at", ["id"], "90 minutes")
    assert mark == marks.Mark(AT, (9,), AT - dt.timedelta(minutes=90))
    assert mark.fill("at >= '{low_value}' AND id <> {max_key}") == "at >= '2024-01-01 10:30:00' AND id <> 9"
    text = target.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))
    assert marks.read_composite_mark(text, "at", (), "1 day").low == "2023-12-31 12:00:00"
    days = text.withColumn("at", F.substring("at", 1, 10))
    assert marks.read_composite_mark(days, "at", (), "2 days") == marks.Mark("2024-01-01", (), "2023-12-30")
    assert marks.read_composite_mark(target, "id", (), "10").low == 89
    assert marks.read_composite_mark(target.where("at IS NULL"), "at") is None
    with pytest.raises(ValueError, match="no span"):
        marks.parse_overlap("3 fortnights")


@pytest.mark.parametrize("seed", range(4))
def test_loads_equal_the_source(spark, seed):
    """Rows commit in any order within the overlap, with equal stamps, repeated and NULL keys."""
    rng = random.Random(seed)
    source, target = [], spark.createDataFrame([], "id int, orgid int, at int, v int")
    for step in range(5):
        late = range(max(0, 10 * step - 5), 10 * step + 10)
        source += [(rng.choice([None, *range(6)]), 1, rng.choice(late), rng.randint(0, 1)) for _ in range(25)]
        if step:  # one repeated row is late, and one stamp is the newest already loaded
            source += [source[-1], (7, 1, target.agg(F.max("at")).first()[0], 0)]
        frame = spark.createDataFrame(source, target.schema)
        # ``v`` tells rows of one key and stamp apart.
        new = marks.window_load(frame, target, "at", ["id", "orgid"], 15, by=["id", "orgid", "at", "v"])
        target = spark.createDataFrame([tuple(r) for r in target.collect() + new.collect()], target.schema)
        assert rows_of(target) == rows_of(frame)
        assert marks.window_load(frame, target, "at", ["id"], 15, by=frame.columns).isEmpty()


def test_filters_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    new = marks.window_load(events, events.where("event_id % 2 = 0"), "ts", ["event_id"], "1 hour")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(ts,") == 2 and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
