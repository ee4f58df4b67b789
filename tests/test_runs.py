"""Current tables merged on reading."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.plans import runs
from tidemark.plans.unique import unique_incremental
from tidemark.session import scratch_database

LOG = "id int, orgid int, at string, n int"
DELETES = "p_id int, p_orgid int, updatestamp string, tablename string"
KEYS = ["id", "orgid"]


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed", range(2))
def test_equals_a_rebuild(spark, seed):
    """NULL stamps and keys, ties, late rows and deletes, revived keys, repeated increments."""
    rng = random.Random(seed)
    table = f"{scratch_database(spark, 'runs')}.ods_x"
    stamp = lambda: rng.choice([None, *"abcdefgh"])
    rows = [(rng.randint(1, 25), rng.choice([1, 2, None]), stamp(), k % 7) for k in range(160)]
    dead = [(rng.choice([*range(1, 26), None]), rng.choice([1, 2, None]), stamp(), rng.choice("xXy")) for _ in range(50)]
    ties = None if seed else ["n"]
    cuts = sorted(rng.sample(range(161), 5))
    runs.create_runs(spark, table, spark.createDataFrame([], LOG), KEYS, "at", ties)
    for low, high in zip([0, *cuts], [*cuts, 160]):
        from_dead, to_dead = low * 50 // 160, high * 50 // 160
        new = spark.createDataFrame(rows[low:high], LOG)
        deletes = spark.createDataFrame(dead[from_dead:to_dead], DELETES)
        for _ in range(rng.choice([1, 1, 2])):  # a refresh that is run again changes nothing
            runs.add_run(spark, table, new, deletes, tombstone_name="x", fan=3)
        whole = unique_incremental(
            spark.createDataFrame(rows[:high], LOG), spark.createDataFrame(dead[:to_dead], DELETES), KEYS, "at", "x", ties, F.lit(0)
        )
        assert rows_of(runs.current_rows(spark, table, F.lit(0))) == rows_of(whole)
    assert len(runs.live_runs(runs.stored_runs(spark, table))) < 6


def sizes(spark, table):
    """Bytes of every data file, by path."""
    listed = spark.table(table).select("_metadata.file_path", "_metadata.file_size").distinct().collect()
    return {r["file_path"]: r["file_size"] for r in listed}


def test_writes_in_proportion_to_the_increment(spark):
    """Random keys all over a table of two sizes: the same bytes are written for the same increments."""
    written = {}
    log = spark.range(100_000).select(
        F.col("id").cast("int"), F.lit(1).alias("orgid"), F.lit("b").alias("at"), F.hash("id").alias("n")
    )
    for scale in (1, 10):
        table = f"{scratch_database(spark, 'bytes')}.ods_x"
        runs.create_runs(spark, table, log, KEYS, "at")
        runs.add_run(spark, table, log.where(F.col("id") < 10_000 * scale))
        seen, total = sizes(spark, table), 0
        for k in range(4):
            new = log.where((F.col("id") < 10_000 * scale) & (F.pmod(F.col("n") + k, F.lit(100 * scale)) == 0))
            runs.add_run(spark, table, new.withColumn("at", F.lit(f"c{k}")))
            now = sizes(spark, table)
            total += sum(size for path, size in now.items() if path not in seen)
            seen |= now
        written[scale] = total, max(sizes(spark, table).values())
        assert runs.current_rows(spark, table).count() == 10_000 * scale
    assert written[10][0] < 2 * written[1][0] and written[10][1] > 3 * written[1][1]


def test_which_runs_merge():
    assert runs.run_to_merge([]) == 0
    assert runs.run_to_merge([100, 5, 5, 5], 4) == 4
    assert runs.run_to_merge([100, 5, 5, 5, 5], 4) == 1
    assert runs.run_to_merge([100, 20, 20, 20, 5, 5, 5, 17], 4) == 1  # smaller ones between go with them
    assert runs.run_to_merge([5000, 900, 800, 700], 4) == 4 and runs.run_to_merge([1000, 900, 800, 400], 4) == 0
    live, rewritten = [10**6], 0
    for _ in range(2000):
        live.append(100)
        at = runs.run_to_merge(live, 4)
        if at < len(live):
            rewritten += sum(live[at:])
            live[at:] = [sum(live[at:])]
    assert len(live) < 30 and rewritten < 2000 * 100 * 8


def test_a_lost_program_leaves_the_table_right(spark, monkeypatch):
    """Ended after the merged run is written, before and after the old folders go."""
    table = f"{scratch_database(spark, 'lost')}.ods_x"
    part = lambda k: spark.createDataFrame([(k % 3, 1, f"s{k}", k)], LOG)
    runs.create_runs(spark, table, part(0), KEYS, "at")
    for k in range(3):
        runs.add_run(spark, table, part(k), fan=3)
    held = runs.stored_runs(spark, table)
    assert runs.Run(1, 3) in held and len(held) == 4  # the merged one beside what it covers
    assert rows_of(runs.current_rows(spark, table, F.lit(0))) == rows_of(
        spark.table(table).where("first_run = 1 AND last_run = 3").drop(*runs.HELPERS).withColumn("etl_time", F.lit(0))
    )
    assert runs.expire_runs(spark, table) == [runs.Run(k, k) for k in (1, 2, 3)]
    assert runs.stored_runs(spark, table) == [runs.Run(1, 3)] and runs.current_rows(spark, table).count() == 3
    assert runs.add_run(spark, table, part(0).limit(0)) is None


def test_reading_takes_live_runs_only(spark):
    table = f"{scratch_database(spark, 'live')}.ods_x"
    first = spark.createDataFrame([(1, 1, "a", 0)], LOG)
    for k in range(4):
        found = runs.refresh_runs(spark, table, first.withColumn("n", F.lit(k)).withColumn("at", F.lit(f"a{k}")), None, KEYS, "at")
    assert [r["n"] for r in found.collect()] == [3]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[(.*?)\], Push", plan)
    assert filters and all("first_run" in f and "last_run" in f for f in filters) and "WindowGroupLimit" in plan
    with pytest.raises(ValueError, match="own columns"):
        runs.create_runs(spark, table + "2", first.withColumnRenamed("n", runs.FIRST), KEYS, "at")
