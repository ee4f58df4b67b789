"""Tasks in the order of their needs, several at a time."""

import random
import threading
import time

import pytest
from pyspark.sql import Row

from tidemark.plans import graph, registry
from tidemark.session import scratch_database
from tidemark.sinks import tables as sink


def ledger_of(spark):
    ledger = f"{scratch_database(spark, 'graph')}.runs"
    sink.create_table(spark, ledger, [tuple(c.split()) for c in registry.LEDGER.split(",")])
    return ledger


def rows_of(names):
    return [Row(id=k, table_name=name) for k, name in enumerate(names)]


def held(spark, ledger):
    return {r["id"]: r["status"] for r in spark.table(ledger).collect()}


@pytest.mark.parametrize("seed", range(5))
def test_waves(seed):
    rng = random.Random(seed)
    ids = rng.sample(range(40), 20)
    needs = {a: {b for b in ids[:k] if rng.random() < 0.2} | {99} for k, a in enumerate(ids)}
    found = graph.waves(sorted(ids), needs)
    at = {task: k for k, wave in enumerate(found) for task in wave}
    assert sorted(at) == sorted(ids) and all(wave == sorted(wave) for wave in found)
    for task in ids:
        inner = needs[task] - {99}
        assert at[task] == (max(at[n] for n in inner) + 1 if inner else 0)
    assert graph.waves([], {}) == []


def test_circles_are_refused_first(spark):
    with pytest.raises(ValueError, match=r"circle: \[2, 3\]"):
        graph.waves([1, 2, 3], {1: [2], 2: [3], 3: [2]})
    with pytest.raises(ValueError, match="circle"):
        graph.run_graph(spark, rows_of("ab"), None, "unused", "d", {0: [1], 1: [0]})
    with pytest.raises(ValueError, match="twice"):
        graph.run_graph(spark, [*rows_of("a"), *rows_of("a")], None, "unused", "d")


def test_needs_of_tables():
    reads = {"merge": ["d.ods_a", "d.ods_b"], "export": ["f.a"], "a": ["src.a", "d.ods_a"]}
    writes = {"a": ["D.ods_a"], "b": ["d.ods_b"], "merge": ["f.A"]}
    assert graph.needs_of_tables(reads, writes) == {"a": set(), "b": set(), "merge": {"a", "b"}, "export": {"merge"}}


def test_several_at_a_time_in_pools_of_their_own(spark):
    ledger, lock, seen = ledger_of(spark), threading.Lock(), {"now": 0, "most": 0, "pools": set()}

    def run(row):
        with lock:
            seen["now"] += 1
            seen["most"] = max(seen["most"], seen["now"])
            seen["pools"].add(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        assert spark.range(1000).selectExpr("sum(id)").first()[0] == 499500
        time.sleep(0.3)
        with lock:
            seen["now"] -= 1

    done = graph.run_graph(spark, rows_of("abcdefg"), run, ledger, "d", {}, at_once=3)
    assert sorted(done.succeeded) == list(range(7)) and seen["most"] == 3 and len(seen["pools"]) == 7
    assert set(held(spark, ledger).values()) == {"SUCCEEDED"}


def test_failures_cancel_what_depends_on_them(spark):
    ledger, order = ledger_of(spark), []

    def run(row):
        order.append(row["id"])
        if row["id"] in (1, 5):
            raise RuntimeError("no")

    needs = {2: [1], 3: [2], 4: [0], 6: [5, 3], 7: [4]}
    done = graph.run_graph(spark, rows_of("abcdefgh"), run, ledger, "2024-01-02", needs, at_once=2)
    assert sorted(done.succeeded) == [0, 4, 7] and sorted(done.failed) == [1, 5] and sorted(done.cancelled) == [2, 3, 6]
    assert sorted(order) == [0, 1, 4, 5, 7] and order.index(0) < order.index(4) < order.index(7)
    want = {**dict.fromkeys((0, 4, 7), "SUCCEEDED"), **dict.fromkeys((1, 5), "FAILED"), **dict.fromkeys((2, 3, 6), "CANCELLED")}
    assert held(spark, ledger) == want
    failed = registry.failed_tasks(spark.table(ledger))
    assert sorted(r["id"] for r in failed.collect()) == [1, 5]


def test_logs_come_first(spark):
    ledger, order = ledger_of(spark), []
    tasks = rows_of(["a", "src_Warm_Deleted", "b"])
    assert graph.run_graph(spark, tasks, lambda r: order.append(r["id"]), ledger, "d").succeeded[0] == 1 and order[0] == 1

    def bad(row):
        raise RuntimeError("no")

    done = graph.run_graph(spark, tasks, bad, ledger, "e")
    assert done.failed == [1] and done.cancelled == [0, 2]


def test_stopping_cancels_running_jobs(spark, monkeypatch):
    ledger, gone = ledger_of(spark), []
    monkeypatch.setattr(graph, "record_run", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    monkeypatch.setattr(type(spark.sparkContext), "cancelJobGroup", lambda self, name: gone.append(name))
    with pytest.raises(KeyboardInterrupt):
        graph.run_graph(spark, rows_of("ab"), lambda r: time.sleep(0.2 if r["id"] else 0), ledger, "d", {}, at_once=2)
    assert gone == ["task-1-d"]
