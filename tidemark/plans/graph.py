"""Run a plan's tasks several at a time, in the order of what they need.

A task starts once all that it needs has succeeded; what a failure leaves
without its needs is cancelled and told in the ledger. Tasks are Spark jobs of
one session: each runs in a thread with a job group and a scheduler pool of its
own, so that under fair scheduling a large table does not hold up small ones.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Hashable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession

from .registry import CANCELLED, FAILED, SUCCEEDED, record_run, sync_ledger
from .running import is_tombstone_log

logger = logging.getLogger(__name__)

# Tasks that run at a time, by what they do.
IMPORTS, MERGES, EXPORTS = 10, 8, 6


@dataclass
class Outcome:
    """Task ids by how they ended, each in the order of ending."""

    succeeded: list[Hashable] = field(default_factory=list)
    failed: list[Hashable] = field(default_factory=list)
    cancelled: list[Hashable] = field(default_factory=list)


def needs_of_logs(tasks: Iterable[Row]) -> dict[Hashable, set[Hashable]]:
    """Every task needs the tombstone logs, which need nothing."""
    tasks = list(tasks)
    logs = {row["id"] for row in tasks if is_tombstone_log(row)}
    return {row["id"]: set() if row["id"] in logs else set(logs) for row in tasks}


def needs_of_tables(reads: Mapping[Hashable, Iterable[str]], writes: Mapping[Hashable, Iterable[str]]) -> dict[Hashable, set[Hashable]]:
    """Tasks need those that write a table which they read; names in any case.

    A table that no task writes is there already. A task may read what it
    writes itself.
    """
    writers: dict[str, set[Hashable]] = {}
    for task, tables in writes.items():
        for table in tables:
            writers.setdefault(table.lower(), set()).add(task)
    return {
        task: {w for table in reads.get(task, ()) for w in writers.get(table.lower(), ())} - {task}
        for task in {**dict.fromkeys(reads), **dict.fromkeys(writes)}
    }


def waves(ids: Iterable[Hashable], needs: Mapping[Hashable, Iterable[Hashable]]) -> list[list[Hashable]]:
    """Tasks by the longest way to a task without needs; a wave needs only earlier ones, and keeps the given order.

    Needs that are not among the tasks count as met. A circle is refused, and
    its members are named.
    """
    ids = list(ids)
    open_ = {task: {n for n in needs.get(task, ()) if n in set(ids)} for task in ids}
    found: list[list[Hashable]] = []
    while open_:
        ready = [task for task in ids if task in open_ and not open_[task]]
        if not ready:
            raise ValueError(f"tasks need each other in a circle: {_circle(open_)}")
        found.append(ready)
        for task in ready:
            del open_[task]
        for left in open_.values():
            left.difference_update(ready)
    return found


def _circle(open_: Mapping[Hashable, set[Hashable]]) -> list[Hashable]:
    path = [next(iter(open_))]
    while True:
        following = sorted(open_[path[-1]], key=str)[0]
        if following in path:
            return path[path.index(following) :]
        path.append(following)


def run_graph(
    spark: SparkSession,
    tasks: Iterable[Row],
    run: Callable[[Row], object],
    ledger_table: str,
    today: str,
    needs: Mapping[Hashable, Iterable[Hashable]] | None = None,
    at_once: int = IMPORTS,
) -> Outcome:
    """Run tasks, ``at_once`` at a time; ready ones start in the given order.

    ``needs`` names for a task's id those it waits for, :func:`needs_of_logs`
    by default. Every task gets a line in the ledger as it ends: succeeded,
    failed, or cancelled since something it needs did not succeed. The lines
    are written by this thread alone, for inserts into one table must not
    overlap. If this thread is stopped, jobs that still run are cancelled.
    """
    tasks = list(tasks)
    rows = {row["id"]: row for row in tasks}
    if len(rows) < len(tasks):
        raise ValueError("a task id occurs twice")
    needs = needs_of_logs(tasks) if needs is None else needs
    waves(rows, needs)  # refuses circles before anything runs
    waiting = {task: {n for n in needs.get(task, ()) if n in rows} for task in rows}
    outcome, running = Outcome(), {}

    def group(task: Hashable) -> str:
        return f"task-{task}-{today}"

    def work(row: Row) -> tuple[dt.datetime, dt.datetime, Exception | None]:
        context, started, error = spark.sparkContext, dt.datetime.now(), None
        context.setJobGroup(group(row["id"]), f"{row['table_name']}", interruptOnCancel=True)
        context.setLocalProperty("spark.scheduler.pool", group(row["id"]))
        try:
            run(row)
        except Exception as failure:  # noqa: BLE001 - the ledger tells it
            error = failure
        return started, dt.datetime.now(), error

    def told(task: Hashable, started: dt.datetime, ended: dt.datetime, status: str) -> None:
        record_run(spark, ledger_table, [(task, today, started, ended, status)])

    def cancel(lost: Hashable) -> None:
        for task in [t for t, left in waiting.items() if lost in left]:
            if task in waiting:
                del waiting[task]
                outcome.cancelled.append(task)
                logger.warning("%s cancelled: it needs %s", rows[task]["table_name"], rows[lost]["table_name"])
                now = dt.datetime.now()
                told(task, now, now, CANCELLED)
                cancel(task)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        try:
            while waiting or running:
                for task in [t for t, left in waiting.items() if not left][: max(1, at_once) - len(running)]:
                    del waiting[task]
                    future: Future = pool.submit(inheritable_thread_target(spark)(work), rows[task])
                    running[future] = task
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    task = running.pop(future)
                    started, ended, error = future.result()
                    told(task, started, ended, FAILED if error else SUCCEEDED)
                    if error:
                        logger.error("%s failed: %s", rows[task]["table_name"], error)
                        outcome.failed.append(task)
                        cancel(task)
                    else:
                        outcome.succeeded.append(task)
                        for left in waiting.values():
                            left.discard(task)
        except BaseException:
            for task in running.values():
                spark.sparkContext.cancelJobGroup(group(task))
            raise
    return outcome


def run_plan_at_once(
    spark: SparkSession,
    plan: DataFrame,
    registry: DataFrame,
    run: Callable[[Row], object],
    ledger_table: str,
    today: str,
    needs: Mapping[Hashable, Iterable[Hashable]] | None = None,
    at_once: int = IMPORTS,
) -> DataFrame:
    """As :func:`running.run_plan`, several tasks at a time; returns the registry with its new dates.

    A task that failed or was cancelled keeps its date, so the day's next plan
    lists it again.
    """
    run_graph(spark, plan.orderBy("no").collect(), run, ledger_table, today, needs, at_once)
    return sync_ledger(registry, spark.table(ledger_table))
