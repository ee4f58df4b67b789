"""Run a plan: one task after another, the ledger kept, the registry brought up to date."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Row, SparkSession

from .registry import FAILED, SUCCEEDED, record_run, sync_ledger
from .unique import TOMBSTONE_TABLE

logger = logging.getLogger(__name__)


def is_tombstone_log(row: Row) -> bool:
    """Whether a task loads a tombstone table, on which others depend."""
    return TOMBSTONE_TABLE in row["table_name"].lower()


def run_tasks(
    spark: SparkSession,
    tasks: Iterable[Row],
    run: Callable[[Row], object],
    ledger_table: str,
    today: str,
    first: Callable[[Row], bool] = is_tombstone_log,
) -> list[Row]:
    """Run tasks in their order, those of ``first`` before the others; returns what failed.

    Every run goes to the ledger as it ends. If one of the first fails, the
    others are not started; else a failure stops nothing.
    """
    tasks, failed = list(tasks), []
    leading = [row for row in tasks if first(row)]
    for row in [*leading, *[row for row in tasks if not first(row)]]:
        if failed and row not in leading:
            if any(first(lost) for lost in failed):
                break
        started = dt.datetime.now()
        try:
            run(row)
            status = SUCCEEDED
        except Exception as error:  # noqa: BLE001 - the ledger tells it
            logger.error("%s failed: %s", row["table_name"], error)
            status = FAILED
            failed.append(row)
        record_run(spark, ledger_table, [(row["id"], today, started, dt.datetime.now(), status)])
    return failed


def run_plan(
    spark: SparkSession,
    plan: DataFrame,
    registry: DataFrame,
    run: Callable[[Row], object],
    ledger_table: str,
    today: str,
) -> DataFrame:
    """Run what a plan such as ``sync_plan`` lists; returns the registry with its new dates.

    The plan's rows, one for each registered table, come to the driver. With the
    returned registry a second plan of the same day lists only what failed.
    """
    run_tasks(spark, plan.orderBy("no").collect(), run, ledger_table, today)
    return sync_ledger(registry, spark.table(ledger_table))
