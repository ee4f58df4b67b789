"""Ranges of a split column that hold equal numbers of rows.

The database counts its rows by key in a grouped statement, first over the
whole range in steps of one width, then again within each step that holds too
many. The steps are cut by their cumulative counts. What comes back is a few
hundred counts, however large the table.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .jdbc import Connection, jdbc_scan, read_options, relation

# Steps that a count takes for each reader, and how often a dense step is counted in finer ones.
STEPS = 16
ROUNDS = 6

# Seconds since 1970 of a date or time, and a literal of one, per database.
SECONDS = {
    "mysql": "TIMESTAMPDIFF(SECOND, '1970-01-01', {column})",
    "sqlserver": "DATEDIFF_BIG(SECOND, '1970-01-01', {column})",
    "oracle": "(CAST({column} AS DATE) - DATE '1970-01-01') * 86400",
}
TIMES = {
    "mysql": "'{value}'",
    "sqlserver": "CAST('{value}' AS datetime2)",
    "oracle": "TIMESTAMP '{value}'",
}


@dataclass(frozen=True)
class Step:
    """Rows between two keys, both included."""

    low: object
    high: object
    rows: int

    @property
    def single(self) -> bool:
        return self.low == self.high


# Counts the rows of a range, both ends included, in at most so many steps.
Count = Callable[[object, object, int], list[Step]]


def key_histogram(count: Count, low: object, high: object, readers: int) -> list[Step]:
    """Steps in key order of which none holds more than a reader's share, unless it is one key.

    A step that does is counted in finer ones, ``ROUNDS`` times at most; each
    time it is narrowed to the keys that are there, so far-off keys cost one
    round, not the resolution of all others.
    """
    steps = sorted(count(low, high, readers * STEPS), key=lambda s: s.low)
    share = max(1, sum(s.rows for s in steps) // readers)
    for _ in range(ROUNDS):
        dense = [s for s in steps if s.rows > share and not s.single]
        if not dense:
            break
        finer = [part for s in dense for part in count(s.low, s.high, readers * STEPS)]
        steps = sorted([*[s for s in steps if s not in dense], *finer], key=lambda s: s.low)
    return steps


def equal_cuts(steps: Sequence[Step], readers: int) -> list[object]:
    """Keys at which a new reader begins, at most ``readers - 1``, so that the fullest range is as small as it can be.

    Steps are not split; one that is fuller than the others may be is a range of
    its own. How full these must be is found by halving, since fewer readers
    suffice the fuller a range may be.
    """
    if not steps:
        return []
    low, high = 1, sum(s.rows for s in steps)
    while low < high:
        middle = (low + high) // 2
        if len(_cuts(steps, middle)) < readers:
            high = middle
        else:
            low = middle + 1
    return _cuts(steps, low)


def _cuts(steps: Sequence[Step], most: int) -> list[object]:
    """Where ranges begin that are filled up to ``most`` rows, or hold one step, but for the first."""
    cuts, held = [], steps[0].rows
    for step in steps[1:]:
        if held + step.rows > most:
            cuts.append(step.low)
            held = 0
        held += step.rows
    return cuts


def range_predicates(column: str, cuts: Sequence[str]) -> list[str]:
    """One filter for each range between cuts given as literals; every row passes exactly one, NULL the first."""
    if not cuts:
        return ["1=1"]
    first = f"({column} < {cuts[0]} OR {column} IS NULL)"
    between = [f"({column} >= {a} AND {column} < {b})" for a, b in zip(cuts[:-1], cuts[1:])]
    return [first, *between, f"({column} >= {cuts[-1]})"]


def literal(value: object, dialect: str = "") -> str:
    """A number or a time as a literal of a database; of Spark without one."""
    if isinstance(value, dt.datetime):
        text = value.isoformat(sep=" ", timespec="microseconds")
    elif isinstance(value, dt.date):
        text = f"{value.isoformat()} 00:00:00" if dialect == "oracle" else value.isoformat()
    elif isinstance(value, (int, float, decimal.Decimal)) and not isinstance(value, bool):
        return format(value, "f") if isinstance(value, decimal.Decimal) else repr(value)
    else:
        raise ValueError(f"a split column holds numbers, dates or times, not {type(value).__name__}")
    return TIMES.get(dialect, "TIMESTAMP '{value}'").format(value=text)


def _number(value: object) -> float:
    """A key as a number, times in seconds since 1970."""
    if isinstance(value, dt.datetime):
        return (value.replace(tzinfo=None) - dt.datetime(1970, 1, 1)).total_seconds()
    if isinstance(value, dt.date):
        return float((value - dt.date(1970, 1, 1)).days * 86400)
    return value if isinstance(value, int) else float(value)


def step_width(low: object, high: object, steps: int) -> int | float:
    """Width of a step so that ``steps`` of them reach over both ends; whole keys have whole widths."""
    a, b = _number(low), _number(high)
    if isinstance(a, int) and isinstance(b, int):
        return max(1, -(-(b - a + 1) // steps))
    # The last key must not fall into a step of its own.
    return max((b - a) / steps * (1 + 1e-9), 1e-9)


def histogram_query(
    connection: Connection, column: str, low: object, high: object, steps: int,
    table: str | None = None, query: str | None = None, where: str | None = None,
) -> str:
    """Statement that counts the rows of a key range in steps of one width: ``lo``, ``hi``, ``n``."""
    dialect = connection.dialect
    timed = isinstance(low, dt.date)
    number = SECONDS[dialect].format(column=column) if timed else column
    step = f"FLOOR(({number} - ({_plain(_number(low))})) / {_plain(step_width(low, high, steps))})"
    source = relation(connection, table, query, where)
    return (
        f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT(1) AS n FROM {source}"
        f" WHERE {column} >= {literal(low, dialect)} AND {column} <= {literal(high, dialect)} GROUP BY {step}"
    )


def _plain(value: int | float) -> str:
    """A number without an exponent; with a point, so that no database divides whole numbers."""
    return f"{value}.0" if isinstance(value, int) else format(value, ".9f")


def jdbc_histogram(
    spark: SparkSession, connection: Connection, column: str, readers: int,
    table: str | None = None, query: str | None = None, where: str | None = None,
) -> list[Step]:
    """Histogram of a split column, counted by the database; empty without keys."""
    source = relation(connection, table, query, where)
    ends = jdbc_scan(spark, connection, query=f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {source}").first()
    if ends is None or ends[0] is None:
        return []

    def count(low: object, high: object, steps: int) -> list[Step]:
        statement = histogram_query(connection, column, low, high, steps, table, query, where)
        found = jdbc_scan(spark, connection, query=statement).collect()  # at most ``steps`` rows
        return [Step(row[0], row[1], int(row[2])) for row in found]

    return key_histogram(count, ends[0], ends[1], readers)


def frame_histogram(df: DataFrame, column: str, readers: int) -> list[Step]:
    """Histogram of a column of any DataFrame, by the same steps."""
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    if ends is None or ends["lo"] is None:
        return []
    timed = isinstance(ends["lo"], dt.date)

    def count(low: object, high: object, steps: int) -> list[Step]:
        key = F.col(column)
        number = F.unix_micros(F.to_utc_timestamp(key, "UTC").cast("timestamp")) / 1_000_000 if timed else key
        step = F.floor((number - F.lit(_number(low))) / F.lit(step_width(low, high, steps)))
        grouped = df.where(key.between(F.lit(low), F.lit(high))).groupBy(step.alias("step"))
        found = grouped.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n")).collect()
        return [Step(row["lo"], row["hi"], row["n"]) for row in found]

    return key_histogram(count, ends["lo"], ends["hi"], readers)


def equal_predicates(df: DataFrame, column: str, readers: int) -> list[str]:
    """Filters that part a DataFrame's rows evenly among readers."""
    cuts = equal_cuts(frame_histogram(df, column, readers), readers)
    return range_predicates(column, [literal(cut) for cut in cuts])


def even_scan(
    spark: SparkSession, connection: Connection, column: str, readers: int,
    table: str | None = None, query: str | None = None, where: str | None = None,
) -> DataFrame:
    """Read a table, a filtered table or a query in ranges of equal row counts.

    One key with more rows than a reader's share is a range of its own and not
    split further. Each reader reads a range, so an index on the column serves.
    """
    steps = jdbc_histogram(spark, connection, column, readers, table, query, where)
    cuts = [literal(cut, connection.dialect) for cut in equal_cuts(steps, readers)]
    options = read_options(connection, table, query, where)
    url, what = options.pop("url"), options.pop("dbtable")
    return spark.read.jdbc(url, what, predicates=range_predicates(column, cuts), properties=options)
