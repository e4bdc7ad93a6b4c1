"""Micro-batches with records that can't be processed: halve until the bad ones stand alone."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.session import discard, passing_path

TRIES = 3
MOST_DEAD = 100
THREADS = 12
PAGE = 1000

_AT, _TASK, _ROW = "_at", "_task", "_row"


class TooManyBadRecords(Exception):
    """So many records fail that the fault is hardly theirs; the batch fails as a whole and can be run again."""


@dataclass(frozen=True)
class Failure:
    """A record, by its number in the batch, that failed ``tries`` times on its own."""

    at: int
    tries: int
    error: str


@dataclass(frozen=True)
class Sorted:
    """What became of a batch: its good records, processed, and (all columns, tries, error) of the others."""

    good: DataFrame
    dead: DataFrame


class _Numbered:
    """The batch, written, whose records have numbers from 0 to ``count`` - 1.

    Records are numbered within their tasks, and tasks follow each other by their counts; nothing is sorted and no row moves. Each task's
    records have a folder, and parts are told by written columns, so that an attempt reads the folders and pages of its part alone. Numbers are
    written as text: unlike a number, a text in a condition is not part of the generated code, so all attempts share what was compiled for the first.
    """

    def __init__(self, batch: DataFrame, path: str) -> None:
        row = F.lpad(F.monotonically_increasing_id().cast("string"), 19, "0")
        numbered = batch.withColumns({_TASK: F.spark_partition_id(), _ROW: row})
        numbered.write.partitionBy(_TASK).option("parquet.page.row.count.limit", PAGE).parquet(path)
        self.rows = batch.sparkSession.read.schema(numbered.schema).parquet(path)
        found = self.rows.groupBy(_TASK).agg(F.count("*").alias("n"), F.min(_ROW).alias("low")).orderBy(_TASK).collect()
        self.tasks, self.starts, self.lows, self.count = [], [], [], 0
        for r in found:
            self.tasks.append(r[_TASK])
            self.starts.append(self.count)
            self.lows.append(int(r["low"]))
            self.count += r["n"]

    def place(self, at: int) -> tuple[int, str]:
        """Task and row of a number."""
        i = bisect_right(self.starts, at) - 1
        return self.tasks[i], f"{self.lows[i] + at - self.starts[i]:019d}"

    def part(self, low: int, high: int) -> DataFrame:
        """Records from low to high - 1."""
        (first, start), (last, end) = self.place(low), self.place(high - 1)
        return self.rows.where(f"{_TASK} BETWEEN {first} AND {last} AND {_ROW} BETWEEN '{start}' AND '{end}'").drop(_TASK, _ROW)


def bad_records(
    rows: DataFrame | Callable[[int, int], DataFrame],
    count: int,
    attempt: Callable[[DataFrame], None],
    tries: int = TRIES,
    most: int = MOST_DEAD,
    threads: int = THREADS,
) -> list[Failure]:
    """The records on which ``attempt`` fails, found by halving what fails.

    ``rows`` are numbered from 0 to ``count`` - 1 in ``_at``, or a function that gives those from low to high - 1. A half is not tried where the outcome follows: if the whole failed and the first half
    did not, the second must. Parts so small that they seldom hold two bad records are searched for their first one, and what lies behind it is tried as one part; so each level costs
    one attempt there. A single record is tried ``tries`` times. ``threads`` attempts run at a time; more than ``most`` bad records raise :class:`TooManyBadRecords`.
    """
    part = rows if callable(rows) else lambda low, high: rows.where(F.col(_AT).between(low, high - 1)).drop(_AT)

    def error_of(low: int, high: int) -> str | None:
        try:
            attempt(part(low, high))
        except Exception as error:  # whatever a record may cause
            return str(error).partition("\n")[0] or type(error).__name__
        return None

    def judge(low: int, high: int, known_bad: bool) -> Failure | bool:
        """Whether the records from low to high - 1 have a bad one among them; the failure itself if it stands alone."""
        if high - low > 1:
            return known_bad or error_of(low, high) is not None
        for turn in range(1, tries + 1):
            error = error_of(low, high)
            if error is None:
                return False
        return Failure(low, turn, error)

    def halved(low: int, high: int) -> list[tuple[int, int, Failure | bool]]:
        """Both halves of what failed, with what became of them."""
        middle = (low + high) // 2
        first = judge(low, middle, False)
        return [(low, middle, first), (middle, high, judge(middle, high, not first))]

    def first_bad(low: int, high: int) -> list[tuple[int, int, Failure | bool]]:
        """The first bad record of what failed, and all that follows it, with what became of them; what comes before it holds."""
        end, outcome = high, True
        while high - low > 1:
            middle = (low + high) // 2
            outcome = judge(low, middle, False)
            low, high = (low, middle) if outcome else (middle, high)
        if not isinstance(outcome, Failure):
            outcome = judge(low, high, True)
        rest = [(high, end, judge(high, end, False))] if high < end else []
        return [(low, high, outcome), *rest]

    def split(low: int, high: int) -> list[tuple[int, int, Failure | bool]]:
        return (first_bad if high - low <= count // most else halved)(low, high)

    found: list[Failure] = []
    session = SparkSession.active()
    with ThreadPoolExecutor(threads) as pool:
        # The smallest parts come first, so that bad records stand alone, and too many are noticed, before all large parts were tried.
        whole = judge(0, count, False) if count else False
        found += [whole] if isinstance(whole, Failure) else []
        open_, running = [(0, count)] if whole is True else [], set()
        while open_ or running:
            while open_ and len(running) < threads:
                running.add(pool.submit(inheritable_thread_target(session)(split), *open_.pop()))
            done, running = wait(running, return_when=FIRST_COMPLETED)
            each = [x for future in done for x in future.result()]
            found += [x for _, _, x in each if isinstance(x, Failure)]
            if len(found) > most:
                raise TooManyBadRecords(f"more than {most} records fail, the last with: {found[-1].error}")
            open_ += [(low, high) for low, high, x in each if x is True]
    return sorted(found, key=lambda f: f.at)


def bisected(batch: DataFrame, work: Callable[[DataFrame], DataFrame], tries: int = TRIES, most: int = MOST_DEAD) -> Sorted:
    """Process a micro-batch with ``work``, a transformation of its records, and set aside those that make it fail.

    ``work`` is first run on the whole batch, and in the usual case that is all. The batch is then written with numbers, halves of
    it are tried, and ``work`` is run on what is left without the bad records. The results are written, so they are
    not computed again; what was written goes with the caller's ``staged_since``. A fault that passes, such as a service that was
    away, leaves no record aside.
    """
    spark = batch.sparkSession
    out = passing_path(spark, "processed")
    blank = {"tries": F.lit(0).cast("int"), "error": F.lit(None).cast("string")}
    try:
        work(batch).write.parquet(out)
        dead = spark.createDataFrame([], batch.schema).withColumns(blank)
    except Exception:
        discard(spark, out)
        numbered = passing_path(spark, "numbered")
        parts = _Numbered(batch, numbered)
        failures = bad_records(parts.part, parts.count, lambda part: work(part).write.format("noop").mode("overwrite").save(), tries, most)
        told = [(*parts.place(f.at), f.tries, f.error) for f in failures]
        told = spark.createDataFrame(told, f"{_TASK} int, {_ROW} string, tries int, error string")
        apart = passing_path(spark, "dead")
        parts.rows.join(F.broadcast(told), [_TASK, _ROW]).drop(_TASK, _ROW).write.parquet(apart)
        left = parts.rows.join(F.broadcast(told), [_TASK, _ROW], "left_anti")
        work(left.drop(_TASK, _ROW)).write.parquet(out)
        discard(spark, numbered)
        dead = spark.read.parquet(apart)
    good = spark.read.parquet(out)
    return Sorted(good, dead)
