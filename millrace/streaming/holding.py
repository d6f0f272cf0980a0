"""Rows of a stream held back until their time has come.

The watermark follows the rows: for one source it is the newest time less the allowed
disorder, for several the least of theirs, where a source that has sent nothing for
``idle`` of processing time no longer counts. What is held, and the clock of every
source, is written as a table per batch; a repeated batch starts from the table before
it, and a batch costs the rows that are held, not the age of the stream.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.windows import DISORDER, WINDOW, millis, window_end
from millrace.sources import folders
from millrace.streaming.sinks import BATCH, BatchWriter

#: Tables of earlier batches that are kept, for a batch that is repeated.
KEEP = 4


class BatchTables:
    """One table per batch below a folder, each replacing the one before."""

    def __init__(self, path: str):
        self.path = path

    def _numbers(self, spark: SparkSession) -> list[int]:
        return sorted(int(n.removeprefix(f"{BATCH}=")) for n in folders.names(spark, self.path) if n.startswith(BATCH))

    def before(self, spark: SparkSession, number: int, schema: T.StructType) -> DataFrame:
        """The table of the newest batch below a number; empty at the start."""
        earlier = [n for n in self._numbers(spark) if n < number]
        if not earlier:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.path}/{BATCH}={earlier[-1]}")

    def write(self, rows: DataFrame, number: int) -> DataFrame:
        """Store a batch's table and read it back; tables that are no longer needed go."""
        spark, target = rows.sparkSession, f"{self.path}/{BATCH}={number}"
        rows.write.mode("overwrite").parquet(target)
        for old in [n for n in self._numbers(spark) if n <= number][:-KEEP]:
            folders.delete(spark, f"{self.path}/{BATCH}={old}")
        return spark.read.schema(rows.schema).parquet(target)


class Clocks:
    """Newest event time and last arrival of every source, and the watermark they give."""

    def __init__(self, path: str, ts: str, delay: str, source: Sequence[str] = (), idle: str | None = None, now: Callable[[], float] = time.time):
        self.table, self.ts, self.delay = BatchTables(path), ts, delay
        self.source, self.idle, self.now = list(source), idle, now

    def advance(self, batch: DataFrame, number: int) -> tuple[int | None, int | None]:
        """Take a batch in; the watermark before and after it, in milliseconds. It never goes back."""
        spark, arrived = batch.sparkSession, int(self.now() * 1000)
        here = F.struct(*[F.col(c).cast("string").alias(c) for c in self.source]) if self.source else F.lit("all")
        fresh = batch.filter(F.col(self.ts).isNotNull()).groupBy(F.to_json(F.struct(here.alias("at"))).alias("source")).agg(
            F.max(F.unix_millis(F.col(self.ts).cast("timestamp"))).alias("top")
        )
        fresh = fresh.select("source", "top", F.lit(arrived).alias("seen"), F.lit(None).cast("bigint").alias("mark"))
        known = self.table.before(spark, number, fresh.schema)
        both = known.unionByName(fresh).groupBy("source").agg(F.max("top").alias("top"), F.max("seen").alias("seen"), F.max("mark").alias("mark"))
        awake = F.lit(True) if self.idle is None else F.lit(arrived) - F.col("seen") < millis(self.idle)
        least = both.agg(F.min(F.when(awake, F.col("top"))) - F.max(millis(self.delay))).scalar()
        stored = self.table.write(both.withColumn("mark", F.greatest("mark", least)), number)
        return known.agg(F.max("mark")).first()[0], stored.agg(F.max("mark")).first()[0]


def hold_to(
    path: str, write: BatchWriter, ts: str = "ts", ripe: Callable[[], Column] | None = None, delay: str = DISORDER,
    source: Sequence[str] = (), idle: str | None = None, late: BatchWriter | None = None, now: Callable[[], float] = time.time,
) -> BatchWriter:
    """Pass rows on to ``write`` once the watermark has reached the time ``ripe`` gives, or ``ts``.

    Rows that come after it has passed are passed on at once, or go to ``late``. Rows
    without a time are left out.
    """
    clocks, held = Clocks(f"{path}/clocks", ts, delay, source, idle, now), BatchTables(f"{path}/held")

    def run(batch: DataFrame, number: int) -> None:
        spark, rows = batch.sparkSession, batch.persist()
        try:
            before, after = clocks.advance(rows, number)
            moment = F.unix_millis((ripe() if ripe else F.col(ts)).cast("timestamp"))
            passed = F.coalesce(moment <= F.lit(before).cast("bigint"), F.lit(False))
            due = F.coalesce(moment <= F.lit(after).cast("bigint"), F.lit(False))
            fresh = rows.filter(moment.isNotNull())
            if late is not None:
                late(fresh.filter(passed), number)
                fresh = fresh.filter(~passed)
            waiting = held.before(spark, number, rows.schema).unionByName(fresh)
            write(waiting.filter(due), number)
            held.write(waiting.filter(~due), number)
        finally:
            rows.unpersist()

    return run


def closed_windows_to(
    path: str, summary: Callable[[DataFrame], DataFrame], write: BatchWriter, ts: str = "ts", width: str = WINDOW, delay: str = DISORDER, **options
) -> BatchWriter:
    """A batch summary over the rows of windows that the watermark has passed.

    Any summary of the batch library that keeps windows apart can be run so on a
    stream: lists of rows, ordered scans, exact distinct counts. Take ``late`` to keep
    rows that come after their window was reported apart.
    """
    def summed(rows: DataFrame, number: int) -> None:
        write(summary(rows), number)

    return hold_to(path, summed, ts, lambda: window_end(ts, width), delay, **options)
