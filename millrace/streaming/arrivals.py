"""What a row of a stream meets on arrival: the watermark of its source, and whether it is late.

The largest time of every source is carried from batch to batch, so rows are marked as
if the stream were one table in arrival order, wherever its batches are cut.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.scale import join_per_key, with_running_max
from millrace.operators.windows import add_lateness, add_watermark
from millrace.streaming.holding import BatchTables
from millrace.streaming.sinks import BATCH, BatchWriter


def arrivals_to(
    path: str, mark: Callable[[DataFrame], DataFrame], write: BatchWriter, source: Sequence[str], arrival: Sequence[str], ts_ms: str
) -> BatchWriter:
    """Give each row ``_max``, the largest time of its source before it, for ``mark`` to use, and pass the rows on.

    ``arrival`` orders the rows of a source within a batch; batches follow each other.
    """
    tops = BatchTables(path)

    def run(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        try:
            here = rows.groupBy(*source).agg(F.max(ts_ms).alias("_top"))
            known = tops.before(batch.sparkSession, number, here.schema)
            seen = with_running_max(rows, source, arrival, ts_ms, "_here")
            carried = join_per_key(seen, known, source)
            marked = mark(carried.withColumn("_max", F.greatest("_here", "_top")).drop("_here", "_top"))
            write(marked, number)
            tops.write(known.unionByName(here).groupBy(*source).agg(F.max("_top").alias("_top")), number)
        finally:
            rows.unpersist()

    return run


def watermark_trace_to(path: str, write: BatchWriter, source, arrival, ts_ms: str, delay_ms: int = 0) -> BatchWriter:
    """Rows with the watermark they meet; the stream form of ``windows.watermark_trace``."""
    return arrivals_to(path, lambda seen: add_watermark(seen, delay_ms), write, source, arrival, ts_ms)


def split_late_to(path: str, out: str, source, arrival, ts_ms: str, **options) -> BatchWriter:
    """Rows in time and rows too late, in one pass, below ``out``: the stream form of ``windows.split_late``.

    A batch is a folder with ``late=true`` for the side output and ``late=false`` for the rest.
    """
    def write(marked: DataFrame, number: int) -> None:
        marked.write.partitionBy("late").mode("overwrite").parquet(f"{out}/{BATCH}={number}")

    return arrivals_to(path, lambda seen: add_lateness(seen, ts_ms, **options), write, source, arrival, ts_ms)
