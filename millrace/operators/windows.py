"""Event-time windows, watermarks and late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import DATETIME, flag
from millrace.operators.scale import with_position, with_running_max

# Window size, allowed disorder and grace of the summary jobs.
WINDOW = "5 seconds"
DISORDER = "3 seconds"
LATENESS_MS = 3000
DISORDER_MS = 3000


def tumble(ts: str | Column = "ts", width: str = WINDOW) -> Column:
    """Epoch-aligned tumbling window as the group key ``win``."""
    return F.window(ts, width).alias("win")


def millis(interval: str) -> Column:
    """Length of an interval such as '3 seconds'."""
    start = F.lit("2000-01-01 00:00:00").cast("timestamp")
    return F.unix_millis(start + F.expr(f"interval {interval}")) - F.unix_millis(start)


def window_end(ts: str | Column = "ts", width: str = WINDOW) -> Column:
    """End of the tumbling window of a time, as a plain expression; null for no time."""
    wide = millis(width)
    return F.timestamp_millis(((F.floor(F.unix_millis(ts) / wide) + 1) * wide).cast("bigint"))


def stamp(df: DataFrame, run_ts: int | None = None) -> DataFrame:
    """Window bounds as ``stt`` and ``edt`` text; ``run_ts`` adds the version column."""
    rest = [c for c in df.columns if c != "win"]
    bounds = [F.date_format(f"win.{b}", DATETIME).alias(n) for b, n in (("start", "stt"), ("end", "edt"))]
    version = [F.lit(run_ts).cast("bigint").alias("ts")] if run_ts is not None else []
    return df.select(*bounds, *rest, *version)


def sum_by_window(
    df: DataFrame, dims: Sequence[str], measures: Sequence[str], width: str = WINDOW, run_ts: int | None = None
) -> DataFrame:
    """Sum the measures per window and dimensions."""
    sums = df.groupBy(tumble("ts", width), *dims).agg(*[F.sum(m).alias(m) for m in measures])
    return stamp(sums, run_ts)


def watermark_trace(
    df: DataFrame, source: Sequence[str], arrival: Sequence[str], ts_ms: str, delay_ms: int = 0
) -> DataFrame:
    """Watermark each row meets on arrival: largest earlier time, less the delay and 1 ms."""
    return add_watermark(with_running_max(df, source, arrival, ts_ms, "_max"), delay_ms)


def add_watermark(seen: DataFrame, delay_ms: int = 0) -> DataFrame:
    """The watermark from the largest earlier time in ``_max``."""
    return seen.withColumn("watermark", F.col("_max") - F.lit(delay_ms + 1)).drop("_max")


def mark_late(
    df: DataFrame,
    source: Sequence[str],
    arrival: Sequence[str],
    ts_ms: str,
    width_ms: int = 5000,
    disorder_ms: int = DISORDER_MS,
    lateness_ms: int = LATENESS_MS,
) -> DataFrame:
    """Add ``window_end``, ``refire`` and ``late`` as a row meets them on arrival.

    The window of a ``refire`` row had already been reported once; a ``late`` row
    comes after the grace as well and belongs to the side output.
    """
    return add_lateness(with_running_max(df, source, arrival, ts_ms, "_max"), ts_ms, width_ms, disorder_ms, lateness_ms)


def add_lateness(
    seen: DataFrame, ts_ms: str, width_ms: int = 5000, disorder_ms: int = DISORDER_MS, lateness_ms: int = LATENESS_MS
) -> DataFrame:
    """``window_end``, ``refire`` and ``late`` from the largest earlier time in ``_max``."""
    end = (F.floor(F.col(ts_ms) / F.lit(width_ms)) + 1) * F.lit(width_ms)
    closed = F.coalesce(F.col("window_end") + disorder_ms <= F.col("_max"), F.lit(False))
    gone = F.coalesce(F.col("window_end") + disorder_ms + lateness_ms <= F.col("_max"), F.lit(False))
    marked = seen.withColumn("window_end", end.cast("bigint"))
    return marked.withColumn("refire", closed & ~gone).withColumn("late", gone).drop("_max")


def split_late(df: DataFrame, *args, **options) -> tuple[DataFrame, DataFrame]:
    """The rows in time and the side output of rows too late."""
    marked = mark_late(df, *args, **options)
    return marked.filter(~F.col("late")), marked.filter("late")


def refire_counts(marked: DataFrame, width_ms: int = 5000) -> DataFrame:
    """Per window: rows of its first report, corrections sent in the grace, rows lost."""
    on_time = ~F.col("refire") & ~F.col("late")
    counts = marked.groupBy("window_end").agg(
        F.sum(flag(on_time)).alias("first_ct"),
        F.sum(flag(F.col("refire"))).alias("refire_ct"),
        F.sum(flag(F.col("late"))).alias("late_ct"),
    )
    start = F.date_format(F.timestamp_millis(F.col("window_end") - width_ms), DATETIME).alias("stt")
    end = F.date_format(F.timestamp_millis("window_end"), DATETIME).alias("edt")
    final = (F.col("first_ct") + F.col("refire_ct")).alias("final_ct")
    return counts.select(start, end, "first_ct", "refire_ct", "late_ct", final)


def window_rows(
    df: DataFrame,
    columns: Sequence[str],
    order: Sequence[str],
    keys: Sequence[str] = (),
    width: str = WINDOW,
    chunk: int = 1000,
) -> DataFrame:
    """All rows of each window in order, as arrays of at most ``chunk`` rows.

    The chunks of a window, read by number, are its whole list; a window of any
    size never becomes one cell.
    """
    placed = with_position(df.withColumn("win", tumble("ts", width)), ["win", *keys], order, "_pos")
    number = F.floor(F.col("_pos") / F.lit(chunk)).cast("bigint").alias("chunk")
    row = F.struct("_pos", *columns)
    lists = placed.groupBy("win", *keys, number).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    bare = F.transform("rows", lambda r: F.struct(*[r[c].alias(c) for c in columns]))
    return stamp(lists.withColumn("rows", bare))
