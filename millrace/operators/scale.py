"""Joins and ordered scans that keep working when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def join_per_key(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join many rows to one row per key so that a hot key can be split.

    ``per_key`` usually comes out of a ``groupBy(keys)`` and is already hashed on
    the keys, in which case Spark joins it in place and adaptive execution has no
    plain exchange on that side to re-read for each split. Joining on the hash of
    the keys as well asks for an exchange on both sides, and an oversized
    partition of ``rows`` is then cut into pieces at run time.
    """
    tag = F.xxhash64(*keys)
    joined = rows.withColumn("_tag", tag).join(per_key.withColumn("_tag", tag), [*keys, "_tag"], how)
    return joined.drop("_tag")


def _number(column: str, kind: T.DataType) -> Column:
    """A number that rises with the value, for cutting; strings go by their first bytes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.conv(F.hex(F.rpad(F.substring(F.col(column).cast("binary"), 1, 6), 6, F.lit(b"\0"))), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    return F.col(column).cast("double")


def _ordered_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None) -> DataFrame:
    """Cut the rows into contiguous runs of their order: equal ranges of its first column.

    The ranges lie between the least and the greatest value, which the query
    itself looks up, so a row's slice is the same in every pass and retry and
    nothing runs or is written before the query does. A key with very many rows
    has them in many slices. Values that bunch up make larger slices.
    """
    count = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = _number(order[0], df.schema[order[0]].dataType)
    ends = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    place = F.floor((value - ends["low"]) / (ends["high"] - ends["low"]) * count)
    inside = F.least(F.when(ends["high"] > ends["low"], place).otherwise(0), F.lit(count - 1))
    return df.withColumn("_slice", F.when(value.isNull(), F.lit(-1)).otherwise(inside).cast("bigint"))


def _scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slices: int | None,
    weight: Column,
    combine: Callable[[str], Column],
    into: str,
) -> DataFrame:
    """Combine the weights of all rows before each row within its keys.

    Each slice gets one extra row in front, which carries what the earlier
    slices of the same keys add up to. A key has at most one total per slice, so
    the window over totals stays small, and the rows are shuffled once.
    """
    cut = _ordered_slices(df, keys, order, slices).withColumn("_w", weight)
    totals = cut.groupBy(*keys, "_slice").agg(combine("_w").alias("_w"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.withColumn("_w", combine("_w").over(earlier)).filter("_w is not null")
    rows = cut.withColumn("_row", F.lit(True))
    rows = rows.unionByName(carried.withColumn("_row", F.lit(False)), allowMissingColumns=True)
    within = Window.partitionBy(*keys, "_slice").orderBy("_row", *order)
    scanned = rows.withColumn(into, combine("_w").over(within.rowsBetween(Window.unboundedPreceding, -1)))
    return scanned.filter("_row").drop("_row", "_w", "_slice")


def with_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], into: str = "position", slices: int | None = None
) -> DataFrame:
    """Zero-based place of each row within its keys; ``order`` must be unique there.

    With no keys the place is counted over the whole table, without moving the
    table to one task.
    """
    scanned = _scan(df, keys, order, slices, F.lit(1).cast("bigint"), F.sum, into)
    return scanned.withColumn(into, F.coalesce(into, F.lit(0)).cast("bigint"))


def with_running_max(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    into: str = "max_before",
    slices: int | None = None,
) -> DataFrame:
    """Largest ``value`` among the rows that come before each row within its keys."""
    return _scan(df, keys, order, slices, F.col(value), F.max, into)


def with_running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: Column, combine: Callable[[str], Column], into: str,
    slices: int | None = None,
) -> DataFrame:
    """``combine`` (sum, max, ...) of ``weight`` over the rows before each row within its keys; null for the first."""
    return _scan(df, keys, order, slices, weight, combine, into)
