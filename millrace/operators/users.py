"""Per-key history: first row of a day, first ever, returning after a gap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import flag

RETURN_DAYS = 7


def first_of_day(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Earliest time of each key on each day.

    A minimum, so tasks reduce a busy key to one row per day before the shuffle.
    """
    return df.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.min(ts).alias(ts))


def first_row_of_day(df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Whole first row of each key on each day; ``order`` leads with the time."""
    day = F.to_date(order[0]).alias("day")
    rest = [c for c in carry if c not in order]
    first = df.groupBy(*keys, day).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*keys, "day", *[F.col("_first")[c].alias(c) for c in (*order, *rest)])


def mark_new(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``is_new`` is 1 on the first day of a key. One row per key and day comes in."""
    whole = Window.partitionBy(*keys)
    return days.withColumn("is_new", flag(F.col("day") == F.min("day").over(whole)))


def mark_returning(days: DataFrame, keys: Sequence[str], gap: int = RETURN_DAYS) -> DataFrame:
    """``is_back`` is 1 when the key was last seen more than ``gap`` days before."""
    past = Window.partitionBy(*keys).orderBy("day")
    away = F.datediff("day", F.lag("day").over(past))
    return days.withColumn("is_back", flag(F.coalesce(away > gap, F.lit(False))))
