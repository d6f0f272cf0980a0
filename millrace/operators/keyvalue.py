"""Key-value views of a table: last value, list, members, ranked members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.scale import with_position
from millrace.operators.versions import latest_by_key


def as_json(df: DataFrame, columns: Sequence[str], into: str = "value") -> DataFrame:
    return df.withColumn(into, F.to_json(F.struct(*columns)))


def last_value(df: DataFrame, key: str, order: Sequence[str], value: str = "value") -> DataFrame:
    """One value per key; the last write wins."""
    return latest_by_key(df.select(key, *[c for c in order if c != key], value), [key], order).select(key, value)


def pushed_list(
    df: DataFrame, key: str, order: Sequence[str], value: str = "value", chunk: int = 1000
) -> DataFrame:
    """Values in the order they were pushed, as arrays of at most ``chunk`` entries."""
    placed = with_position(df.select(key, *order, value), [key], order, "_pos")
    number = F.floor(F.col("_pos") / F.lit(chunk)).cast("bigint").alias("chunk")
    lists = placed.groupBy(key, number).agg(F.sort_array(F.collect_list(F.struct("_pos", value))).alias("_rows"))
    return lists.select(key, "chunk", F.col("_rows")[value].alias("items"))


def members(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).dropDuplicates()


def ranked_members(df: DataFrame, member: str, score: str, order: Sequence[str]) -> DataFrame:
    """Members by score, then by name; a repeated member counts with its last score."""
    last = latest_by_key(df.select(member, score, *[c for c in order if c not in (member, score)]), [member], order)
    return with_position(last.select(member, score), [], [score, member], "place")
