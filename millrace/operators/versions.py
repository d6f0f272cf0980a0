"""Many versions of a row under one key: latest version, netting, compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.scale import join_per_key


def latest_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: Column | None = None
) -> DataFrame:
    """The newest row per key; keys whose newest row is a delete are left out.

    An aggregate, not a row number: each task keeps one row per key before the
    shuffle, so a key with many versions costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*rest, *([deleted.alias("_deleted")] if deleted is not None else []))
    newest = df.groupBy(*keys).agg(F.max_by(packed, F.struct(*order)).alias("_row"))
    if deleted is not None:
        newest = newest.filter(~F.coalesce(F.col("_row._deleted"), F.lit(False)))
    return newest.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def mark_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], into: str = "is_latest"
) -> DataFrame:
    """Flag the newest version of each key; ``order`` must be unique within a key."""
    place = F.struct(*order)
    newest = df.groupBy(*keys).agg(F.max(place).alias("_newest"))
    marked = join_per_key(df, newest, keys)
    return marked.withColumn(into, place == F.col("_newest")).select(*df.columns, into)


def revision_changes(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amounts: Sequence[str]
) -> DataFrame:
    """Every version, and the negated copy of every version that was replaced.

    The negated copy keeps the time of the version it cancels, so both fall in
    the same window and the sum per key is that of its newest version.
    """
    marked = mark_latest(df, keys, order, "_latest")
    signs = F.when(F.col("_latest"), F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(-1)))
    signed = marked.select("*", F.explode(signs).alias("sign"))
    return signed.select(
        *[(F.col(c) * F.col("sign")).alias(c) if c in amounts else c for c in df.columns], "sign"
    )


def net_amounts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amounts: Sequence[str]
) -> DataFrame:
    """One row per version with its net contribution: replaced versions count zero.

    Sums the same as ``revision_changes`` with half the rows, and keeps the rows
    of replaced versions for the counts that include them.
    """
    marked = mark_latest(df, keys, order, "_latest")
    keep = [
        F.when(F.col("_latest"), F.coalesce(c, F.lit(0))).otherwise(F.lit(0)).cast(df.schema[c].dataType).alias(c)
        if c in amounts
        else c
        for c in df.columns
    ]
    return marked.select(*keep)


def sums_of_newest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amounts: Sequence[str], groups: Sequence[str]
) -> DataFrame:
    """Sums per group over the newest version of each key.

    Groups that only replaced versions fall into are kept, with zero. The same
    sums as over ``net_amounts``, without joining every row to its newest
    version: one narrow row per key is shuffled, and one per group.
    """
    kinds = {c: df.schema[c].dataType for c in amounts}
    carried = F.struct(*dict.fromkeys([*groups, *amounts]))
    newest = df.groupBy(*keys).agg(F.max_by(carried, F.struct(*order)).alias("_row"))
    newest = newest.select(*[F.col("_row")[c].alias(c) for c in groups], *[F.coalesce(F.col("_row")[c], F.lit(0)).cast(k).alias(c) for c, k in kinds.items()])
    # The sums' own first step makes one row of a group's zeros in every task.
    seen = df.select(*groups, *[F.lit(0).cast(k).alias(c) for c, k in kinds.items()])
    return newest.unionByName(seen).groupBy(*groups).agg(*[F.sum(c).alias(c) for c in amounts])


def compact_summary(df: DataFrame, dims: Sequence[str], version: str = "ts") -> DataFrame:
    """Keep the row with the highest version per window and dimensions."""
    return latest_by_key(df, ["stt", "edt", *dims], [version])
