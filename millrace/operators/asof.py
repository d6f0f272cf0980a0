"""As-of joins: the version of a key that is in force at a row's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.scale import with_running


def as_of_join(
    rows: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, since: str, columns: Sequence[str],
    order: Sequence[str] = (), how: str = "left",
) -> DataFrame:
    """Add the ``columns`` of the newest version of each row's key with ``since`` not after ``at``.

    Versions of one time are ranked by ``order``. Rows and versions are merged in the
    order of time, and the newest version so far is carried along by a prefix scan over
    slices of time, so neither a key with very many rows nor one with very many versions
    meets in one task, and a row meets one version, not all of its key's. Rows without
    one get nulls, or go with ``how='inner'``.
    """
    carried = [c for c in rows.columns if c not in keys]
    held = F.struct(F.col(since).alias("since"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    version = F.struct(held.alias("place"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    left = rows.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*carried).alias("_own"))
    right = versions.select(*keys, F.col(since).alias("_at"), F.lit(0).alias("_kind"), version.alias("_version"))
    merged = left.unionByName(right, allowMissingColumns=True)

    def newest(column: str):
        return F.max_by(column, F.col(f"{column}.place"))

    found = with_running(merged, keys, ["_at", "_kind"], F.col("_version"), newest, "_held").filter("_kind = 1")
    if how == "inner":
        found = found.filter("_held is not null")
    own = [F.col(c) if c in keys else F.col("_own")[c].alias(c) for c in rows.columns]
    return found.select(*own, *[F.col(f"_held.c{i}").alias(c) for i, c in enumerate(columns)])
