"""Database change records: cleaning, unwrapping and selecting.

A log comes in one of two forms. In the record form ``data`` and ``old`` are
maps. A log kept per source table may be flat: the row's columns stand for
themselves and ``old_x`` holds the former value of ``x``; there Spark can prune
columns and push filters into the scan, which it cannot do through a map.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Status codes of the order life cycle.
CANCELLED, REFUNDING, REFUNDED = "1003", "1005", "1006"
REFUND_DONE = "0705"


def _new(log: DataFrame, name: str) -> Column:
    return F.col("data")[name] if "data" in log.columns else F.col(name)


def _old(log: DataFrame, name: str) -> Column:
    return F.col("old")[name] if "data" in log.columns else F.col(f"old_{name}")


def clean_changes(df: DataFrame, database: str | None = None) -> DataFrame:
    """Usable inserts and updates of a log in record form; ``bootstrap-insert`` is an insert."""
    kind = F.regexp_replace("type", "bootstrap-", "")
    usable = F.col("table").isNotNull() & kind.isin("insert", "update") & (F.size("data") > 0)
    if database is not None:
        usable = usable & (F.col("database") == database)
    return df.filter(usable).withColumn("type", kind)


def unwrap_capture(df: DataFrame) -> DataFrame:
    """Captured change ``{op, before, after}`` to the row it speaks of, with ``op`` kept."""
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    rest = [c for c in df.columns if c not in ("op", "before", "after")]
    return df.select(row.alias("_row"), "op", *rest).select("_row.*", "op", *rest)


def select_changes(
    df: DataFrame,
    table: str,
    columns: Sequence[str] | Mapping[str, str],
    types: Sequence[str] | None = ("insert",),
    changed: str | None = None,
    to: str | Sequence[str] | None = None,
    database: str | None = None,
    keep: Sequence[str] = ("ts",),
) -> DataFrame:
    """Typed rows of one source table.

    ``types=None`` takes every kind. ``changed`` asks for an update that touched
    the column, ``to`` for the value (or one of the values) it ended with. ``columns`` may map the
    wanted name to the source name.
    """
    wanted = F.col("table") == table
    if database is not None:
        wanted = wanted & (F.col("database") == database)
    if types is not None:
        wanted = wanted & F.col("type").isin(*types)
    if changed is not None:
        wanted = wanted & _old(df, changed).isNotNull()
        if to is not None:
            wanted = wanted & _new(df, changed).isin(*([to] if isinstance(to, str) else to))
    names = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    return df.filter(wanted).select(*[_new(df, s).alias(n) for n, s in names.items()], *keep)


def status_changes(df: DataFrame, columns, to: str | Sequence[str], database: str | None = None) -> DataFrame:
    """Orders whose status moved to ``to``, or to one of them."""
    return select_changes(df, "order_info", columns, ("update",), "order_status", to, database)


def refund_records(df: DataFrame, table: str, columns, strict: bool = False, database: str | None = None) -> DataFrame:
    """Refund rows of any kind; ``strict`` takes only those whose refund was completed by an update."""
    if strict:
        return select_changes(df, table, columns, ("update",), "refund_status", REFUND_DONE, database)
    return select_changes(df, table, columns, None, database=database)


def cart_additions(df: DataFrame, database: str | None = None) -> DataFrame:
    """Items put into carts: new rows whole, grown rows by the difference."""
    new, old = _new(df, "sku_num").cast("int"), _old(df, "sku_num").cast("int")
    grown = (F.col("type") == "update") & old.isNotNull() & (new > old)
    wanted = (F.col("table") == "cart_info") & ((F.col("type") == "insert") | grown)
    if database is not None:
        wanted = wanted & (F.col("database") == database)
    added = F.when(F.col("type") == "insert", new).otherwise(new - old)
    fields = ("id", "user_id", "sku_id", "cart_price", "source_id", "source_type")
    return df.filter(wanted).select(
        *[_new(df, f).alias(f) for f in fields], added.alias("sku_num"), "ts"
    )


def prune_columns(data: Column, listed: Column, kind: Column, tag: str = "op_type") -> Column:
    """Entries of a row map whose names are listed, and the kind of operation as ``tag``."""
    kept = F.map_filter(data, lambda k, _: F.array_contains(listed, k) & (k != tag))
    return F.map_concat(kept, F.create_map(F.lit(tag), kind))
