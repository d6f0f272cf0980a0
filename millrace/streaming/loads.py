"""Batch writers for the loading jobs: log split, dimension load, fact routing.

Rules are read again for every micro-batch, so a change of configuration counts
from the next batch on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.changes import clean_changes
from millrace.operators.dims import current_rules, route_dims, route_facts
from millrace.operators.logs import tag_records
from millrace.sources.changelog import read_changes
from millrace.streaming.levels import Levels, levels_to
from millrace.streaming.sinks import BATCH, BatchWriter, apply_rules, dims_to, write_routed

Rules = Callable[[SparkSession], DataFrame]


def split_logs_to(path: str, repair: Callable[[DataFrame], DataFrame] | None = None) -> BatchWriter:
    """Raw log text to one folder of JSON lines per output, in one pass.

    Records that do not fit go to the output ``reject`` with the reason.
    ``repair`` may work on the parsed log before it is split.
    """

    def write(batch: DataFrame, number: int) -> None:
        lines = tag_records(batch, repair=repair)
        lines.hint("rebalance", "output").write.partitionBy("output").mode("overwrite").text(f"{path}/{BATCH}={number}")

    return write


def store_rules_to(path: str, order: Sequence[str]) -> BatchWriter:
    """Captured rule changes: create and drop tables in order, and keep the changes.

    Changes reach the driver a partition at a time, for the table statements
    only. A repeated batch does not touch the tables it has made.
    """

    def write(batch: DataFrame, number: int) -> None:
        apply_rules(batch.sparkSession, batch.orderBy(*order).toLocalIterator(), number)
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return write


def stored_rules(path: str, order: Sequence[str]) -> Rules:
    """The rules in force, from the stored changes."""
    return lambda spark: current_rules(spark.read.parquet(path).drop(BATCH), order)


def load_dims(rules: Rules, database: str | None = None) -> BatchWriter:
    """Change record text into the dimension tables of the rules."""

    def write(batch: DataFrame, number: int) -> None:
        current = rules(batch.sparkSession).filter(F.col("sink_type") == "dim")
        records = clean_changes(read_changes(batch), database)
        dims_to(current)(route_dims(records, current), number)

    return write


def route_facts_to(path: str, rules: Rules, database: str | None = None) -> BatchWriter:
    """Change record text to one folder of JSON lines per destination of the rules."""

    def write(batch: DataFrame, number: int) -> None:
        current = rules(batch.sparkSession).filter(F.col("sink_type") != "dim")
        write_routed(route_facts(clean_changes(read_changes(batch), database), current), f"{path}/{BATCH}={number}")

    return write


# Columns of all dimension tables kept as one.
DIM_ROW = "sink_table string, id string, data map<string,string>, ts string"


def dim_levels(path: str, order: Sequence[str] = ("ts",), fan: int = 8) -> Levels:
    """The dimension tables of all rules as one table in levels: the newest row per table and key."""
    return Levels(path, T.StructType.fromDDL(DIM_ROW), ("sink_table", "id"), tuple(order), fan=fan)


def dims_to_levels(table: Levels) -> BatchWriter:
    """Upsert each batch of routed records into all the tables they name, in one job whatever their number."""
    write = levels_to(table)

    def store(batch: DataFrame, number: int) -> None:
        key = F.element_at("data", F.coalesce("sink_pk", F.lit("id")))
        write(batch.select("sink_table", key.alias("id"), "data", "ts"), number)

    return store


def read_dim_levels(spark: SparkSession, table: Levels, name: str, columns: Sequence[str]) -> DataFrame:
    """Current rows of one dimension table; files of the others are not opened."""
    wanted = spark.createDataFrame([(name,)], "sink_table string")
    return table.read_keys(spark, wanted).select(*[F.col("data")[c].alias(c) for c in columns])


def read_dim_row(spark: SparkSession, table: Levels, name: str, key: str, on_missing: str = "error") -> Row | None:
    """One dimension row by its key, out of few files; a missing one is an error, or null."""
    found = table.read_key(spark, name, key).take(1)
    if not found and on_missing == "error":
        raise LookupError(f"no row {key} in {name}")
    return found[0] if found else None
