"""Keyed state in tables, for streams in which one key may be very busy.

Each micro-batch is an ordinary batch job: it reduces its keys before the
shuffle, joins them to what earlier batches stored, and adaptive execution
splits a hot key, which a keyed-state operator cannot do. The tables are written
per batch number and read below it, so a repeated batch sees what it saw before.
Every ``FOLD`` batches they are folded into one, so the number of files a
micro-batch reads does not grow with the age of the stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.logs import clear_flags, first_days
from millrace.operators.versions import latest_by_key, revision_changes
from millrace.streaming.sinks import BATCH, BatchWriter

Fold = Callable[[DataFrame], DataFrame]

#: Batches after which the state is folded into one table.
FOLD = 32


def _fold_path(path: str, upto: int) -> str:
    return f"{path}/fold={upto}"


def _batch_path(path: str, number: int) -> str:
    """Batches stand below the fold they come after, so a batch lists one fold's worth of folders."""
    return f"{path}/after={number - number % FOLD}/{BATCH}={number}"


def _since(spark: SparkSession, path: str, schema: T.StructType, upto: int, before: int) -> DataFrame:
    """What the batches from ``upto`` to below ``before`` stored, with their number."""
    folder = f"{path}/after={upto}"
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{folder}/{BATCH}=-1")
    table = spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(folder)
    return table.filter((F.col(BATCH) >= upto) & (F.col(BATCH) < before))


def _folded(spark: SparkSession, path: str, schema: T.StructType, upto: int, fold: Fold, anew: bool) -> DataFrame:
    """State of all batches below ``upto``; written by the first batch after it, or the first to miss it."""
    if upto <= 0:
        return spark.createDataFrame([], schema)
    target = _fold_path(path, upto)
    if not anew:
        try:
            return spark.read.schema(schema).parquet(target)
        except AnalysisException:
            pass
    earlier = _folded(spark, path, schema, upto - FOLD, fold, False).withColumn(BATCH, F.lit(-1).cast("bigint"))
    fold(earlier.unionByName(_since(spark, path, schema, upto - FOLD, upto))).write.mode("overwrite").parquet(target)
    return spark.read.schema(schema).parquet(target)


def _stored(spark: SparkSession, path: str, schema: T.StructType, before: int, fold: Fold) -> DataFrame:
    """State of the batches before this one: the last fold and at most ``FOLD`` batches since."""
    upto = before - before % FOLD
    base = _folded(spark, path, schema, upto, fold, before == upto)
    both = base.withColumn(BATCH, F.lit(-1).cast("bigint")).unionByName(_since(spark, path, schema, upto, before))
    return fold(both)


def repair_visitors_to(
    path: str, write: BatchWriter, device: str = "mid", is_new: str = "is_new", order: Sequence[str] = ("ts",)
) -> BatchWriter:
    """Repair the new-visitor flag of each batch and pass it on to ``write``."""

    def run(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        try:
            found = first_days(rows, device, is_new, order)
            known = _stored(batch.sparkSession, path, found.schema, number, lambda df: df.drop(BATCH))
            target = _batch_path(path, number)
            found.join(known, device, "left_anti").write.mode("overwrite").parquet(target)
            fresh = batch.sparkSession.read.schema(found.schema).parquet(target)
            days = known.join(rows.select(device), device, "left_semi").unionByName(fresh)
            write(clear_flags(rows, days, device, is_new, order[0]), number)
        finally:
            rows.unpersist()

    return run


def revision_changes_to(
    path: str, write: BatchWriter, keys: Sequence[str], order: Sequence[str], amounts: Sequence[str]
) -> BatchWriter:
    """Pass on the versions of each batch and the negated copies of those they replace."""

    def run(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        try:
            def newest(df: DataFrame) -> DataFrame:
                return latest_by_key(df, keys, [BATCH]).drop(BATCH)

            stored = _stored(batch.sparkSession, path, batch.schema, number, newest)
            held = stored.join(rows.select(*keys).distinct(), list(keys), "left_semi")
            both = held.withColumn("_new", F.lit(False)).unionByName(rows.withColumn("_new", F.lit(True)))
            signed = revision_changes(both, keys, ["_new", *order], amounts)
            write(signed.filter("_new or sign = -1").drop("_new"), number)
            latest_by_key(rows, keys, order).write.mode("overwrite").parquet(_batch_path(path, number))
        finally:
            rows.unpersist()

    return run
