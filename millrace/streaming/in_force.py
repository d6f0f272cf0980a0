"""Rules, dictionaries and other versions in force at a record's own time, on streams.

Versions and records may come in any order within the allowed disorder, also in one
batch. Versions are kept with their times; a record waits until the watermark has reached
it, so that every version before it is there, and is then joined as of its time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.asof import as_of_join
from millrace.operators.windows import DISORDER
from millrace.streaming.holding import hold_to
from millrace.streaming.levels import Levels
from millrace.streaming.sinks import BatchWriter

Parts = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def in_force_to(
    path: str, parts: Parts, keys: Sequence[str], since: str, columns: Sequence[str], write: BatchWriter,
    at: str = "ts", order: Sequence[str] = (), how: str = "inner", delay: str = DISORDER, **options,
) -> BatchWriter:
    """Join records to the version of their key that holds at their time, and pass them on.

    ``parts`` takes a batch to its versions and its records; both need ``keys`` and a
    time (``since``, ``at``). The rest is as for ``as_of_join`` and ``hold_to``. A version
    that comes later than the disorder allows counts for the records after it only.
    """
    def run(batch: DataFrame, number: int) -> None:
        versions, records = parts(batch)
        history = Levels(f"{path}/versions", versions.schema, tuple(keys) + (since, *order))
        history.write(versions, number)

        def joined(due: DataFrame, upto: int) -> None:
            known = history.read_keys(due.sparkSession, due.select(*keys), upto + 1)
            write(as_of_join(due.drop("_version"), known, keys, at, since, columns, order, how), upto)

        # The clock follows versions and records alike; a version is a row without a record.
        marks = versions.select(F.col(since).alias(at), F.lit(True).alias("_version"))
        rows = records.withColumn("_version", F.lit(False)).unionByName(marks, allowMissingColumns=True)
        hold_to(path, lambda due, n: joined(due.filter("not _version"), n), at, delay=delay, **options)(rows, number)
        history.merge(batch.sparkSession)
        history.expire(batch.sparkSession)

    return run
