"""Change records as text, and keyed topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.changes import unwrap_capture
from millrace.operators.versions import latest_by_key
from millrace.schemas import CHANGE, RULE_CHANGE
from millrace.sources.text import typed


def read_changes(df: DataFrame, value: str = "value") -> DataFrame:
    """Change records of the business database; unreadable text gives null columns."""
    return typed(df, CHANGE, "json", value)


def with_change_time(df: DataFrame, delay: str = "3 seconds") -> DataFrame:
    """Event time ``et`` of change records, which count in seconds."""
    return df.withColumn("et", F.timestamp_seconds(F.col("ts").cast("bigint"))).withWatermark("et", delay)


def read_rule_changes(df: DataFrame, value: str = "value") -> DataFrame:
    """Captured changes of the configuration table as rules with their ``op``."""
    return unwrap_capture(typed(df, RULE_CHANGE, "json", value))


def keyed_topic(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "value") -> DataFrame:
    """Newest record per key of a keyed topic; a null value deletes its key."""
    return latest_by_key(df, keys, order, deleted=F.col(value).isNull())
