"""Column expressions shared by the transforms."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE = "yyyy-MM-dd"
DATETIME = "yyyy-MM-dd HH:mm:ss"


def millis_to_time(ms) -> Column:
    return F.timestamp_millis(F.col(ms) if isinstance(ms, str) else ms)


def seconds_to_time(seconds) -> Column:
    """Change records count in seconds; the column may be text."""
    return F.timestamp_seconds((F.col(seconds) if isinstance(seconds, str) else seconds).cast("bigint"))


def millis_to_date(ms) -> Column:
    return F.date_format(millis_to_time(ms), DATE)


def millis_to_datetime(ms) -> Column:
    return F.date_format(millis_to_time(ms), DATETIME)


def now_millis() -> Column:
    """Time of the batch, for version columns."""
    return F.unix_millis(F.current_timestamp())


def date_to_millis(text) -> Column:
    return F.unix_millis(F.to_timestamp(text, DATE))


def date_id(text) -> Column:
    """Day of a datetime string."""
    return F.date_format(F.to_timestamp(text), DATE)


def flexible_time(value) -> Column:
    """Epoch milliseconds or a datetime string, whichever the producer sent."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    digits = F.when(text.rlike("^[0-9]+$"), text)
    return F.coalesce(F.timestamp_millis(digits.try_cast("bigint")), F.try_to_timestamp(text))


def blank(col) -> Column:
    return F.coalesce(col, F.lit("")) == ""


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def overlay(*maps: Column, kind: str = "map<string,string>") -> Column:
    """Merge maps left to right; where a key repeats, the later map wins.

    Needs the session setting of ``configure`` by which the last of equal keys counts.
    """
    empty = F.create_map().cast(kind)
    return F.map_concat(*[F.coalesce(m, empty) for m in maps])


def to_snake(name: str) -> str:
    return re.sub(r"(?<=.)([A-Z])", r"_\1", name).lower()


def to_camel(name: str) -> str:
    head, *rest = name.lower().split("_")
    return head + "".join(part.capitalize() for part in rest)


def rename_columns(df: DataFrame, style: str) -> DataFrame:
    """All columns in ``snake`` or ``camel`` case."""
    convert = {"snake": to_snake, "camel": to_camel}[style]
    return df.toDF(*[convert(c) for c in df.columns])
