"""Stored tables: parquet and JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.functions.columns import rename_columns


def parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parquet_stream(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType, files: int = 1) -> DataFrame:
    """One stored table as a stream; the pattern matches the single file or folder."""
    pattern = f"{sf_dir}/{name}.parque[t]"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(pattern)


def jdbc_options(
    url: str, table: str, properties: Mapping[str, str] | None = None,
    split_on: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 1,
) -> dict[str, str]:
    """Reader options; a numeric column and its bounds read a large table in parallel."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    if split_on is not None:
        if bounds is None:
            raise ValueError("a split read needs the bounds of its column")
        low, high = bounds
        options |= {
            "partitionColumn": split_on, "lowerBound": str(low), "upperBound": str(high),
            "numPartitions": str(parts),
        }
    return options


def jdbc(spark: SparkSession, url: str, table: str, style: str | None = None, **options) -> DataFrame:
    """A database table; ``style='camel'`` renames its columns. Needs the driver jar."""
    df = spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
    return df if style is None else rename_columns(df, style)


def query(spark: SparkSession, sql: str, args: list | dict | None = None, style: str | None = None) -> DataFrame:
    """Rows of a parameterised query over registered tables; ``style`` as for ``jdbc``."""
    df = spark.sql(sql, args=args)
    return df if style is None else rename_columns(df, style)
