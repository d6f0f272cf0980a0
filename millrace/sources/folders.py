"""Folders of any store that Spark reaches: list, look up, delete."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _at(spark, path)
    return store.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, in order; none if there is no such folder."""
    store, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(place)) if store.exists(place) else []


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder and what is below it."""
    store, place = _at(spark, path)
    return store.delete(place, True)
