"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.scale import join_per_key
from millrace.session import checkpoint_root, scratch_path

ASCII_SPACE = r"[^\x20\x09-\x0D]+"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write to the folder all executors share and read it back.

    Cuts the lineage: a lost executor repeats no earlier work, and later passes
    see the same rows.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_batches(spark: SparkSession) -> None:
    """Send texts to Python a thousand at a time: a worker holds one batch and its results."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


@contextmanager
def arrow_rows(spark: SparkSession, count: int) -> Iterator[None]:
    """At most ``count`` rows in a batch for Python, for what is run inside; the setting is put back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(count))
    try:
        yield
    finally:
        spark.conf.set(name, usual)


@contextmanager
def measured_joins(spark: SparkSession) -> Iterator[None]:
    """What is run inside broadcasts a side of a join by its size at run time alone; the settings are put back.

    The planner counts a row for each that an explode is given, and takes a compressed
    file for the size of its rows, so what it holds for small may not fit the driver.
    """
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {name: spark.conf.get(name, None) for name in (planned, measured)}
    spark.conf.set(measured, before[measured] or spark.conf.get(planned))
    spark.conf.set(planned, "-1")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def task_count(spark: SparkSession, size: float, per_task: float) -> int:
    """Partitions so that each holds about ``per_task`` of ``size``, and every core has one."""
    return max(spark.sparkContext.defaultParallelism, -(-int(size) // int(per_task)), 1)


def words_of(text: str | None) -> list[bytes]:
    """Words of the whole text, A-Z in lower case, cut at ASCII white space."""
    return text.encode("utf-8", "replace").translate(LOWER).split() if text else []


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected links (a, b): rows (node, component).

    ``component`` is the smallest node that can be reached. Alternates two star
    steps (every larger neighbour, then every smaller one, is hung on the
    smallest neighbour) until all links are stars around their smallest node;
    they get there in a logarithmic number of rounds. A round is one aggregate per
    node and one join that can split a node with very many links. No node's links
    meet in a task. The aggregate is written by itself: it tells whether a round
    is needed, and is the result if not.
    """
    with measured_joins(edges.sparkSession):
        links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        links = settle(links.filter("a <> b").distinct(), "links")
        for _ in range(max_rounds):
            both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count_if(F.col("b") < F.col("a")).alias("up"), F.count("*").alias("n"))
            low = settle(low, "lowest")
            if not low.filter("up > 1 or up = 1 and n > 1").limit(1).count():
                return low.select(F.col("a").alias("node"), F.col("m").alias("component"))
            large = join_per_key(both, low.select("a", "m"), ["a"], "inner").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            large = large.filter("a <> b")
            low = large.groupBy("a").agg(F.min("b").alias("m"))
            moved = join_per_key(large, low, ["a"], "inner")
            # Larger node stays on the minimum; the other smaller neighbours follow it there.
            links = moved.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            links = settle(links.unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "links")
    raise RuntimeError(f"links did not settle in {max_rounds} rounds")
