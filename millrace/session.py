"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that can be changed on a running session. Event times are read in
# one fixed zone; adaptive execution splits the partition of a hot join key.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Of a key that a JSON object repeats, the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Maps are overlaid in order: the last of equal keys counts.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # A measured build side this small per partition is hashed instead of sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    """Apply the settings the transforms rely on to a session made elsewhere."""
    for key, value in {**RUNTIME_CONF, "spark.sql.session.timeZone": time_zone}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def follow_newest_source(spark: SparkSession) -> None:
    """Let the fastest of several joined sources set the watermark.

    For jobs whose sources may fall idle. One source needs nothing: its
    watermark is that of the newest row in any partition.
    """
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")


def local_session(
    cores: int | str = "*", partitions: int = 8, memory: str = "8g", settings: dict[str, str] | None = None
) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The folder reliable checkpoints go to; every executor must see it.

    The folder named by ``spark.checkpoint.dir`` wins. Only a local master may
    go without one, and then gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if context.getCheckpointDir() is None:
        if not named:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="millrace-")
        context.setCheckpointDir(named)
    return named or context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What a write inside has shuffled is removed as it ends, not when the driver's garbage is collected."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
