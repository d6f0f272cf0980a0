"""Sinks. Each writes one batch under its number, so a repeated batch replaces itself."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.columns import rename_columns
from millrace.operators.versions import latest_by_key
from millrace.session import shuffles_go

BatchWriter = Callable[[DataFrame, int], None]
BATCH = "batch_id"


def as_text(df: DataFrame, *keep: str) -> DataFrame:
    """Rows as JSON text in ``value``; ``keep`` columns stay outside the text."""
    packed = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.to_json(F.struct(*packed)).alias("value"))


#: How stored text is compressed; its readers know by the files' names.
TEXT_CODEC = "gzip"


def write_text(df: DataFrame, path: str) -> None:
    """Lines of ``value`` in compressed files. What the write has shuffled goes as it ends."""
    with shuffles_go(df.sparkSession):
        df.write.option("compression", TEXT_CODEC).text(path)


def text_stream(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """JSON lines in files; with the checkpoint every row lands exactly once."""
    writer = as_text(df).writeStream.format("text").outputMode("append")
    return writer.option("path", path).option("checkpointLocation", checkpoint)


def topic_stream(df: DataFrame, servers: str, checkpoint: str, topic: str | None = None) -> DataStreamWriter:
    """JSON text to a topic, or to the topic each row names in ``sink_table``.

    Spark's Kafka sink writes at least once; readers drop repeats by key.
    """
    rows = as_text(df) if topic else as_text(df, "sink_table").withColumnRenamed("sink_table", "topic")
    writer = rows.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    if topic:
        writer = writer.option("topic", topic)
    return writer.option("checkpointLocation", checkpoint)


# --- summaries --------------------------------------------------------------


def summary_columns(df: DataFrame, helpers: Sequence[str] = ()) -> DataFrame:
    """Without helper columns, names in snake case."""
    return rename_columns(df.drop(*helpers), "snake")


def append_to(path: str, helpers: Sequence[str] = ()) -> BatchWriter:
    """Append each batch as its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        summary_columns(batch, helpers).write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return write


def jdbc_to(url: str, table: str, rows_per_batch: int = 1024, helpers: Sequence[str] = (), **properties) -> BatchWriter:
    """Append to a database table whose engine keeps the newest ``ts`` per key.

    Each row carries its batch number, so a repeated batch can be told apart.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = summary_columns(batch, helpers).withColumn(BATCH, F.lit(number))
        options = {"url": url, "dbtable": table, "batchsize": str(rows_per_batch), **properties}
        rows.write.format("jdbc").mode("append").options(**options).save()

    return write


# --- keyed tables -----------------------------------------------------------


def upsert_to(path: str, keys: Sequence[str], order: Sequence[str]) -> BatchWriter:
    """Store the newest row per key of each batch; older batches are not rewritten."""

    def write(batch: DataFrame, number: int) -> None:
        latest_by_key(batch, keys, order).write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return write


def read_upserts(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = (), deleted=None, schema: T.StructType | None = None
) -> DataFrame:
    """Newest row per key over all batches. Without ``order`` the later batch wins.

    With the ``schema`` of the rows no file is opened to find it out.
    """
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())]) if schema else None
    stored = (spark.read.schema(full) if full else spark.read).parquet(path)
    return latest_by_key(stored, keys, [*order, BATCH], deleted).drop(BATCH)


def compact_upserts(spark: SparkSession, path: str, target: str, keys: Sequence[str], order: Sequence[str] = ()) -> None:
    """Write the current rows to a new place, below the numbers that a new run gives its batches."""
    read_upserts(spark, path, keys, order).write.mode("overwrite").parquet(f"{target}/{BATCH}=-1")


# --- routed outputs ---------------------------------------------------------


def write_routed(routed: DataFrame, path: str) -> None:
    """One folder of JSON lines per destination."""
    lines = routed.select("sink_table", F.to_json("data").alias("value"))
    # A destination goes to few tasks, a large one to as many as its size asks for.
    lines.hint("rebalance", "sink_table").write.partitionBy("sink_table").mode("overwrite").text(path)


def route_to(path: str) -> BatchWriter:
    return lambda batch, number: write_routed(batch, f"{path}/{BATCH}={number}")


def read_routed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


# --- dimension tables -------------------------------------------------------


def _name(text: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", text):
        raise ValueError(f"not a table or column name: {text!r}")
    return text


APPLIED = "millrace.rule_batch"


def _applied(spark: SparkSession, table: str) -> str | None:
    """Number of the rule batch that made the table."""
    if not spark.catalog.tableExists(table):
        return None
    found = spark.sql(f"show tblproperties {table}").filter(F.col("key") == APPLIED).take(1)
    return found[0]["value"] if found else None


def apply_rules(spark: SparkSession, changes: Iterable[Row], number: int | None = None) -> list[str]:
    """Create and drop dimension tables as their rules change.

    Operations ``r`` and ``c`` create, ``d`` drops, anything else drops and
    creates. All columns are text; batches are partitions. Returns the tables
    touched. A table made by rule batch ``number`` is left alone when that batch
    is repeated, with the rows it has been given since.
    """
    touched: list[str] = []
    done: set[str] = set()
    for rule in changes:
        if rule["sink_type"] != "dim":
            continue
        table = _name(rule["sink_table"])
        if table not in touched and number is not None and _applied(spark, table) == str(number):
            done.add(table)
        touched.append(table)
        if table in done:
            continue
        columns = ", ".join(f"{_name(c)} string" for c in rule["sink_columns"].split(","))
        if rule["op"] not in ("r", "c"):
            spark.sql(f"drop table if exists {table}")
        if rule["op"] != "d":
            spark.sql(f"create table if not exists {table} ({columns}, {BATCH} bigint) using parquet "
                      f"partitioned by ({BATCH}) tblproperties ('{APPLIED}' = '{number}')")
    return touched


def dims_to(rules: DataFrame, order: Sequence[str] = ("ts",)) -> BatchWriter:
    """Upsert each batch of routed records into the dimension tables of the rules.

    The batch is reduced to its newest row per table and key in one pass, which
    also tells the tables it touches; each of those is written in the partition
    of the batch at hand, from the reduced rows.
    """
    targets = rules.filter(F.col("sink_type") == "dim").select("sink_table", "sink_columns", "sink_pk")

    def write(batch: DataFrame, number: int) -> None:
        known = targets.select("sink_table", F.coalesce("sink_pk", F.lit("id")).alias("_pk"))
        keyed = batch.select("sink_table", "data", *order).join(known, "sink_table")
        keyed = keyed.withColumn("_key", F.element_at("data", F.col("_pk"))).drop("_pk")
        held = latest_by_key(keyed, ["sink_table", "_key"], order).persist()
        try:
            touched = targets.join(held.select("sink_table").distinct(), "sink_table", "left_semi")
            for rule in touched.toLocalIterator():
                columns = rule["sink_columns"].split(",")
                rows = held.filter(F.col("sink_table") == rule["sink_table"]).select(*[F.col("data")[c].alias(c) for c in columns])
                target = f"{_name(rule['sink_table'])} partition ({BATCH} = {int(number)})"
                batch.sparkSession.sql(f"insert overwrite table {target} select * from {{rows}}", rows=rows)
        finally:
            held.unpersist()

    return write


def read_dim(spark: SparkSession, table: str, pk: str = "id") -> DataFrame:
    """Current rows of a dimension table."""
    return latest_by_key(spark.table(_name(table)), [pk], [BATCH]).drop(BATCH)
