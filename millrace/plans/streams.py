"""Registered stream queries: the given tables replayed as streams to their end.

A table is replayed in several micro-batches, in the order of its times, with
rows out of order within the disorder that the watermark allows. At its end the
source sends one row far in the future, as an idle source's heartbeat would, so
every window is reported and the SQL is that of the batch form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import changes, facts, summaries
from millrace.plans import adapters as a
from millrace.plans.catalogue import DAY, HOUR, detail_fact, query, show_time
from millrace.plans.oracle import ORACLE, bounds
from millrace.session import scratch_path, shuffles_go
from millrace.sources import folders
from millrace.sources.tables import parquet
from millrace.streaming import jobs, sinks, stateful
from millrace.streaming.loads import split_logs_to
from millrace.streaming.stored import repair_visitors_to

PARTS = 4
FAR = "9999-01-01 00:00:00"


def replay(spark: SparkSession, rows: DataFrame, disorder: int = 0, last: dict[str, object] | None = None, order: str = "ts") -> DataFrame:
    """Rows with an event time as a stream of ``PARTS`` micro-batches.

    A row may come up to ``disorder`` seconds before its time's turn. ``last`` are
    the values of the closing row beside its time; None sends none. The rows are made
    once, and what is written or shuffled on the way goes.
    """
    folder, whole = scratch_path(spark, "replay"), scratch_path(spark, "replayed")
    schema = rows.schema
    with shuffles_go(spark):
        rows.write.parquet(whole)
        replay_parts(spark, spark.read.schema(schema).parquet(whole), folder, disorder, last, order)
    folders.delete(spark, whole)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_core(spark)).parquet(folder)


def replay_parts(spark: SparkSession, rows: DataFrame, folder: str, disorder: int, last: dict[str, object] | None, order: str) -> None:
    """Write the files of a replay, those of a micro-batch one after another."""
    early = F.pmod(F.xxhash64(*[c for c, kind in rows.dtypes if "map<" not in kind]), F.lit(disorder * 1_000_000 + 1))
    when = F.unix_micros(order) - early
    low, high = rows.agg(F.min(when), F.max(when)).first()
    files = per_core(spark)
    if low is not None:
        turn = F.least(F.floor((when - low) / max(1, high - low) * PARTS), F.lit(PARTS - 1))
        for part in range(PARTS):
            rows.filter(turn == part).repartition(files).write.mode("append").parquet(folder)
            # A part of few rows has fewer files; empty ones keep the next part out of its micro-batch.
            there = sum(name.startswith("part-") for name in folders.names(spark, folder))
            for _ in range(files * (part + 1) - there):
                spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(folder)
    if last is not None or low is None:
        closing = {**(last or {}), order: FAR}
        row = [F.lit(closing.get(f.name)).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
        spark.range(1).select(*row).write.mode("append").parquet(folder)


def per_core(spark: SparkSession) -> int:
    """State partitions of a replay: a core each, as every one opens a state store."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(usual, spark.sparkContext.defaultParallelism)


def finished(spark: SparkSession, job: DataFrame, label: str) -> DataFrame:
    """Run the job over the whole table and read what it wrote."""
    path = scratch_path(spark, label)
    jobs.run(job, f"{path}/state", path=f"{path}/rows", partitions=per_core(spark))
    return spark.read.schema(job.schema).parquet(f"{path}/rows").drop(sinks.BATCH)


def finished_by(spark: SparkSession, rows: DataFrame, write: sinks.BatchWriter, path: str, read: bool = True) -> DataFrame | None:
    """Run a batch writer over the whole stream, and read what it stored in ``rows``."""
    jobs.run(rows, f"{path}/state", write=write, partitions=per_core(spark))
    return spark.read.parquet(f"{path}/rows") if read else None


def pages(spark, d) -> DataFrame:
    """Page views in arrival order."""
    views = a.page_views(parquet(spark, d, "events"))
    return replay(spark, views, last={"mid": "-", "page_id": "home", "event_id": -1})


@query
def stream_order_window(spark, d):
    rows = replay(spark, a.buyers(parquet(spark, d, "orders")), 3, {"user_id": -1})
    return finished(spark, jobs.order_window(rows, DAY), "orders")


@query
def stream_payment_window(spark, d):
    paid = parquet(spark, d, "events").filter("event_type = 'purchase'").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return finished(spark, jobs.payment_window(replay(spark, paid, 3, {"user_id": -1}), HOUR), "payments")


@query
def stream_cart_uu_window(spark, d):
    added = changes.cart_additions(a.cart_changes(spark, d), a.DATABASE)
    carts = added.select("user_id", F.timestamp_seconds(F.col("ts").cast("bigint")).alias("ts"))
    return finished(spark, jobs.cart_uu_window(replay(spark, carts, 3, {"user_id": "-"}), HOUR), "carts")


@query
def stream_page_view_window(spark, d):
    return finished(spark, jobs.page_view_window(pages(spark, d), HOUR, ("ts", "event_id")), "pages")


@query
def stream_home_detail_uv_window(spark, d):
    return finished(spark, jobs.home_detail_uv_window(pages(spark, d), HOUR), "home")


@query
def stream_login_window(spark, d):
    rows = replay(spark, a.logins(parquet(spark, d, "orders")), 3, {"uid": "-"})
    return finished(spark, jobs.login_window(rows, DAY), "logins")


@query
def stream_register_window(spark, d):
    users = parquet(spark, d, "events").filter("event_type = 'signup'").select(F.col("ts").cast("timestamp").alias("ts"))
    return finished(spark, jobs.register_window(replay(spark, users, 3, {}), HOUR), "users")


@query
def stream_keyword_window(spark, d):
    typed = a.phrases(parquet(spark, d, "conversations"))
    rows = replay(spark, typed, 3, {"item": "end", "last_page_id": "home", "item_type": "keyword"})
    return finished(spark, jobs.keyword_window(rows), "words")


@query
def stream_refund_window(spark, d):
    """Two-step distinct count on a stream, joined to stored dimensions."""
    back = parquet(spark, d, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_partkey").alias("sku_id"), F.col("l_suppkey").alias("user_id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").cast("timestamp").alias("ts"),
    )
    keys, _ = a.sku_hops(spark, d)
    return finished(spark, jobs.refund_window(replay(spark, back, 3, {"sku_id": -1}), keys, width=DAY), "refunds")


def lines(spark, d, last=None) -> DataFrame:
    return replay(spark, a.order_lines(spark, d), last=last)


@query
def stream_visitor_repair(spark, d):
    """Flags repaired batch by batch, the first days kept in a table."""
    views = a.page_views(parquet(spark, d, "events")).select("event_id", "ts", "mid", "is_new")
    path = scratch_path(spark, "visitors")
    write = repair_visitors_to(f"{path}/days", sinks.append_to(f"{path}/rows"), order=("ts", "event_id"))
    jobs.run(replay(spark, views), f"{path}/state", write=write, partitions=per_core(spark))
    return spark.read.schema(views.schema).parquet(f"{path}/rows").drop("ts", sinks.BATCH)


@query
def stream_revision_netting(spark, d):
    """In time order with no disorder allowed: the watermark follows the newest row."""
    rows = jobs.timed(lines(spark, d), "0 seconds")
    signed = stateful.revision_changes(rows, "order_detail_id", a.REVISION_ORDER, summaries.SKU_AMOUNTS)
    return finished(spark, signed, "revisions").select(
        "order_detail_id", "sku_id", show_time(), *summaries.SKU_AMOUNTS, "sign"
    )


@query
def stream_late_refire(spark, d):
    """Window counts in update mode; the last report of each window is kept."""
    events = parquet(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    path = scratch_path(spark, "refire")
    keys = ["stt", "edt"]
    job = jobs.refire_counts(replay(spark, events, 5), width=HOUR)
    write = sinks.upsert_to(f"{path}/rows", keys, ["n"])
    jobs.run(job, f"{path}/state", write=write, mode="update", partitions=per_core(spark))
    return sinks.read_upserts(spark, f"{path}/rows", keys, schema=job.schema)


@query
def stream_cancel_fact(spark, d):
    """Two streams joined within the time join state is kept, lines of an order spread over salts.

    A line comes within that time of its order's cancellation, as the records of one
    order do; its own times are those of the fact.
    """
    def timed_replay(rows):
        return replay(spark, rows, last={}, order="et").withWatermark("et", "3 seconds")

    cancelled = changes.status_changes(
        a.order_changes(spark, d), ["id", "user_id", "province_id", "operate_time"], changes.CANCELLED
    )
    cancelled = cancelled.withColumn("et", F.timestamp_seconds(F.col("ts").cast("bigint")))
    orders = cancelled.select(F.col("id").alias("order_id"), F.col("et").alias("_near"))
    details = detail_fact(spark, d, orders.select("order_id")).join(orders, "order_id")
    near = F.pmod(F.xxhash64("id"), F.lit(2 * facts.JOIN_STATE_SECONDS)) - facts.JOIN_STATE_SECONDS
    details = details.withColumn("et", F.timestamp_seconds(F.unix_seconds("_near") + near)).drop("_near")
    joined = facts.order_cancel(timed_replay(cancelled), timed_replay(details), within=facts.JOIN_STATE_SECONDS, salts=3)
    return finished(spark, joined, "cancels")


@query
def stream_log_split(spark, d):
    """Raw records split batch by batch into folders, counted by output."""
    events = a.raw_log(parquet(spark, d, "events")).join(
        parquet(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")), "event_id"
    )
    path = scratch_path(spark, "logs")
    jobs.run(replay(spark, events).select("value"), f"{path}/state", write=split_logs_to(f"{path}/rows"), partitions=per_core(spark))
    return spark.read.text(f"{path}/rows").groupBy("output").agg(F.count("*").alias("n"))


for name in ("order", "payment", "cart_uu", "page_view", "home_detail_uv", "login", "register", "keyword"):
    ORACLE[f"stream_{name}_window"] = ORACLE[f"{name}_window"]
ORACLE["stream_refund_window"] = (
    f"select * exclude (category1_name, category2_name, category3_name, trademark_name) from ({ORACLE['refund_window']})"
)
ORACLE["stream_cancel_fact"] = ORACLE["order_cancel_fact"]
ORACLE["stream_log_split"] = f"""
select * from ({ORACLE['log_split_counts']}) where n > 0
union all select 'reject', count(*) from events where event_id % 10 = 9 having count(*) > 0"""
ORACLE["stream_visitor_repair"] = ORACLE["visitor_repair"]
ORACLE["stream_revision_netting"] = ORACLE["revision_netting"]
ORACLE["stream_late_refire"] = f"select {bounds('ts', '1 hour')}, count(*) as n from events group by all"
