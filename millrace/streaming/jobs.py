"""The summaries on streams, and how to run them.

Input rows carry an event time ``ts``; each job sets the watermark, keeps the
state its batch form computes with aggregates, and ends in a window sum that is
emitted once the window is past.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.text import words
from millrace.operators import summaries as batch
from millrace.operators.dims import Hop, enrich
from millrace.operators.windows import DISORDER, WINDOW, stamp, sum_by_window, tumble
from millrace.streaming.sinks import BatchWriter, append_to
from millrace.streaming.stateful import day_visits, revision_changes


def timed(df: DataFrame, delay: str = DISORDER, ts: str = "ts") -> DataFrame:
    return df.withWatermark(ts, delay)


def _one():
    return F.lit(1).cast("bigint")


def keyword_window(pages: DataFrame, width: str = WINDOW, split=words) -> DataFrame:
    return batch.keyword_window(timed(pages), width, split)


def register_window(users: DataFrame, width: str = WINDOW) -> DataFrame:
    return batch.register_window(timed(users), width)


def page_view_window(pages: DataFrame, width: str = WINDOW, order: Sequence[str] = ("ts",)) -> DataFrame:
    pages = timed(pages)
    visits = day_visits(pages, ["mid"], width, order, batch.PAGE_DIMS, forget=True)
    return sum_by_window(
        batch.page_view_parts(pages, visits), batch.PAGE_DIMS, ["uv_ct", "sv_ct", "pv_ct", "dur_sum"], width
    )


def home_detail_uv_window(pages: DataFrame, width: str = WINDOW) -> DataFrame:
    visits = day_visits(timed(batch.home_detail_pages(pages)), ["mid", "page_id"], width, forget=True)
    return sum_by_window(batch.home_detail_parts(visits), (), ["home_uv_ct", "good_detail_uv_ct"], width)


def login_window(pages: DataFrame, width: str = WINDOW) -> DataFrame:
    visits = day_visits(timed(batch.logins(pages)), ["uid"], width)
    parts = visits.select("ts", F.col("is_back").alias("back_ct"), _one().alias("uu_ct"))
    return sum_by_window(parts, (), ["back_ct", "uu_ct"], width)


def cart_uu_window(carts: DataFrame, width: str = WINDOW) -> DataFrame:
    visits = day_visits(timed(carts), ["user_id"], width, forget=True)
    return stamp(visits.groupBy(tumble("ts", width)).agg(F.count("*").alias("cart_add_uu_ct")))


def _unique_and_new(rows: DataFrame, unique: str, new: str, width: str) -> DataFrame:
    visits = day_visits(timed(rows), ["user_id"], width)
    parts = visits.select("ts", _one().alias(unique), F.col("first_ever").alias(new))
    return sum_by_window(parts, (), [unique, new], width)


def payment_window(payments: DataFrame, width: str = WINDOW) -> DataFrame:
    return _unique_and_new(payments, "payment_suc_unique_user_count", "payment_suc_new_user_count", width)


def order_window(orders: DataFrame, width: str = WINDOW) -> DataFrame:
    return _unique_and_new(orders, "order_unique_user_count", "order_new_user_count", width)


def sku_order_window(
    details: DataFrame, order: Sequence[str], hops: Sequence[Hop] = (), key: str = "sku_id", width: str = WINDOW
) -> DataFrame:
    """A cancelling row whose window is past is dropped, as the window has been reported."""
    net = revision_changes(timed(details), "order_detail_id", order, batch.SKU_AMOUNTS, "ts")
    sums = net.groupBy(tumble("ts", width), *dict.fromkeys((key, "sku_id"))).agg(
        *[F.sum(m).alias(m) for m in batch.SKU_AMOUNTS]
    )
    return enrich(stamp(sums), hops)


def province_order_window(
    details: DataFrame, order: Sequence[str], hops: Sequence[Hop] = (), width: str = WINDOW
) -> DataFrame:
    net = revision_changes(timed(details), "order_detail_id", order, ["order_amount"], "ts")
    return batch.province_sums(net, hops, width)


def refund_window(refunds: DataFrame, before: Sequence[Hop], after: Sequence[Hop] = (), carry=(), width: str = WINDOW):
    return batch.refund_window(timed(refunds), before, after, carry, width)


def refire_counts(rows: DataFrame, keys: Sequence[str] = (), width: str = WINDOW, hold: str = "6 seconds") -> DataFrame:
    """Window counts that are sent again when a row comes in the grace.

    For ``update`` mode: ``hold`` is disorder plus grace, and the reader keeps
    the last version of each window.
    """
    return stamp(timed(rows, hold).groupBy(tumble("ts", width), *keys).agg(F.count("*").alias("n")))


def start(
    df: DataFrame, checkpoint: str, write: BatchWriter | None = None, path: str | None = None,
    mode: str = "append", every: str | None = None, partitions: int | None = None,
) -> StreamingQuery:
    """Run a job into a batch writer, or into numbered folders below ``path``.

    With ``every`` the job runs on; without it takes what is there and ends.
    ``partitions`` is the number of state partitions, fixed at the first start.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(write or append_to(path)).trigger(**trigger)
    conf, name = df.sparkSession.conf, "spark.sql.shuffle.partitions"
    usual = conf.get(name)
    conf.set(name, str(partitions or usual))
    try:
        return writer.start()
    finally:
        conf.set(name, usual)


def run(df: DataFrame, checkpoint: str, **options) -> None:
    """Run a job over what is there."""
    start(df, checkpoint, **options).awaitTermination()
