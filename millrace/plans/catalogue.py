"""Registered queries: each operator over the given tables.

A query takes ``(spark, sf_dir)`` and returns a DataFrame whose columns are
text and integers, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as words
from millrace.functions.columns import (
    DATETIME, date_to_millis, flag, millis_to_date, millis_to_datetime, now_millis, rename_columns,
)
from millrace.operators import changes, dims, facts, keyvalue, logs, summaries, versions, windows
from millrace.operators.dims import Hop
from millrace.plans import adapters as a
from millrace.schemas import ORDER_DETAIL_FACT
from millrace.session import configure, scratch_path
from millrace.sources.changelog import keyed_topic, read_changes
from millrace.sources.tables import parquet
from millrace.sources.text import sensor_lines, text_files, typed
from millrace.streaming import sinks

HOUR, DAY = "1 hour", "1 day"
HOUR_MS = 3_600_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def show_time(col: str = "ts"):
    return F.date_format(col, DATETIME).alias(col)


# --- window summaries -------------------------------------------------------


@query
def order_window(spark, d):
    return summaries.order_window(a.buyers(parquet(spark, d, "orders")), DAY)


@query
def payment_window(spark, d):
    events = parquet(spark, d, "events").filter("event_type = 'purchase'")
    return summaries.payment_window(events.select("user_id", F.col("ts").cast("timestamp").alias("ts")), HOUR)


@query
def cart_uu_window(spark, d):
    added = changes.cart_additions(a.cart_changes(spark, d), a.DATABASE)
    return summaries.cart_uu_window(added.withColumn("ts", F.timestamp_seconds(F.col("ts").cast("bigint"))), HOUR)


@query
def register_window(spark, d):
    events = parquet(spark, d, "events").filter("event_type = 'signup'")
    return summaries.register_window(events.select(F.col("ts").cast("timestamp").alias("ts")), HOUR)


@query
def page_view_window(spark, d):
    return summaries.page_view_window(a.page_log(spark, d), HOUR, ("ts", "event_id"))


@query
def home_detail_uv_window(spark, d):
    return summaries.home_detail_uv_window(a.page_log(spark, d), HOUR)


@query
def login_window(spark, d):
    return summaries.login_window(a.logins(parquet(spark, d, "orders")), DAY)


@query
def keyword_window(spark, d):
    return summaries.keyword_window(a.phrases(parquet(spark, d, "conversations")))


@query
def sku_order_window(spark, d):
    keys, names = a.sku_hops(spark, d)
    return summaries.sku_order_window(a.order_lines(spark, d), a.REVISION_ORDER, keys + names, width=DAY)


@query
def province_order_window(spark, d):
    """Lines are summed per order while they are narrow; the province comes with the order."""
    lines = a.order_lines(spark, d).withColumn("win", windows.tumble("ts", DAY))
    sums = versions.sums_of_newest(
        lines, ["order_detail_id"], a.REVISION_ORDER, ["order_amount"], ["win", "order_id"]
    )
    orders, customer = parquet(spark, d, "orders"), parquet(spark, d, "customer")
    placed = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        F.col("o_orderkey").alias("order_id"), F.col("c_nationkey").alias("province_id")
    )
    province = parquet(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    hops = [Hop("province_id", province, {"province_name": "name"})]
    return summaries.province_totals(sums.join(placed, "order_id"), hops)


@query
def refund_window(spark, d):
    keys, names = a.sku_hops(spark, d)
    back = parquet(spark, d, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_partkey").alias("sku_id"), F.col("l_suppkey").alias("user_id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").cast("timestamp").alias("ts"),
    )
    return summaries.refund_window(back, keys, names, ("category2_name", "category3_name"), DAY)


# --- versions ---------------------------------------------------------------


@query
def revision_netting(spark, d):
    rows = versions.revision_changes(
        a.order_lines(spark, d), ["order_detail_id"], a.REVISION_ORDER, summaries.SKU_AMOUNTS
    )
    return rows.select("order_detail_id", "sku_id", show_time(), *summaries.SKU_AMOUNTS, "sign")


@query
def upsert_latest(spark, d):
    value = F.when(F.col("coupon_amount") != 50, F.to_json(F.struct("sku_id", "order_amount")))
    lines = a.order_lines(spark, d).withColumn("value", value)
    return keyed_topic(lines, ["order_detail_id"], a.REVISION_ORDER).select("order_detail_id", "value")


@query
def replacing_compact(spark, d):
    lines = a.order_lines(spark, d).withColumn("brand", F.col("sku_id") % 100)
    versioned = lines.groupBy(windows.tumble("ts", "30 days"), "brand", F.col("l_suppkey").alias("ts")).agg(
        F.sum("order_amount").alias("order_amount")
    )
    return versions.compact_summary(windows.stamp(versioned), ["brand"], "ts")


# --- change records ---------------------------------------------------------


@query
def cdc_clean(spark, d):
    """Through the text form: packed as records, parsed, cleaned."""
    packed = a.dim_changes(spark, d).select(F.to_json(F.struct("*")).alias("value"))
    rows = changes.clean_changes(read_changes(packed), a.DATABASE)
    return rows.select("table", "type", "ts", F.col("data")["id"].alias("id"), F.col("data")["name"].alias("name"))


@query
def cdc_unwrap(spark, d):
    return changes.unwrap_capture(a.rule_captures(spark, d)).select("source_table", "source_type", "sink_table", "op")


@query
def change_insert_select(spark, d):
    columns = {"id": "id", "user_id": "user_id", "province_id": "province_id", "amount": "total_amount"}
    return changes.select_changes(a.order_changes(spark, d), "order_info", columns, database=a.DATABASE)


@query
def status_transition(spark, d):
    kinds = (changes.CANCELLED, changes.REFUNDING, changes.REFUNDED)
    return changes.status_changes(a.order_changes(spark, d), ["id", "user_id", "order_status"], kinds, a.DATABASE)


@query
def cart_add(spark, d):
    return changes.cart_additions(a.cart_changes(spark, d), a.DATABASE)


# --- facts ------------------------------------------------------------------


def detail_fact(spark, d, wanted=None):
    """The fact of all order lines, or of the lines of the ``wanted`` orders alone."""
    details = changes.select_changes(a.detail_changes(spark, d), "order_detail", facts.DETAIL_COLUMNS)
    if wanted is not None:
        details = details.join(wanted, "order_id", "left_semi")
    orders = changes.select_changes(a.order_changes(spark, d), "order_info", ["id", "user_id", "province_id"], keep=())
    activity = changes.select_changes(
        a.activity_changes(spark, d), "order_detail_activity", ["order_detail_id", "activity_id", "activity_rule_id"],
        keep=(),
    )
    coupon = changes.select_changes(
        a.line_coupon_changes(spark, d), "order_detail_coupon", ["order_detail_id", "coupon_id"], keep=()
    )
    return facts.order_detail(details, orders, activity, coupon, a.dictionary(spark, d))


@query
def order_detail_fact(spark, d):
    return detail_fact(spark, d)


@query
def order_cancel_fact(spark, d):
    cancelled = changes.status_changes(
        a.order_changes(spark, d), ["id", "user_id", "province_id", "operate_time"], changes.CANCELLED
    )
    return facts.order_cancel(cancelled, detail_fact(spark, d, cancelled.select(F.col("id").alias("order_id"))))


@query
def payment_fact(spark, d):
    paid = changes.select_changes(
        a.payment_changes(spark, d), "payment_info", ["user_id", "order_id", "payment_type", "callback_time"]
    )
    return facts.payment(paid, detail_fact(spark, d, paid.select("order_id")), a.dictionary(spark, d))


def as_fact_text(fact):
    """A fact as the layer above reads it."""
    return sinks.as_text(fact)


@query
def sku_order_from_fact(spark, d):
    """Fact text to exact decimal sums, as text."""
    rows = summaries.sku_details(as_fact_text(detail_fact(spark, d)), "value")
    sums = summaries.sku_order_window(rows, ["ts"], width=DAY)
    return sums.select("stt", "edt", "sku_id", *[a.text(c).alias(c) for c in summaries.SKU_AMOUNTS])


@query
def province_order_from_fact(spark, d):
    rows = summaries.province_details(as_fact_text(detail_fact(spark, d)), "value")
    sums = summaries.province_order_window(rows, ["ts"], width=DAY)
    return sums.select("stt", "edt", "province_id", "order_count", a.text("order_amount").alias("order_amount"))


@query
def refund_from_fact(spark, d):
    """Refund requests to distinct orders per item's keys and user."""
    keys, names = a.sku_hops(spark, d)
    keys = [Hop(h.key, h.dim.withColumn("id", a.text("id")), h.columns) for h in keys]
    rows = summaries.refund_details(as_fact_text(refund_requests(spark, d)), "value")
    return summaries.refund_window(rows, keys, names, ("category2_name", "category3_name"), DAY)


def stored_detail(spark, d):
    """The detail fact as its layer stores it: written as text, read with the declared schema."""
    path = scratch_path(spark, "detail-fact")
    sinks.write_text(as_fact_text(detail_fact(spark, d)), path)
    return typed(text_files(spark, path), ORDER_DETAIL_FACT, "json")


@query
def cancel_from_stored_fact(spark, d):
    cancelled = changes.status_changes(
        a.order_changes(spark, d), ["id", "user_id", "province_id", "operate_time"], changes.CANCELLED
    )
    return facts.order_cancel(cancelled, stored_detail(spark, d))


@query
def payment_from_stored_fact(spark, d):
    paid = changes.select_changes(
        a.payment_changes(spark, d), "payment_info", ["user_id", "order_id", "payment_type", "callback_time"]
    )
    return facts.payment(paid, stored_detail(spark, d), a.dictionary(spark, d))


# Columns of the refund request record.
REQUEST_COLUMNS = (
    "id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
    "refund_reason_type", "refund_reason_txt", "create_time",
)


def refund_requests(spark, d):
    requests = changes.select_changes(a.request_changes(spark, d), "order_refund_info", REQUEST_COLUMNS)
    orders = changes.status_changes(a.order_changes(spark, d), ["id", "province_id"], changes.REFUNDING)
    return facts.refund_request(requests, orders, a.dictionary(spark, d))


@query
def refund_request_fact(spark, d):
    return refund_requests(spark, d)


@query
def refund_paid_fact(spark, d):
    columns = ["id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount", "refund_status"]
    paid = changes.refund_records(a.refund_changes(spark, d), "refund_payment", columns)
    requests = changes.refund_records(
        a.request_changes(spark, d), "order_refund_info", ["order_id", "sku_id", "refund_num"]
    )
    orders = changes.status_changes(a.order_changes(spark, d), ["id", "user_id", "province_id"], changes.REFUNDED)
    return facts.refund_paid(paid, requests, orders, a.dictionary(spark, d))


@query
def left_join_upsert(spark, d):
    """Through the text form: comma-separated lines, parsed, joined, kept by key."""
    people = parquet(spark, d, "customer").select(F.to_csv(F.struct("c_custkey", "c_name")).alias("value"))
    ages = parquet(spark, d, "supplier").select(F.to_csv(F.struct("s_suppkey", "s_nationkey")).alias("value"))
    left = typed(people, "id int, name string", "csv")
    joined = facts.left_join_upsert(left, typed(ages, "id int, age int", "csv"))
    return versions.latest_by_key(joined, ["id"], ["age"])


# --- dimensions and routing -------------------------------------------------


@query
def dict_lookup(spark, d):
    orders = parquet(spark, d, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("code")
    )
    return facts.decode(orders, a.dictionary(spark, d), "code", "name")


@query
def dict_lookup_twice(spark, d):
    lines = parquet(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        a.text(F.col("l_partkey") % 5 + 1).alias("kind"), a.text(F.col("l_suppkey") % 5 + 1).alias("reason"),
    )
    names = a.dictionary(spark, d)
    return facts.decode(facts.decode(lines, names, "kind", "kind_name"), names, "reason", "reason_name")


@query
def dim_enrich_chain(spark, d):
    vendor = parquet(spark, d, "supplier").filter("s_acctbal >= 0")
    hops = [
        Hop("l_suppkey", vendor, {"vendor": "s_name", "nation_id": "s_nationkey"}, "s_suppkey"),
        Hop("nation_id", parquet(spark, d, "nation"), {"nation": "n_name", "region_id": "n_regionkey"}, "n_nationkey"),
        Hop("region_id", parquet(spark, d, "region"), {"region": "r_name"}, "r_regionkey"),
    ]
    lines = parquet(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dims.enrich(lines, hops)


@query
def config_current(spark, d):
    captured = changes.unwrap_capture(a.rule_captures(spark, d))
    return dims.current_rules(captured, ["at", "seq"]).select("source_table", "source_type", "sink_table", "op")


def map_text(col: str):
    entries = F.sort_array(F.map_entries(col))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias(col)


@query
def config_route(spark, d):
    cleaned = changes.clean_changes(a.dim_changes(spark, d), a.DATABASE)
    routed = dims.route_dims(cleaned, a.rules(spark).filter("sink_type = 'dim'"))
    return routed.select("sink_table", "sink_pk", F.col("data")["id"].alias("id"),
                         F.col("data")["op_type"].alias("op_type"), "ts")


@query
def config_route_transition(spark, d):
    cleaned = changes.clean_changes(a.coupon_changes(spark, d), a.DATABASE)
    routed = dims.route_facts(cleaned, a.rules(spark))
    return routed.select("sink_table", map_text("data"), "ts")


@query
def config_prune(spark, d):
    cleaned = changes.clean_changes(a.as_records(a.order_changes(spark, d)), a.DATABASE)
    return dims.route_facts(cleaned, a.rules(spark)).select("sink_table", map_text("data"))


@query
def dim_upsert(spark, d):
    cleaned = changes.clean_changes(a.dim_changes(spark, d), a.DATABASE)
    routed = dims.route_dims(cleaned, a.rules(spark))
    return dims.dim_rows(routed, "dim_user_info", ["id", "name", "segment"], ["ts"])


@query
def route_write(spark, d):
    """Written by destination and read back."""
    log = a.as_records(a.order_changes(spark, d)).unionByName(a.coupon_changes(spark, d))
    routed = dims.route_facts(changes.clean_changes(log, a.DATABASE), a.rules(spark))
    path = scratch_path(spark, "routed")
    sinks.write_routed(routed, path)
    stored = sinks.read_routed(spark, path)
    id_of = F.get_json_object("value", "$.id").cast("bigint")
    return stored.groupBy("sink_table").agg(F.count("*").alias("n"), F.sum(id_of).alias("id_sum"))


# --- raw logs ---------------------------------------------------------------


def raw(spark, d):
    return a.raw_log(parquet(spark, d, "events"))


@query
def json_valid(spark, d):
    marked = logs.valid_json(raw(spark, d), "permissive")
    return marked.select("event_id", flag(F.col("valid")).alias("valid"))


@query
def log_split_counts(spark, d):
    return logs.output_counts(logs.parse_logs(raw(spark, d)))


def entries(spark, d, output, names):
    record = F.col("record")
    parsed = logs.parse_logs(raw(spark, d))
    return logs.split_logs(parsed)[output].select(*[record[n].cast("string").alias(n) for n in names])


@query
def explode_display(spark, d):
    return entries(spark, d, "display", ["mid", "vc", "page_id", "item", "order", "ts"])


@query
def explode_action(spark, d):
    return entries(spark, d, "action", ["mid", "page_id", "action_id", "ts"])


@query
def log_reject(spark, d):
    return logs.rejected_logs(raw(spark, d), keep=("event_id",)).select("event_id", "reason")


@query
def log_outputs(spark, d):
    """What the text of every output holds, with the types of its values."""
    found = logs.tag_records(raw(spark, d)).filter("output <> 'reject'")
    found = found.select("output", F.inline(F.array(F.struct(F.try_parse_json("value").alias("r")))))

    def get(path, kind="string"):
        return F.expr(f"try_variant_get(r, '$.{path}', '{kind}')")

    def either(name):
        return F.coalesce(get(f"common.{name}"), get(f"page.{name}"), get(name)).alias(name)

    time = F.expr("schema_of_variant(try_variant_get(r, '$.ts', 'variant'))")
    spent = F.expr("schema_of_variant(coalesce(try_variant_get(r, '$.page.during_time', 'variant'), try_variant_get(r, '$.during_time', 'variant')))")
    return found.select(
        "output", get("seq", "bigint").alias("seq"), *[either(n) for n in ("mid", "vc", "page_id", "last_page_id", "during_time")],
        *[get(n).alias(n) for n in ("item", "action_id")], get("error.error_code").alias("error_code"), get("start.entry").alias("entry"),
        get("ts", "bigint").alias("ts"), time.alias("ts_kind"), spent.alias("spent_kind"),
    )


@query
def page_view_from_log(spark, d):
    """Raw text, split, page text, summary."""
    pages = logs.tag_records(raw(spark, d), wanted=["page"])
    views = logs.parse_page_views(pages, extra={"seq": ("$.seq", "bigint")})
    return summaries.page_view_window(views, HOUR, ("ts", "seq"))


@query
def visitor_repair(spark, d):
    rows = logs.repair_visitors(a.page_log(spark, d), order=("ts", "event_id"))
    return rows.select("event_id", "mid", "is_new")


# --- words ------------------------------------------------------------------


@query
def keyword_tokens(spark, d):
    rows = words.explode_words(parquet(spark, d, "documents").select("doc_id", "text"), "text")
    return rows.groupBy("keyword").agg(F.count("*").alias("docs"))


@query
def word_count(spark, d):
    return words.word_count(parquet(spark, d, "conversations"), "text", ",")


# --- arrival order ----------------------------------------------------------


def arrivals(spark, d):
    return a.arrivals(parquet(spark, d, "events"))


@query
def parse_csv_line(spark, d):
    """Events as sensor lines; every seventh has a broken reading."""
    reading = F.when(F.col("event_id") % 7 == 6, "?").otherwise(a.text("k"))
    line = F.concat_ws(",", F.concat(F.lit("sensor_"), a.text(F.col("user_id") % 10)), F.col("ts_ms"), reading)
    good, bad = sensor_lines(arrivals(spark, d).select(line.alias("value")))
    return good.select("id", "ts", "vc").unionByName(
        bad.select(F.col("value").alias("id"), F.lit(None).cast("bigint").alias("ts"), F.lit(None).cast("int").alias("vc"))
    )


@query
def window_collect(spark, d):
    lists = windows.window_rows(arrivals(spark, d), ["event_id", "user_id"], ["ts", "event_id"], width=HOUR, chunk=10)
    shown = F.transform("rows", lambda r: F.concat_ws(":", r["event_id"], r["user_id"]))
    return lists.select("stt", "edt", "chunk", F.array_join(shown, ",").alias("items"))


@query
def watermark_trace(spark, d):
    traced = windows.watermark_trace(arrivals(spark, d), ["source"], ["place", "event_id"], "ts_ms", 3000)
    return traced.select("event_id", "source", "watermark")


def marked(spark, d):
    return windows.mark_late(arrivals(spark, d), ["source"], ["place", "event_id"], "ts_ms", HOUR_MS)


@query
def late_split(spark, d):
    return marked(spark, d).select("event_id", "window_end", flag(F.col("late")).alias("late"))


@query
def late_refire(spark, d):
    return windows.refire_counts(marked(spark, d), HOUR_MS)


# --- key-value views --------------------------------------------------------


def events_valued(spark, d):
    events = a.event_number(parquet(spark, d, "events")).withColumn("cents", a.cents("value"))
    return keyvalue.as_json(events, ["event_type", "k"])


@query
def kv_latest(spark, d):
    return keyvalue.last_value(events_valued(spark, d), "user_id", ["ts", "event_id"])


@query
def kv_list(spark, d):
    lists = keyvalue.pushed_list(events_valued(spark, d), "user_id", ["ts", "event_id"], chunk=100)
    return lists.select("user_id", "chunk", F.array_join("items", ",").alias("items"))


@query
def kv_set(spark, d):
    return keyvalue.members(events_valued(spark, d), "value")


@query
def kv_ranked(spark, d):
    member = F.concat_ws(":", "user_id", "event_type")
    rows = events_valued(spark, d).withColumn("member", member)
    return keyvalue.ranked_members(rows, "member", "cents", ["ts", "event_id"])


@query
def time_columns(spark, d):
    """Milliseconds to day and time text and back, and the version of a run."""
    events = parquet(spark, d, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    day = millis_to_date("ms")
    return events.select(
        "event_id", day.alias("day"), millis_to_datetime("ms").alias("at"), date_to_millis(day).alias("day_ms"),
        flag(now_millis() > F.col("ms")).alias("before_now"),
    )


@query
def summary_version(spark, d):
    """Window sums with the version of the run that made them."""
    rows = parquet(spark, d, "orders").select(F.col("o_orderdate").cast("timestamp").alias("ts"), a.cents("o_totalprice").alias("total"))
    return windows.sum_by_window(rows, (), ["total"], DAY, run_ts=1704067200000)


@query
def dim_missing_drop(spark, d):
    """Rows without their dimension are dropped."""
    vendor = parquet(spark, d, "supplier").filter("s_acctbal >= 0")
    lines = parquet(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dims.enrich(lines, [Hop("l_suppkey", vendor, {"vendor": "s_name"}, "s_suppkey")], "drop")


@query
def rename_case(spark, d):
    events = parquet(spark, d, "events").select("event_id", "user_id", "event_type")
    camel = rename_columns(events, "camel")
    return rename_columns(camel.withColumn("userIdText", a.text("userId")), "snake")
