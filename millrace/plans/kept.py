"""Registered queries over tables that streams keep, and over versions in force at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import flag
from millrace.operators import changes, dims, facts, summaries, windows
from millrace.operators.dims import Hop
from millrace.plans import adapters as a
from millrace.plans.catalogue import DAY, HOUR, HOUR_MS, arrivals, query
from millrace.plans.oracle import DICT, ORACLE
from millrace.plans.streams import finished_by, per_core, replay
from millrace.session import scratch_path
from millrace.sources.tables import parquet
from millrace.streaming import sinks
from millrace.streaming.arrivals import split_late_to, watermark_trace_to
from millrace.streaming.holding import closed_windows_to
from millrace.streaming.in_force import in_force_to
from millrace.streaming.levels import Levels, levels_to
from millrace.streaming.loads import dims_to_levels, dim_levels, read_dim_levels
from millrace.streaming.netting import NettedWindows, netted_windows_to
from millrace.streaming.updating import net_rows, newest_rows, read_changes_of, updating_to

BATCHES, FAN = 9, 3


# --- keyed tables in levels -----------------------------------------------------------


def stored_lines(spark: SparkSession, d: str) -> Levels:
    """Order lines upserted in ``BATCHES`` batches, with merges on the way; a removed line is marked."""
    lines = a.order_lines(spark, d).withColumn("gone", F.col("coupon_amount") == 50)
    lines = lines.select("order_detail_id", *a.REVISION_ORDER, "sku_id", "order_amount", "gone")
    table = Levels(scratch_path(spark, "lines"), lines.schema, ("order_detail_id",), a.REVISION_ORDER, deleted="gone", fan=FAN)
    write, turn = levels_to(table), F.pmod(F.xxhash64(*lines.columns), F.lit(BATCHES))
    for number in range(BATCHES):
        write(lines.filter(turn == number), number)
    return table


@query
def level_upsert(spark, d):
    """Newest version of every line, out of merged runs."""
    rows = stored_lines(spark, d).read(spark)
    return rows.select("order_detail_id", F.to_json(F.struct("sku_id", "order_amount")).alias("value"))


@query
def level_key_read(spark, d):
    """The lines of urgent orders, read by their keys."""
    urgent = parquet(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("order_id"))
    keys = a.order_lines(spark, d).join(urgent, "order_id", "left_semi").select("order_detail_id").distinct()
    return stored_lines(spark, d).read_keys(spark, keys).select("order_detail_id", "sku_id", "order_amount")


@query
def dim_load_levels(spark, d):
    """All dimension tables of the rules upserted in one table, a batch at a time; one of them read back."""
    cleaned = changes.clean_changes(a.dim_changes(spark, d), a.DATABASE)
    routed = dims.route_dims(cleaned, a.rules(spark))
    table = dim_levels(scratch_path(spark, "dims"), ("ts",), fan=2)
    write = dims_to_levels(table)
    for number, day in enumerate(sorted(r["ts"] for r in routed.select("ts").distinct().collect())):
        write(routed.filter(F.col("ts") == day), number)
    return read_dim_levels(spark, table, "dim_user_info", ["id", "name", "segment"])


ORACLE["level_upsert"] = ORACLE["upsert_latest"]
ORACLE["level_key_read"] = f"""
select order_detail_id, cast(json_extract(value, '$.sku_id') as bigint) as sku_id, cast(json_extract(value, '$.order_amount') as bigint) as order_amount
from ({ORACLE['upsert_latest']}) where exists (
  select 1 from orders where o_orderpriority = '1-URGENT' and o_orderkey = cast(split_part(order_detail_id, '-', 1) as bigint))"""
ORACLE["dim_load_levels"] = ORACLE["dim_upsert"]


# --- versions in force ----------------------------------------------------------------


@query
def rule_as_of(spark, d):
    """Records of many tables sent where the rule of their own time says."""
    captured = changes.unwrap_capture(a.rule_captures(spark, d))
    routed = dims.route_as_of(a.ruled_changes(spark, d), captured, "et", "at", ["seq"], F.col("type"))
    return routed.select("sink_table", "sink_type", F.col("data")["id"].alias("id"), F.col("data")["name"].alias("name"), "ts")


@query
def dict_as_of(spark, d):
    """Orders with the name that their priority code had on their day."""
    orders = parquet(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"), F.substring("o_orderpriority", 1, 1).alias("code")
    )
    return facts.decode_as_of(orders, a.dictionary_versions(spark, d), "code", "name", "ts").drop("ts")


@query
def stream_rule_as_of(spark, d):
    """Rule changes and records in one stream, out of order by days; records wait for the rules of their time."""
    captured = changes.unwrap_capture(a.rule_captures(spark, d))
    versions = dims.rule_versions(captured, "at", ["seq"]).withColumn("at", F.col("at").cast("timestamp"))
    records = a.ruled_changes(spark, d).withColumn("kind", F.col("type"))
    both = versions.withColumn("et", F.col("at")).unionByName(records, allowMissingColumns=True)

    def parts(batch):
        rule = F.col("at").isNotNull()
        return batch.filter(rule).select(*versions.columns), batch.filter(~rule).select(*records.columns)

    path = scratch_path(spark, "ruled")

    def write(joined, number):
        sinks.append_to(f"{path}/rows")(dims.ruled(joined), number)

    job = in_force_to(f"{path}/kept", parts, ["table", "kind"], "at", dims.RULE_COLUMNS, write, "et", ["seq"], delay="3 days")
    stored = finished_by(spark, replay(spark, both, 259_200, {}, "et"), job, path)
    shown = stored.filter("data is not null")
    return shown.select("sink_table", "sink_type", F.col("data")["id"].alias("id"), F.col("data")["name"].alias("name"), "ts")


@query
def stream_dict_as_of(spark, d):
    """The code book changes while the stream runs; orders before and after show both names."""
    orders = parquet(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"), F.substring("o_orderpriority", 1, 1).alias("code")
    )
    versions = a.dictionary_versions(spark, d).select(F.col("dic_code").alias("code"), F.col("dic_name").alias("name"), F.col("since"))
    both = versions.withColumn("ts", F.col("since")).unionByName(orders, allowMissingColumns=True)

    def parts(batch):
        return batch.filter("since is not null").select(*versions.columns), batch.filter("since is null").select(*orders.columns)

    path = scratch_path(spark, "named")
    job = in_force_to(f"{path}/kept", parts, ["code"], "since", ["name"], sinks.append_to(f"{path}/rows"))
    return finished_by(spark, replay(spark, both, 3, {}), job, path).select("o_orderkey", "code", "name")


ORACLE["rule_as_of"] = """
with rule as (select 'table_' || o_custkey as t, lower(substr(o_orderpriority, 3)) as kind, o_orderdate as at, o_orderkey as seq,
                     'sink_' || o_orderkey as sink_table, o_orderstatus = 'F' as gone from orders
              qualify row_number() over (partition by o_custkey, o_orderpriority, o_orderdate order by o_orderkey desc) = 1),
rec as (select 'table_' || l_partkey as t, ['urgent', 'high', 'medium', 'not specified', 'low'][l_linenumber % 5 + 1] as kind, l_shipdate as ts,
               l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as id, cast(l_orderkey as varchar) as name from lineitem)
select sink_table, 'dim' as sink_type, id, name, cast(epoch_us(ts) // 1000000 as varchar) as ts
from rec asof join rule on rec.t = rule.t and rec.kind = rule.kind and rec.ts >= rule.at where not gone"""
ORACLE["dict_as_of"] = f"""
with {DICT}
select o_orderkey, dic_code as code, case when dic_code <= '3' and o_orderdate >= timestamp '{a.RENAMED}' then lower(dic_name) else dic_name end as name
from orders join dic on dic_code = substr(o_orderpriority, 1, 1)"""
ORACLE["stream_rule_as_of"] = ORACLE["rule_as_of"]
ORACLE["stream_dict_as_of"] = ORACLE["dict_as_of"]


# --- corrected results ----------------------------------------------------------------


def netted(spark, rows: DataFrame, label: str, last: dict, **options) -> DataFrame:
    path = scratch_path(spark, label)
    kept = NettedWindows(f"{path}/kept", rows.schema, ["order_detail_id"], a.REVISION_ORDER, width=DAY, fan=FAN, **options)
    finished_by(spark, replay(spark, rows, 86_400, last), netted_windows_to(kept), path, read=False)
    return kept.read(spark)


@query
def stream_sku_order_window(spark, d):
    """A new version corrects the window of the one it replaces, however long ago that was reported."""
    keys, names = a.sku_hops(spark, d)
    sums = netted(spark, a.order_lines(spark, d), "sku", None, groups=["sku_id"], amounts=summaries.SKU_AMOUNTS)
    return dims.enrich(sums, keys + names)


@query
def stream_province_order_window(spark, d):
    """As above, with the distinct orders of every window counted as they come."""
    orders, customer = parquet(spark, d, "orders"), parquet(spark, d, "customer")
    placed = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        F.col("o_orderkey").alias("order_id"), F.col("c_nationkey").alias("province_id")
    )
    rows = a.order_lines(spark, d).select("order_detail_id", "order_id", *a.REVISION_ORDER, "order_amount").join(placed, "order_id")
    province = parquet(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    sums = netted(spark, rows, "province", None, groups=["province_id"], amounts=["order_amount"], member="order_id", count="order_count")
    return dims.enrich(sums, [Hop("province_id", province, {"province_name": "name"})])


def one_log(log: DataFrame, days: int) -> DataFrame:
    """Change records with an arrival time up to ``days`` after their own, different for every record."""
    late = F.pmod(F.xxhash64("table", *[F.coalesce(c, F.lit("")) for c in log.columns if c not in ("database", "ts")]), F.lit(days * 86_400))
    return log.withColumn("et", F.timestamp_seconds(F.col("ts").cast("bigint") + late))


def corrected(spark, log: DataFrame, parts, ids, result, label: str) -> DataFrame:
    """All changes of a join that is kept up to date over a replayed log."""
    path = scratch_path(spark, label)
    empty = spark.createDataFrame([], log.schema)
    schema = result(parts(empty)).schema
    job = updating_to(f"{path}/kept", parts, ["order_id"], ids, result, ["id"], sinks.append_to(f"{path}/rows"), FAN)
    finished_by(spark, replay(spark, one_log(log, 700), order="et").drop("et"), job, path, read=False)
    return read_changes_of(spark, f"{path}/rows", schema)


@query
def stream_order_detail_fact(spark, d):
    """Lines, orders, activities and coupons come in any order, years apart; rows are corrected as partners arrive."""
    logs = [a.detail_changes(spark, d), a.activity_changes(spark, d), a.line_coupon_changes(spark, d), a.order_changes(spark, d)]
    log = logs[0]
    for other in logs[1:]:
        log = log.unionByName(other, allowMissingColumns=True)
    names = a.dictionary(spark, d)

    def parts(batch):
        def pick(table, columns, **keep):
            return changes.select_changes(batch, table, columns, **keep)

        return {
            "details": pick("order_detail", facts.DETAIL_COLUMNS),
            "orders": pick("order_info", {"order_id": "id", "user_id": "user_id", "province_id": "province_id"}, keep=()),
            "activities": pick("order_detail_activity", ["order_id", "order_detail_id", "activity_id", "activity_rule_id"], keep=()),
            "coupons": pick("order_detail_coupon", ["order_id", "order_detail_id", "coupon_id"], keep=()),
        }

    def result(tables):
        orders = tables["orders"].withColumnRenamed("order_id", "id")
        return facts.order_detail(tables["details"], orders, tables["activities"], tables["coupons"], names)

    ids = {"details": ["id"], "orders": [], "activities": ["order_detail_id"], "coupons": ["order_detail_id"]}
    return newest_rows(corrected(spark, log, parts, ids, result, "details"), ["id"])


@query
def stream_refund_paid_fact(spark, d):
    """Three inputs matched by order and item, without a time bound, whatever order they come in."""
    log = a.refund_changes(spark, d)
    for other in (a.request_changes(spark, d), a.order_changes(spark, d)):
        log = log.unionByName(other, allowMissingColumns=True)
    names = a.dictionary(spark, d)
    columns = ["id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount", "refund_status"]

    def parts(batch):
        orders = changes.status_changes(batch, ["id", "user_id", "province_id"], changes.REFUNDED)
        return {
            "refunds": changes.refund_records(batch, "refund_payment", columns),
            "requests": changes.refund_records(batch, "order_refund_info", ["id", "order_id", "sku_id", "refund_num"]),
            "orders": orders.withColumnRenamed("id", "order_id"),
        }

    def result(tables):
        orders = tables["orders"].withColumnRenamed("order_id", "id")
        return facts.refund_paid(tables["refunds"], tables["requests"], orders, names)

    ids = {"refunds": ["id"], "requests": ["id"], "orders": []}
    return net_rows(corrected(spark, log, parts, ids, result, "refunds"))


ORACLE["stream_sku_order_window"] = ORACLE["sku_order_window"]
ORACLE["stream_province_order_window"] = ORACLE["province_order_window"]
ORACLE["stream_order_detail_fact"] = ORACLE["order_detail_fact"]
ORACLE["stream_refund_paid_fact"] = ORACLE["refund_paid_fact"]


# --- arrival order and closed windows ---------------------------------------------------


def arriving(spark, d) -> DataFrame:
    """Events in the order they arrive, a time for each place."""
    rows = arrivals(spark, d)
    return rows.withColumn("turn", F.timestamp_seconds(F.col("place")))


@query
def stream_watermark_trace(spark, d):
    """The watermark every record meets, carried over from batch to batch."""
    rows, path = arriving(spark, d), scratch_path(spark, "trace")
    job = watermark_trace_to(f"{path}/kept", sinks.append_to(f"{path}/rows"), ["source"], ["place", "event_id"], "ts_ms", 3000)
    return finished_by(spark, replay(spark, rows, order="turn"), job, path).select("event_id", "source", "watermark")


@query
def stream_late_split(spark, d):
    """Rows in time and the side output of rows too late, written in one pass."""
    rows, path = arriving(spark, d), scratch_path(spark, "late")
    job = split_late_to(f"{path}/kept", f"{path}/rows", ["source"], ["place", "event_id"], "ts_ms", width_ms=HOUR_MS)
    stored = finished_by(spark, replay(spark, rows, order="turn"), job, path)
    return stored.select("event_id", "window_end", flag(F.col("late").cast("boolean")).alias("late"))


@query
def stream_window_collect(spark, d):
    """All rows of a window as numbered lists, once the watermark has passed it."""
    rows, path = arrivals(spark, d).select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts")), scratch_path(spark, "lists")

    def lists(closed):
        return windows.window_rows(closed, ["event_id", "user_id"], ["ts", "event_id"], width=HOUR, chunk=10)

    job = closed_windows_to(f"{path}/kept", lists, sinks.append_to(f"{path}/rows"), width=HOUR)
    stored = finished_by(spark, replay(spark, rows, 3, {}), job, path)
    shown = F.transform("rows", lambda r: F.concat_ws(":", r["event_id"], r["user_id"]))
    return stored.select("stt", "edt", "chunk", F.array_join(shown, ",").alias("items"))


ORACLE["stream_watermark_trace"] = ORACLE["watermark_trace"]
ORACLE["stream_late_split"] = ORACLE["late_split"]
ORACLE["stream_window_collect"] = ORACLE["window_collect"]
