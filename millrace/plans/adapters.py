"""The given tables in the shape of the warehouse inputs.

Every function is a projection of a whole table (or a union of such), so the
work of a query grows with the tables. ``plans/oracle.py`` states the same
projections in SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import DATETIME
from millrace.operators.dims import COUPON_PAID, COUPON_USED, Hop
from millrace.sources.tables import parquet

DATABASE = "shop"


def text(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def cents(col: str) -> Column:
    return F.round(F.col(col) * 100).cast("bigint")


def money(col: str) -> Column:
    """Amount as text with two decimals."""
    return F.col(col).cast("decimal(16,2)").cast("string")


def event_number(df: DataFrame) -> DataFrame:
    """``k`` of the event properties."""
    k = F.get_json_object("props", "$.k").cast("int")
    return df.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("k", k)


def page_views(events: DataFrame) -> DataFrame:
    """Events as page views of a device."""
    kind = F.col("event_type")
    came_from = F.when(kind == "signup", None).when(kind == "error", "login").otherwise("home")
    page = F.when(kind == "view", "home").when(kind == "click", "good_detail").otherwise(kind)
    return event_number(events).select(
        "event_id", "ts", text("user_id").alias("mid"), text("user_id").alias("uid"),
        page.alias("page_id"), came_from.alias("last_page_id"),
        *[text(F.col("k") % n).alias(c) for c, n in (("vc", 3), ("ch", 4), ("ar", 5), ("is_new", 2))],
        cents("value").alias("during_time"), "k",
    )


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_views(parquet(spark, sf_dir, "events"))


def raw_log(events: DataFrame) -> DataFrame:
    """Page views packed as JSON text.

    Every tenth record is cut short, some give their time as text, and all have
    a key that no section knows.
    """
    views = page_views(events)
    ms = F.unix_millis("ts")
    number = F.sequence(F.lit(1), F.greatest(F.col("k") % 4, F.lit(1)))
    steps = F.sequence(F.lit(1), F.greatest(F.col("k") % 3, F.lit(1)))
    displays = F.transform(
        number,
        lambda i: F.struct(
            text(F.col("k") + i).alias("item"), F.lit("shown").alias("page_id"),
            text(i).alias("order"), F.lit("9").alias("vc"),
        ),
    )
    actions = F.transform(
        steps,
        lambda i: F.struct(
            F.concat(F.lit("act_"), text(i)).alias("action_id"), text(ms + i).alias("ts"),
            F.lit("none").alias("page_id"),
        ),
    )
    starting = F.col("page_id") == "signup"
    record = F.struct(
        F.struct("mid", "uid", "vc", "ch", "ar", "is_new").alias("common"),
        F.when(~starting & ~((F.col("page_id") == "purchase") & (F.col("k") % 10 == 0)),
               F.struct("page_id", "last_page_id", "during_time")).alias("page"),
        F.when(~starting & (F.col("k") % 4 > 0), displays).alias("displays"),
        F.when(~starting & (F.col("k") % 3 > 0), actions).alias("actions"),
        F.when(starting, F.struct(F.lit("icon").alias("entry"), text("k").alias("loading_time"))).alias("start"),
        F.when(F.col("page_id") == "error", F.struct(text(F.col("k") + 1000).alias("error_code"))).alias("error"),
        F.col("event_id").alias("seq"), ms.alias("ts"),
    )
    number = F.to_json(record)
    whole = F.when(F.col("k") % 5 == 1, F.regexp_replace(number, '"ts":([0-9]+)}$', '"ts":"$1"}')).otherwise(number)
    cut = F.when(F.col("event_id") % 10 == 9, F.expr("left(_json, length(_json) - 5)")).otherwise(F.col("_json"))
    return views.select("event_id", whole.alias("_json")).select("event_id", cut.alias("value"))


def buyers(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").cast("timestamp").alias("ts"))


def logins(orders: DataFrame) -> DataFrame:
    """Orders as page views of a known user; the priority says where the user came from."""
    priority = F.substring("o_orderpriority", 1, 1)
    came_from = F.when(priority == "1", None).when(priority == "2", "login").otherwise("home")
    return orders.select(
        text("o_custkey").alias("uid"), came_from.alias("last_page_id"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
    )


def arrivals(events: DataFrame) -> DataFrame:
    """Events out of order: four sources, each in its own arrival order."""
    place = F.col("event_id") + (F.col("event_id") * 7919) % 37
    return event_number(events).select(
        "event_id", (F.col("user_id") % 4).alias("source"), place.alias("place"), "ts",
        F.unix_millis("ts").alias("ts_ms"), "user_id", "k",
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_amounts(parquet(spark, sf_dir, "lineitem"))


def line_amounts(line: DataFrame) -> DataFrame:
    """Order lines with revisions: a line number can come several times."""
    base = cents("l_extendedprice")
    rate = F.round(F.col("l_discount") * 100).cast("bigint")
    off = F.floor(base * rate / 100).cast("bigint")
    return line.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_detail_id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        F.col("l_shipdate").cast("timestamp").alias("ts"), "l_partkey", "l_suppkey",
        base.alias("original_amount"), off.alias("activity_amount"),
        F.round("l_quantity").cast("bigint").alias("coupon_amount"), (base - off).alias("order_amount"),
    )


REVISION_ORDER = ("ts", "l_partkey", "l_suppkey")


def sku_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
        F.col("p_brand").alias("tm_id"), F.col("p_type").alias("category3_id"),
    )


def trademark_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = parquet(spark, sf_dir, "part").select(F.col("p_brand").alias("id")).distinct()
    return brands.select("id", F.upper("id").alias("tm_name"))


def category_dims(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    """Three levels over the part types: type, its first letter, and one root per half alphabet."""
    kind = parquet(spark, sf_dir, "part").select("p_type", F.substring("p_type", 1, 1).alias("letter"))
    half = F.when(F.col("letter") < "N", "A-M").otherwise("N-Z")
    third = kind.select(F.col("p_type").alias("id"), F.col("letter").alias("category2_id")).distinct()
    second = kind.select(F.col("letter").alias("id"), half.alias("category1_id")).distinct()
    first = kind.select(half.alias("id")).distinct()
    return {
        3: third.withColumn("name", F.lower("id")),
        2: second.withColumn("name", F.concat(F.lit("group "), "id")),
        1: first.withColumn("name", F.concat(F.lit("root "), "id")),
    }


def sku_hops(spark: SparkSession, sf_dir: str) -> tuple[list[Hop], list[Hop]]:
    """Lookups that give an item its group keys, and those that only add names."""
    third, second, first = (category_dims(spark, sf_dir)[n] for n in (3, 2, 1))
    sku, brand = sku_dim(spark, sf_dir), trademark_dim(spark, sf_dir)
    keys = [
        Hop("sku_id", sku, {"sku_name": "sku_name", "trademark_id": "tm_id", "category3_id": "category3_id"}),
        Hop("category3_id", third, {"category3_name": "name", "category2_id": "category2_id"}),
        Hop("category2_id", second, {"category2_name": "name", "category1_id": "category1_id"}),
    ]
    names = [
        Hop("category1_id", first, {"category1_name": "name"}),
        Hop("trademark_id", brand, {"trademark_name": "tm_name"}),
    ]
    return keys, names


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code book from the order priorities; code 5 is left out, so its rows are dropped."""
    names = parquet(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("dic_name")).distinct()
    return names.select(F.substring("dic_name", 1, 1).alias("dic_code"), "dic_name").filter("dic_code <> '5'")


HEAD = ("database", "table", "type", "ts")


def _changes(df: DataFrame, table: str, kind: str, ts: str | Column, data: dict, old: dict | None = None) -> DataFrame:
    """A flat change log: the row's columns as they are, former values as ``old_`` columns."""
    moment = F.col(ts) if isinstance(ts, str) else ts
    return df.select(
        F.lit(DATABASE).alias("database"), F.lit(table).alias("table"), F.lit(kind).alias("type"),
        text(F.unix_seconds(moment.cast("timestamp"))).alias("ts"),
        *[v.alias(k) for k, v in data.items()],
        *[v.cast("string").alias(f"old_{k}") for k, v in (old or {}).items()],
    )


def as_records(log: DataFrame) -> DataFrame:
    """A flat log in the record form, with ``data`` and ``old`` maps.

    The maps come out of a generator, so that a filter on them does not build
    them a second time below.
    """

    def packed(names, prefix=""):
        if not names:
            return F.lit(None).cast("map<string,string>")
        return F.create_map(*[x for n in names for x in (F.lit(n.removeprefix(prefix)), F.col(n))])

    old = [c for c in log.columns if c.startswith("old_")]
    data = [c for c in log.columns if c not in HEAD and c not in old]
    former = F.map_filter(packed(old, "old_"), lambda _, v: v.isNotNull())
    return log.select(*HEAD, F.inline(F.array(F.struct(packed(data).alias("data"), former.alias("old")))))


def _moment(ts: str) -> Column:
    return F.date_format(ts, DATETIME)


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a change log: placed, then cancelled (F) or refunded in two steps (P)."""
    orders = parquet(spark, sf_dir, "orders")

    def step(kind, status, before=None, when=None):
        row = {
            "id": text("o_orderkey"), "user_id": text("o_custkey"), "province_id": text(F.col("o_custkey") % 25),
            "order_status": F.lit(status), "operate_time": _moment("o_orderdate"),
            "total_amount": money("o_totalprice"),
        }
        some = orders if when is None else orders.filter(when)
        return _changes(some, "order_info", kind, "o_orderdate", row, {"order_status": F.lit(before)})

    refunded = "o_orderstatus = 'P'"
    return (
        step("insert", "1001")
        .unionByName(step("update", "1003", "1001", "o_orderstatus = 'F'"))
        .unionByName(step("update", "1005", "1002", refunded))
        .unionByName(step("update", "1006", "1005", f"{refunded} and o_orderkey % 2 = 0"))
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return parquet(spark, sf_dir, "lineitem").select(
        "*", line_id.alias("line_id"), text("l_orderkey").alias("order_id"), text("l_partkey").alias("sku_id"),
        text(F.col("l_quantity").cast("bigint")).alias("quantity"), money("l_extendedprice").alias("amount"),
        *[text(F.col(c) % 5 + 1).alias(n) for n, c in
          (("code_a", "l_linenumber"), ("code_b", "l_partkey"), ("code_c", "l_suppkey"))],
    )


def _cols(**names: str | Column) -> dict[str, Column]:
    return {k: F.col(v) if isinstance(v, str) else v for k, v in names.items()}


def detail_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _cols(
        id="line_id", order_id="order_id", sku_id="sku_id", sku_name=F.concat(F.lit("sku "), "sku_id"),
        create_time=_moment("l_shipdate"), source_id=text("l_suppkey"), source_type="code_a", sku_num="quantity",
        order_price="amount", split_total_amount="amount", split_activity_amount=money("l_discount"),
        split_coupon_amount=money("l_tax"),
    )
    return _changes(_lines(spark, sf_dir), "order_detail", "insert", "l_shipdate", data)


def activity_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _cols(
        order_detail_id="line_id", order_id="order_id", activity_id=text(F.col("l_suppkey") % 7),
        activity_rule_id=text(F.col("l_suppkey") % 11),
    )
    lines = _lines(spark, sf_dir).filter("l_discount > 0.05")
    return _changes(lines, "order_detail_activity", "insert", "l_shipdate", data)


def line_coupon_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _cols(order_detail_id="line_id", order_id="order_id", coupon_id=text(F.col("l_partkey") % 13))
    lines = _lines(spark, sf_dir).filter("l_tax > 0.04")
    return _changes(lines, "order_detail_coupon", "insert", "l_shipdate", data)


def request_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _cols(
        id="line_id", user_id=text("l_suppkey"), order_id="order_id", sku_id="sku_id", refund_type="code_a",
        refund_reason_type="code_b", refund_reason_txt=F.concat(F.lit("reason "), "code_b"),
        refund_num="quantity", refund_amount="amount", create_time=_moment("l_shipdate"),
    )
    back = _lines(spark, sf_dir).filter("l_returnflag = 'R'")
    return _changes(back, "order_refund_info", "insert", "l_shipdate", data)


def refund_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _cols(
        id="line_id", order_id="order_id", sku_id="sku_id", payment_type="code_c",
        callback_time=_moment("l_shipdate"), total_amount="amount", refund_status=F.lit("0705"),
    )
    back = _lines(spark, sf_dir).filter("l_returnflag = 'R' and l_linestatus = 'F'")
    return _changes(back, "refund_payment", "insert", "l_shipdate", data)


def payment_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments of the orders that were not cancelled."""
    orders = parquet(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    data = _cols(
        user_id=text("o_custkey"), order_id=text("o_orderkey"),
        payment_type=F.substring("o_orderpriority", 1, 1), callback_time=_moment("o_orderdate"),
    )
    return _changes(orders, "payment_info", "insert", "o_orderdate", data)


def cart_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as cart records: purchases put items in, clicks change the number, views the price."""
    events = event_number(parquet(spark, sf_dir, "events"))
    data = _cols(
        id=text("event_id"), user_id=text("user_id"), sku_id=text(F.col("k") * 10), cart_price=money("value"),
        sku_num=text("k"), source_id=text(F.col("k") % 7), source_type=text(F.col("k") % 5 + 1),
    )

    def some(event, kind, number):
        return _changes(events.filter(F.col("event_type") == event), "cart_info", kind, "ts", data, {"sku_num": number})

    return (
        some("purchase", "insert", F.lit(None))
        .unionByName(some("click", "update", F.col("event_id") % 100))
        .unionByName(some("view", "update", F.lit(None)))
    )


def coupon_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as coupon records moving through their states."""
    orders = parquet(spark, sf_dir, "orders")
    state = F.col("o_orderstatus")
    new = F.when(state == "F", "1402").when(state == "P", "1403").otherwise("1401")
    old = F.when(state == "F", "1401").when(state == "P", "1402").otherwise("1400")
    data = _cols(
        id=text("o_orderkey"), user_id=text("o_custkey"), coupon_status=new,
        used_time=_moment("o_orderdate"), note="o_orderpriority",
    )
    got = orders.filter("o_orderstatus = 'O'")
    return as_records(
        _changes(orders, "coupon_use", "update", "o_orderdate", data, {"coupon_status": old}).unionByName(
            _changes(got, "coupon_use", "insert", "o_orderdate", data, {"coupon_status": F.lit(None)})
        )
    )


def dim_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, suppliers and parts as change records of dimension tables."""
    customer, supplier, part = (parquet(spark, sf_dir, n) for n in ("customer", "supplier", "part"))
    day, later = F.lit("2024-01-01 00:00:00"), F.lit("2024-01-02 00:00:00")
    person = _cols(id=text("c_custkey"), name="c_name", segment="c_mktsegment", balance=money("c_acctbal"))
    moved = {**person, "segment": F.lower("c_mktsegment")}
    vendor = _cols(id=text("s_suppkey"), name="s_name", balance=money("s_acctbal"))
    item = _cols(id=text("p_partkey"), name="p_name", brand="p_brand", size=text("p_size"))
    logs = [
        _changes(customer, "user_info", "bootstrap-insert", day, person),
        _changes(customer.filter("c_custkey % 3 = 0"), "user_info", "update", later, moved,
                 {"segment": F.col("c_mktsegment")}),
        _changes(supplier, "vendor_info", "insert", day, vendor),
        _changes(part, "sku_info", "insert", day, item),
        _changes(part.filter("p_size > 40"), "sku_info", "delete", day, item),
    ]
    return reduce(DataFrame.unionByName, [as_records(log) for log in logs])


def rules(spark: SparkSession) -> DataFrame:
    """Routing rules: two dimension tables and four fact topics."""
    rows = [
        ("user_info", "ALL", "dim_user_info", "dim", "id,name,segment", "id", None),
        ("sku_info", "ALL", "dim_sku_info", "dim", "id,name,brand", "id", None),
        ("order_info", "insert", "dwd_order_placed", "dwd", "id,user_id,total_amount", None, None),
        ("coupon_use", "insert", "dwd_coupon_get", "dwd", "id,user_id", None, None),
        ("coupon_use", "update", "dwd_coupon_order", "dwd", "id,user_id,used_time", None, COUPON_USED),
        ("coupon_use", "update", "dwd_coupon_pay", "dwd", "id,coupon_status", None, COUPON_PAID),
    ]
    names = ["source_table", "source_type", "sink_table", "sink_type", "sink_columns", "sink_pk", "sink_extend"]

    def literal(value):
        return "cast(null as string)" if value is None else "'" + value.replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"select * from values {values} as t({', '.join(names)})")


def rule_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as captured changes of routing rules, one rule per customer and priority."""
    orders = parquet(spark, sf_dir, "orders")
    rule = F.struct(
        F.concat(F.lit("table_"), text("o_custkey")).alias("source_table"),
        F.lower(F.substring("o_orderpriority", 3, 20)).alias("source_type"),
        F.concat(F.lit("sink_"), text("o_orderkey")).alias("sink_table"),
        F.lit("dim").alias("sink_type"), F.lit("id,name").alias("sink_columns"),
        F.lit("id").alias("sink_pk"), F.lit(None).cast("string").alias("sink_extend"),
    )
    op = F.when(F.col("o_orderstatus") == "F", "d").when(F.col("o_orderstatus") == "P", "u").otherwise("c")
    gone = F.col("o_orderstatus") == "F"
    return orders.select(
        op.alias("op"), F.when(op != "c", rule).alias("before"), F.when(~gone, rule).alias("after"),
        F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("seq"),
    )


def ruled_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as change records of many tables, for the captured rules; ``et`` is their time."""
    kinds = F.array(*[F.lit(k) for k in ("urgent", "high", "medium", "not specified", "low")])
    return _lines(spark, sf_dir).select(
        F.concat(F.lit("table_"), "sku_id").alias("table"), F.element_at(kinds, F.col("l_linenumber") % 5 + 1).alias("type"),
        F.create_map(F.lit("id"), F.col("line_id"), F.lit("name"), F.col("order_id"), F.lit("note"), F.col("quantity")).alias("data"),
        text(F.unix_seconds(F.col("l_shipdate").cast("timestamp"))).alias("ts"), F.col("l_shipdate").cast("timestamp").alias("et"),
    )


#: When the names of the first three codes change.
RENAMED = "1998-06-01 00:00:00"


def dictionary_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code book with times: all codes from the start, three renamed later."""
    names = dictionary(spark, sf_dir)
    start, later = (F.lit(x).cast("timestamp") for x in ("1995-01-01 00:00:00", RENAMED))
    renamed = names.filter("dic_code <= '3'").select("dic_code", F.lower("dic_name").alias("dic_name"), later.alias("since"))
    return names.select("dic_code", "dic_name", start.alias("since")).unionByName(renamed)


def phrases(conversations: DataFrame) -> DataFrame:
    """Conversation turns as phrases typed into a page."""
    seconds = F.lit(1704067200) + F.col("conv_id") * 7 + F.col("turn")
    page = F.when(F.col("turn") % 3 == 0, "search").when(F.col("turn") % 3 == 1, "home").otherwise("other")
    kind = F.when(F.col("role") == "system", "sku").otherwise("keyword")
    return conversations.select(
        F.col("text").alias("item"), page.alias("last_page_id"), kind.alias("item_type"),
        F.timestamp_seconds(seconds).alias("ts"),
    )
