"""The eleven window summaries, from detail rows with an event time ``ts``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import blank, flag, seconds_to_time
from millrace.functions.text import explode_words, words
from millrace.operators.dims import Hop, enrich
from millrace.operators.users import first_of_day, first_row_of_day, mark_new, mark_returning
from millrace.operators.versions import sums_of_newest
from millrace.operators.windows import WINDOW, stamp, sum_by_window, tumble
from millrace.schemas import ORDER_DETAIL_FACT, strings
from millrace.sources.text import typed

PAGE_DIMS = ("vc", "ch", "ar", "is_new")


def search_phrases(pages: DataFrame) -> DataFrame:
    """Phrases typed on the search or home page."""
    typed = F.col("last_page_id").isin("search", "home") & (F.col("item_type") == "keyword")
    return pages.filter(typed & F.col("item").isNotNull()).select("item", "ts")


def keyword_window(pages: DataFrame, width: str = WINDOW, split=words) -> DataFrame:
    rows = explode_words(search_phrases(pages), "item", "keyword", split)
    counts = rows.groupBy(tumble("ts", width), "keyword").agg(F.count("*").alias("keyword_count"))
    return stamp(counts)


def page_view_parts(pages: DataFrame, visits: DataFrame) -> DataFrame:
    """Measures of page rows and of first visits, as addable rows."""
    zero = F.lit(0).cast("bigint")
    views = pages.select(
        "ts", *PAGE_DIMS, zero.alias("uv_ct"), flag(blank(F.col("last_page_id"))).alias("sv_ct"),
        F.lit(1).cast("bigint").alias("pv_ct"), F.coalesce("during_time", zero).alias("dur_sum"),
    )
    firsts = visits.select(
        "ts", *PAGE_DIMS, F.lit(1).cast("bigint").alias("uv_ct"), zero.alias("sv_ct"),
        zero.alias("pv_ct"), zero.alias("dur_sum"),
    )
    return views.unionByName(firsts)


def page_view_window(pages: DataFrame, width: str = WINDOW, order: Sequence[str] = ("ts",)) -> DataFrame:
    """Visitors, sessions, views and time per version, channel, area and visitor kind.

    Pages are read once: one aggregate holds the sums per window and, beside them,
    the first row of each device and day, which is then counted in its window. Both
    are reduced before the shuffle, and no device's rows are sorted.
    """
    timed = pages.withColumn("win", tumble("ts", width))
    kinds = {c: timed.schema[c].dataType for c in ("win", *PAGE_DIMS, "mid")}
    own, zero = {c: F.col(c) for c in kinds}, F.lit(0).cast("bigint")
    none = {c: F.lit(None).cast(k) for c, k in kinds.items()}
    first = F.struct(*order, "win", *PAGE_DIMS)
    kind_of_first = timed.select(first.alias("f")).schema["f"].dataType

    def row(visit: bool, keys: dict, device: Column, day: Column, opening: Column, *measures: Column) -> Column:
        named = [keys[c].alias(c) for c in ("win", *PAGE_DIMS)]
        sums = [m.alias(n) for n, m in zip(("sv_ct", "pv_ct", "dur_sum"), measures)]
        return F.struct(F.lit(visit).alias("visit"), *named, device.alias("mid"), day.alias("day"), opening.alias("first"), *sums)

    view = row(
        False, own, none["mid"], F.lit(None).cast("date"), F.lit(None).cast(kind_of_first),
        flag(blank(F.col("last_page_id"))), F.lit(1).cast("bigint"), F.coalesce(F.col("during_time").cast("bigint"), zero),
    )
    visit = row(True, none, own["mid"], F.to_date(order[0]), first, zero, zero, zero)
    both = timed.select(F.inline(F.array(view, visit)))
    reduced = both.groupBy("visit", "win", *PAGE_DIMS, "mid", "day").agg(
        F.min("first").alias("first"), *[F.sum(c).alias(c) for c in ("sv_ct", "pv_ct", "dur_sum")]
    )
    placed = [F.when(F.col("visit"), F.col(f"first.{c}")).otherwise(F.col(c)).alias(c) for c in ("win", *PAGE_DIMS)]
    parts = reduced.select(*placed, flag(F.col("visit")).alias("uv_ct"), "sv_ct", "pv_ct", "dur_sum")
    return stamp(parts.groupBy("win", *PAGE_DIMS).agg(*[F.sum(c).alias(c) for c in ("uv_ct", "sv_ct", "pv_ct", "dur_sum")]))


def home_detail_parts(visits: DataFrame) -> DataFrame:
    return visits.select(
        "ts", flag(F.col("page_id") == "home").alias("home_uv_ct"),
        flag(F.col("page_id") == "good_detail").alias("good_detail_uv_ct"),
    )


def home_detail_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col("page_id").isin("home", "good_detail"))


def home_detail_uv_window(pages: DataFrame, width: str = WINDOW) -> DataFrame:
    visits = first_of_day(home_detail_pages(pages), ["mid", "page_id"])
    return sum_by_window(home_detail_parts(visits), (), ["home_uv_ct", "good_detail_uv_ct"], width)


def logins(pages: DataFrame) -> DataFrame:
    """Rows of a known user that opened the app or came from the login page."""
    came = F.col("last_page_id").isNull() | (F.col("last_page_id") == "login")
    return pages.filter(F.col("uid").isNotNull() & came)


def login_window(pages: DataFrame, width: str = WINDOW) -> DataFrame:
    days = mark_returning(first_of_day(logins(pages), ["uid"]), ["uid"])
    parts = days.select("ts", F.col("is_back").alias("back_ct"), F.lit(1).cast("bigint").alias("uu_ct"))
    return sum_by_window(parts, (), ["back_ct", "uu_ct"], width)


def register_window(users: DataFrame, width: str = WINDOW) -> DataFrame:
    return stamp(users.groupBy(tumble("ts", width)).agg(F.count("*").alias("register_ct")))


def cart_uu_window(carts: DataFrame, width: str = WINDOW) -> DataFrame:
    days = first_of_day(carts, ["user_id"])
    return stamp(days.groupBy(tumble("ts", width)).agg(F.count("*").alias("cart_add_uu_ct")))


def _unique_and_new(rows: DataFrame, unique: str, new: str, width: str) -> DataFrame:
    days = mark_new(first_of_day(rows, ["user_id"]), ["user_id"])
    parts = days.select("ts", F.lit(1).cast("bigint").alias(unique), F.col("is_new").alias(new))
    return sum_by_window(parts, (), [unique, new], width)


def payment_window(payments: DataFrame, width: str = WINDOW) -> DataFrame:
    return _unique_and_new(payments, "payment_suc_unique_user_count", "payment_suc_new_user_count", width)


def order_window(orders: DataFrame, width: str = WINDOW) -> DataFrame:
    return _unique_and_new(orders, "order_unique_user_count", "order_new_user_count", width)


SKU_AMOUNTS = ("original_amount", "activity_amount", "coupon_amount", "order_amount")


def _from_text(fact: DataFrame, schema: T.StructType, value: str | None) -> DataFrame:
    """Fact columns, out of JSON text where ``value`` names it."""
    return typed(fact, schema, "json", value) if value else fact


def _amount(column: str, scale: int = 2, default: bool = True) -> Column:
    """An exact amount from text; null counts as zero where a default is asked for."""
    amount = F.col(column).cast(f"decimal(18,{scale})")
    return F.coalesce(amount, F.lit(0).cast(f"decimal(18,{scale})")) if default else amount


def sku_details(fact: DataFrame, value: str | None = None, default_all: bool = False) -> DataFrame:
    """Typed rows for ``sku_order_window`` from the order detail fact, all text, seconds in ``ts``.

    A missing activity or coupon amount is zero; with ``default_all`` so are the
    other two, which otherwise stay null.
    """
    rows = _from_text(fact, ORDER_DETAIL_FACT, value)
    return rows.select(
        F.col("id").alias("order_detail_id"), "sku_id", seconds_to_time("ts").alias("ts"),
        _amount("split_original_amount", 4, default_all).alias("original_amount"),
        _amount("split_activity_amount").alias("activity_amount"), _amount("split_coupon_amount").alias("coupon_amount"),
        _amount("split_total_amount", 2, default_all).alias("order_amount"),
    )


def province_details(fact: DataFrame, value: str | None = None) -> DataFrame:
    """Typed rows for ``province_order_window`` from the order detail fact."""
    rows = _from_text(fact, ORDER_DETAIL_FACT, value)
    return rows.select(
        F.col("id").alias("order_detail_id"), "order_id", "province_id", seconds_to_time("ts").alias("ts"),
        _amount("split_total_amount", 2, False).alias("order_amount"),
    )


def refund_details(fact: DataFrame, value: str | None = None) -> DataFrame:
    """Typed rows for ``refund_window`` from the refund request fact."""
    rows = _from_text(fact, strings("user_id", "order_id", "sku_id", "ts"), value)
    return rows.select("user_id", "order_id", "sku_id", seconds_to_time("ts").alias("ts"))


def sku_order_window(
    details: DataFrame, order: Sequence[str], hops: Sequence[Hop] = (), key: str = "sku_id",
    width: str = WINDOW, on_missing: str = "null",
) -> DataFrame:
    """Net amounts per item; ``key='order_detail_id'`` keeps order lines apart.

    Names are looked up for the sums, not for the lines.
    """
    lines = details.withColumn("win", tumble("ts", width))
    groups = ["win", *dict.fromkeys((key, "sku_id"))]
    sums = sums_of_newest(lines, ["order_detail_id"], order, SKU_AMOUNTS, groups)
    return enrich(stamp(sums), hops, on_missing)


def province_parts(details: DataFrame, width: str) -> DataFrame:
    """Amount per window, province and order: the first step of a distinct count."""
    keys = (tumble("ts", width), "province_id", "order_id")
    return details.groupBy(*keys).agg(F.sum("order_amount").alias("order_amount"))


def province_sums(net: DataFrame, hops: Sequence[Hop] = (), width: str = WINDOW, on_missing: str = "null") -> DataFrame:
    """Distinct orders and amount per province, from netted order lines."""
    return province_totals(province_parts(net, width), hops, on_missing)


def province_totals(orders: DataFrame, hops: Sequence[Hop] = (), on_missing: str = "null") -> DataFrame:
    """The same from a row per window, province and order: the second step."""
    sums = orders.groupBy("win", "province_id").agg(
        F.count("*").alias("order_count"), F.sum("order_amount").alias("order_amount")
    )
    return enrich(stamp(sums), hops, on_missing)


def province_order_window(
    details: DataFrame, order: Sequence[str], hops: Sequence[Hop] = (), width: str = WINDOW,
    on_missing: str = "null",
) -> DataFrame:
    """Distinct orders and net amount per province.

    Orders are counted where any of their lines was seen, replaced or not.
    """
    lines = details.withColumn("win", tumble("ts", width))
    groups = ["win", "province_id", "order_id"]
    orders = sums_of_newest(lines, ["order_detail_id"], order, ["order_amount"], groups)
    return province_totals(orders, hops, on_missing)


REFUND_DIMS = ("category3_id", "category2_id", "category1_id", "trademark_id", "user_id")


def refund_window(
    refunds: DataFrame, before: Sequence[Hop], after: Sequence[Hop] = (), carry: Sequence[str] = (),
    width: str = WINDOW, on_missing: str = "null",
) -> DataFrame:
    """Distinct refunded orders per brand, category and user.

    The group keys are looked up before the count, further names for its result.
    ``carry`` lists names that follow from the keys and ride along.
    """
    known = enrich(refunds, before, on_missing)
    dims = [*REFUND_DIMS, *carry]
    orders = known.groupBy(tumble("ts", width), *dims, "order_id").agg(F.count("*").alias("_rows"))
    counts = orders.groupBy("win", *dims).agg(F.count("*").alias("refund_count"))
    return enrich(stamp(counts), after, on_missing)
