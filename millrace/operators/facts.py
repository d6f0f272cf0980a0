"""Detail facts: change selections joined to each other and to the dictionary.

Each fact takes DataFrames, so the same function serves stored tables and
streams. ``within`` turns the equality joins into time-bounded ones, which is
what lets a stream drop join state; stored tables need no bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import date_id
from millrace.operators.asof import as_of_join

# Fixed value: how long join partners are kept, in seconds.
JOIN_STATE_SECONDS = 1820

#: Dictionary rows that are sent to the rows to be decoded.
BOOK_ROWS = 10_000

# Columns of the order line record that the fact is made of.
DETAIL_COLUMNS = (
    "id", "order_id", "sku_id", "sku_name", "create_time", "source_id", "source_type",
    "sku_num", "order_price", "split_total_amount", "split_activity_amount", "split_coupon_amount",
)


def decode(df: DataFrame, dictionary: DataFrame, code: str, name: str) -> DataFrame:
    """Add the dictionary name of a code; rows with an unknown code are dropped.

    May be applied several times, once per coded column. A dictionary of up to
    ``BOOK_ROWS`` rows, counted as the query runs, goes to the rows; only for a larger
    one are rows dealt out by their codes. For a stream over a dictionary that the
    planner cannot size, pass it through ``code_book`` first.
    """
    names = dictionary.select(F.col("dic_code").alias("_code"), F.col("dic_name").alias(name))

    def named(rows: DataFrame, book: DataFrame) -> DataFrame:
        return rows.join(book, rows[code] == book["_code"]).drop("_code")

    if df.isStreaming or dictionary.isStreaming:
        return named(df, names)
    few = names.limit(BOOK_ROWS + 1)
    small = few.agg((F.count("*") <= BOOK_ROWS).alias("small")).scalar()
    # One of the two has no rows: the other way of joining takes them all.
    return named(df.filter(small), F.broadcast(few)).unionByName(named(df.filter(~small), names))


def code_book(dictionary: DataFrame, max_rows: int = BOOK_ROWS) -> DataFrame:
    """The dictionary as literals, of a size that is checked, for a job that starts.

    A stream joins it without a shuffle, so a handful of codes does not put all
    rows on a handful of tasks. A larger dictionary is returned as it is.
    """
    rows = dictionary.select("dic_code", "dic_name").take(max_rows + 1)
    if len(rows) > max_rows:
        return dictionary
    schema = "dic_code string, dic_name string"
    return F.broadcast(dictionary.sparkSession.createDataFrame([tuple(r) for r in rows], schema))


def decode_as_of(
    df: DataFrame, versions: DataFrame, code: str, name: str, at: str, since: str = "since", order: Sequence[str] = ()
) -> DataFrame:
    """Add the name a code had at the row's own time; rows whose code was unknown then are dropped.

    ``versions`` holds every name with the time it came into force. May be applied
    several times, like ``decode``.
    """
    names = versions.select(F.col("dic_code").alias(code), F.col("dic_name").alias(name), since, *order)
    return as_of_join(df, names, [code], at, since, [name], order, "inner")


def _match(equal: Column, left: str, right: str, within: int | None, salted: bool = False) -> Column:
    """The equality, with both event times no further apart than ``within`` seconds."""
    if salted:
        equal = equal & (F.col(f"{left}._salt") == F.col(f"{right}._salt"))
    if within is None:
        return equal
    span = F.expr(f"interval {within} seconds")
    early, late = F.col(f"{left}.et") - span, F.col(f"{left}.et") + span
    return equal & F.col(f"{right}.et").between(early, late)


def _salted(many: DataFrame, one: DataFrame, salts: int, row: str) -> tuple[DataFrame, DataFrame]:
    """Spread a busy join key over ``salts`` tasks: the single row goes to each.

    Stored tables are split at run time and need none of this; stream joins are not.
    """
    salt = F.pmod(F.xxhash64(row), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return many.withColumn("_salt", salt), one.withColumn("_salt", copies)


def original_amount(quantity: Column, price: Column) -> Column:
    """Quantity times price as text, with the four decimals of the exact product."""
    money = "decimal(16,2)"
    return (quantity.cast(money) * price.cast(money)).cast("string")


def order_detail(
    details: DataFrame,
    orders: DataFrame,
    activities: DataFrame,
    coupons: DataFrame,
    dictionary: DataFrame,
    within: int | None = None,
    salts: int = 1,
) -> DataFrame:
    """Order lines with their order, and with activity and coupon where they have one."""
    # The dictionary drops lines, so it goes before the wider joins.
    d = decode(details, dictionary, "source_type", "source_type_name")
    d, o = _salted(d, orders, salts, "id") if salts > 1 else (d, orders)
    d, o, a, c = (x.alias(n) for x, n in ((d, "d"), (o, "o"), (activities, "a"), (coupons, "c")))
    joined = d.join(o, _match(F.col("d.order_id") == F.col("o.id"), "d", "o", within, salts > 1))
    for side, name in ((a, "a"), (c, "c")):
        on = F.col("d.id") == F.col(f"{name}.order_detail_id")
        joined = joined.join(side, _match(on, "d", name, within), "left")
    extra = ["d.et"] if within is not None else []
    return joined.select(
        "d.id", "d.order_id", "o.user_id", "d.sku_id", "d.sku_name", "o.province_id",
        "a.activity_id", "a.activity_rule_id", "c.coupon_id",
        date_id(F.col("d.create_time")).alias("date_id"),
        "d.create_time", "d.source_id", "d.source_type", "d.source_type_name", "d.sku_num",
        original_amount(F.col("d.sku_num"), F.col("d.order_price")).alias("split_original_amount"),
        "d.split_activity_amount", "d.split_coupon_amount", "d.split_total_amount", "d.ts",
        *extra,
    )


def order_cancel(
    cancelled: DataFrame, details: DataFrame, legacy: bool = False, within: int | None = None, salts: int = 1
) -> DataFrame:
    """Lines of cancelled orders. ``legacy`` reports the creation time as the cancel time."""
    d, c = _salted(details, cancelled, salts, "id") if salts > 1 else (details, cancelled)
    c, d = c.alias("c"), d.alias("d")
    on = _match(F.col("c.id") == F.col("d.order_id"), "c", "d", within, salts > 1)
    moment = F.col("d.create_time" if legacy else "c.operate_time")
    return c.join(d, on).select(
        "d.id", "d.order_id", "c.user_id", "d.sku_id", "d.sku_name", "d.province_id", "d.activity_id",
        "d.activity_rule_id", "d.coupon_id",
        (F.col("d.date_id") if legacy else date_id(moment)).alias("date_id"),
        moment.alias("cancel_time"), "d.source_id", F.col("d.source_type").alias("source_type_code"),
        "d.source_type_name", "d.sku_num", "d.split_original_amount", "d.split_activity_amount",
        "d.split_coupon_amount", "d.split_total_amount", "d.ts",
    )


def payment(
    payments: DataFrame, details: DataFrame, dictionary: DataFrame, within: int | None = None, salts: int = 1
) -> DataFrame:
    """Lines of paid orders, with the payment decoded."""
    p = decode(payments, dictionary, "payment_type", "payment_type_name")
    d, p = _salted(details, p, salts, "id") if salts > 1 else (details, p)
    p, d = p.alias("p"), d.alias("d")
    on = _match(F.col("p.order_id") == F.col("d.order_id"), "p", "d", within, salts > 1)
    return p.join(d, on).select(
        F.col("d.id").alias("order_detail_id"), "d.order_id", "d.user_id", "d.sku_id", "d.sku_name",
        "d.province_id", "d.activity_id", "d.activity_rule_id", "d.coupon_id",
        F.col("p.payment_type").alias("payment_type_code"), "p.payment_type_name", "p.callback_time",
        "d.source_id", F.col("d.source_type").alias("source_type_code"), "d.source_type_name", "d.sku_num",
        "d.split_original_amount", "d.split_activity_amount", "d.split_coupon_amount",
        F.col("d.split_total_amount").alias("split_payment_amount"), "p.ts",
    )


def refund_request(
    requests: DataFrame, orders: DataFrame, dictionary: DataFrame, within: int | None = None, salts: int = 1
) -> DataFrame:
    """Refund requests whose order moved to refunding, decoded by kind and by reason."""
    r = decode(requests, dictionary, "refund_type", "refund_type_name")
    r = decode(r, dictionary, "refund_reason_type", "refund_reason_type_name")
    r, o = _salted(r, orders, salts, "id") if salts > 1 else (r, orders)
    r, o = r.alias("r"), o.alias("o")
    on = _match(F.col("r.order_id") == F.col("o.id"), "r", "o", within, salts > 1)
    return r.join(o, on).select(
        "r.id", "r.user_id", "r.order_id", "r.sku_id", "o.province_id",
        date_id(F.col("r.create_time")).alias("date_id"), "r.create_time",
        F.col("r.refund_type").alias("refund_type_code"), "r.refund_type_name",
        F.col("r.refund_reason_type").alias("refund_reason_type_code"), "r.refund_reason_type_name",
        "r.refund_reason_txt", "r.refund_num", "r.refund_amount", "r.ts",
    )


def refund_paid(
    refunds: DataFrame,
    requests: DataFrame,
    orders: DataFrame,
    dictionary: DataFrame,
    within: int | None = None,
) -> DataFrame:
    """Refunds paid out, matched to the request by order and item, then to the order."""
    p = decode(refunds, dictionary, "payment_type", "payment_type_name").alias("p")
    r, o = requests.alias("r"), orders.alias("o")
    first = (F.col("p.order_id") == F.col("r.order_id")) & (F.col("p.sku_id") == F.col("r.sku_id"))
    joined = p.join(r, _match(first, "p", "r", within))
    joined = joined.join(o, _match(F.col("p.order_id") == F.col("o.id"), "p", "o", within))
    return joined.select(
        "p.id", "o.user_id", "p.order_id", "p.sku_id", "o.province_id",
        F.col("p.payment_type").alias("payment_type_code"), "p.payment_type_name",
        date_id(F.col("p.callback_time")).alias("date_id"), "p.callback_time", "r.refund_num",
        F.col("p.total_amount").alias("refund_amount"), "p.ts",
    )


def left_join_upsert(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """All left rows, with the right columns where the key matches."""
    return left.join(right, key, "left")
