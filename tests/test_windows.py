import pytest
from pyspark.sql import functions as F

from millrace.operators import keyvalue, summaries, users, windows
from millrace.operators.dims import Hop, enrich


def sensor(spark, *times):
    return spark.createDataFrame([(i, t) for i, t in enumerate(times)], "n int, ms bigint").withColumn(
        "ts", F.timestamp_millis("ms")
    )


def timed(spark, schema, *items):
    return spark.createDataFrame(list(items), schema + ", ts string").withColumn("ts", F.to_timestamp("ts"))


def test_tumbling_windows_are_aligned_and_half_open(spark, rows):
    df = sensor(spark, 0, 4999, 5000, 9999, 10000)
    counts = windows.stamp(df.groupBy(windows.tumble()).agg(F.count("*").alias("n")))
    assert rows(counts) == [
        ("1970-01-01 00:00:00", "1970-01-01 00:00:05", 2),
        ("1970-01-01 00:00:05", "1970-01-01 00:00:10", 2),
        ("1970-01-01 00:00:10", "1970-01-01 00:00:15", 1),
    ]


def test_version_stamp(spark):
    df = sensor(spark, 0).groupBy(windows.tumble()).agg(F.count("*").alias("n"))
    assert windows.stamp(df, 42).columns == ["stt", "edt", "n", "ts"]


def test_late_rows_by_arrival(spark, rows):
    df = sensor(spark, 1000, 10999, 1500, 11000, 1600).withColumn("src", F.lit(0))
    on_time, late = windows.split_late(df, ["src"], ["n"], "ms")
    assert rows(late, "ms") == [(1600,)]
    assert rows(on_time, "ms", "refire") == [(1000, False), (10999, False), (11000, False), (1500, True)]


def test_refire_counts(spark, rows):
    df = sensor(spark, 1000, 10999, 1500, 11000, 1600).withColumn("src", F.lit(0))
    counts = windows.refire_counts(windows.mark_late(df, ["src"], ["n"], "ms"))
    assert rows(counts, "edt", "first_ct", "refire_ct", "late_ct", "final_ct") == [
        ("1970-01-01 00:00:05", 1, 1, 1, 2), ("1970-01-01 00:00:15", 2, 0, 0, 2)
    ]


def test_sources_have_their_own_watermarks(spark, rows):
    df = sensor(spark, 1000, 20000, 1100, 1200).withColumn("src", F.col("n") % 2)
    traced = windows.watermark_trace(df, ["src"], ["n"], "ms", 3000)
    assert rows(traced, "n", "watermark") == [(0, None), (1, None), (2, -2001), (3, 16999)]


def test_window_rows_come_in_order_and_in_chunks(spark, rows):
    df = sensor(spark, 4000, 1000, 3000, 2000, 7000)
    lists = windows.window_rows(df, ["ms"], ["ts", "n"], chunk=3)
    got = [(r.stt[-2:], r.chunk, [x.ms for x in r["rows"]]) for r in lists.orderBy("stt", "chunk").collect()]
    assert got == [("00", 0, [1000, 2000, 3000]), ("00", 1, [4000]), ("05", 0, [7000])]


def test_first_and_returning_days(spark, rows):
    df = timed(
        spark, "uid string", ("u", "2024-01-01 10:00:00"), ("u", "2024-01-01 09:00:00"),
        ("u", "2024-01-08 01:00:00"), ("u", "2024-01-17 23:00:00"),
    )
    days = users.mark_new(users.mark_returning(users.first_of_day(df, ["uid"]), ["uid"]), ["uid"])
    assert rows(days.withColumn("ts", F.date_format("ts", "dd HH")), "ts", "is_new", "is_back") == [
        ("01 09", 1, 0), ("08 01", 0, 0), ("17 23", 0, 1)
    ]


def test_login_rule(spark, rows):
    df = timed(
        spark, "uid string, last_page_id string", ("u", None, "2024-01-01 10:00:00"),
        ("u", "home", "2024-01-02 10:00:00"), ("u", "login", "2024-01-10 10:00:00"), (None, None, "2024-01-01 10:00:00"),
    )
    assert rows(summaries.login_window(df, "1 day"), "stt", "back_ct", "uu_ct") == [
        ("2024-01-01 00:00:00", 0, 1), ("2024-01-10 00:00:00", 1, 1)
    ]


def test_page_view_sums(spark, rows):
    names = "mid string, vc string, ch string, ar string, is_new string, last_page_id string, during_time bigint"
    df = timed(
        spark, names, ("m", "v", "c", "a", "1", None, 5, "2024-01-01 00:00:01"),
        ("m", "v", "c", "a", "1", "home", None, "2024-01-01 00:00:02"),
        ("n", "v", "c", "a", "1", "", 7, "2024-01-01 00:00:03"),
        ("m", "v", "c", "a", "1", "home", 1, "2024-01-02 00:00:00"),
    )
    got = summaries.page_view_window(df)
    assert rows(got, "stt", "uv_ct", "sv_ct", "pv_ct", "dur_sum") == [
        ("2024-01-01 00:00:00", 2, 2, 3, 12), ("2024-01-02 00:00:00", 1, 0, 1, 1)
    ]


def test_home_and_detail_are_counted_apart(spark, rows):
    df = timed(
        spark, "mid string, page_id string", ("m", "home", "2024-01-01 00:00:00"), ("m", "good_detail", "2024-01-01 00:00:01"),
        ("m", "home", "2024-01-01 00:00:02"), ("m", "cart", "2024-01-01 00:00:02"), ("n", "home", "2024-01-01 00:00:09"),
    )
    assert rows(summaries.home_detail_uv_window(df), "stt", "home_uv_ct", "good_detail_uv_ct") == [
        ("2024-01-01 00:00:00", 1, 1), ("2024-01-01 00:00:05", 1, 0)
    ]


def test_keywords_count_once_per_phrase(spark, rows):
    df = timed(
        spark, "item string, item_type string, last_page_id string",
        ("Phone red phone, PHONE", "keyword", "search", "2024-01-01 00:00:01"),
        ("phone", "keyword", "home", "2024-01-01 00:00:02"), ("phone", "sku", "home", "2024-01-01 00:00:02"),
        ("phone", "keyword", "cart", "2024-01-01 00:00:02"), (None, "keyword", "home", "2024-01-01 00:00:02"),
    )
    assert rows(summaries.keyword_window(df), "keyword", "keyword_count") == [("phone", 2), ("red", 1)]


def test_custom_segmenter(spark, rows):
    from millrace.functions.text import explode_words, segmenter

    pairs = segmenter(lambda p: [p[i:i + 2] for i in range(0, len(p), 2)])
    df = spark.createDataFrame([(1, "ababcd"), (2, None)], "n int, t string")
    assert rows(explode_words(df, "t", split=pairs)) == [(1, "ab"), (1, "cd")]


def orders(spark):
    schema = "order_detail_id string, order_id string, province_id string, sku_id string, order_amount bigint, v int"
    df = timed(
        spark, schema, ("1", "o1", "p", "s", 10, 1, "2024-01-01 00:00:00"), ("2", "o1", "p", "s", 20, 1, "2024-01-01 00:00:01"),
        ("3", "o2", "p", "t", 30, 1, "2024-01-01 00:00:02"), ("4", "o3", "p", "t", 40, 1, "2024-01-01 00:00:03"),
        ("4", "o3", "p", "t", 44, 2, "2024-01-01 00:00:04"), ("3", "o2", "p", "t", 33, 2, "2024-01-01 00:00:06"),
    )
    return df.selectExpr("*", "order_amount original_amount", "0L activity_amount", "0L coupon_amount")


def test_province_counts_orders_not_lines(spark, rows):
    names = spark.createDataFrame([("p", "North")], "id string, name string")
    got = summaries.province_order_window(orders(spark), ["v"], [Hop("province_id", names, {"province_name": "name"})])
    assert rows(got, "stt", "order_count", "order_amount", "province_name") == [
        ("2024-01-01 00:00:00", 3, 74, "North"), ("2024-01-01 00:00:05", 1, 33, "North")
    ]


def test_sku_sums_by_item_or_by_line(spark, rows):
    by_item = summaries.sku_order_window(orders(spark), ["v"])
    assert rows(by_item, "stt", "sku_id", "order_amount") == [
        ("2024-01-01 00:00:00", "s", 30), ("2024-01-01 00:00:00", "t", 44), ("2024-01-01 00:00:05", "t", 33)
    ]
    by_line = summaries.sku_order_window(orders(spark), ["v"], key="order_detail_id")
    assert by_line.count() == 5 and {"order_detail_id", "sku_id"} <= set(by_line.columns)


def test_decimal_amounts_stay_decimal(spark):
    df = orders(spark).withColumn("order_amount", F.col("order_amount").cast("decimal(16,2)"))
    got = summaries.sku_order_window(df, ["v"])
    assert dict(got.dtypes)["order_amount"] == "decimal(26,2)"


def dims(spark):
    sku = spark.createDataFrame([("s", "c9", "Shoe"), ("t", "missing", "Tie")], "id string, cat string, name string")
    cat = spark.createDataFrame([("c9", "root")], "id string, parent string")
    return [Hop("sku_id", sku, {"sku_name": "name", "cat_id": "cat"}), Hop("cat_id", cat, {"root_id": "parent"})]


def test_enrich_keeps_drops_or_fails(spark, rows):
    df = spark.createDataFrame([("s",), ("t",), ("x",), (None,)], "sku_id string")
    assert rows(enrich(df, dims(spark))) == [
        ("s", "Shoe", "c9", "root"), ("t", "Tie", "missing", None), ("x", None, None, None), (None, None, None, None)
    ]
    assert rows(enrich(df, dims(spark), "drop")) == [("s", "Shoe", "c9", "root")]
    with pytest.raises(Exception, match="no dimension row for sku_id=x"):
        enrich(df.filter("sku_id = 'x'"), dims(spark), "error").collect()
    assert enrich(df.filter("sku_id = 's'"), dims(spark), "error").count() == 1
    with pytest.raises(ValueError):
        enrich(df, [Hop("nothing", dims(spark)[0].dim, {})])


def test_enrich_joins_the_rows_once_per_chain(spark):
    df = spark.range(100).select(F.lit("s").alias("sku_id"))
    plan = enrich(df, dims(spark))._jdf.queryExecution().analyzed().toString()
    assert plan.count("Join") == 2


def kv(spark):
    return spark.createDataFrame(
        [("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z"), ("a", 4, "x")], "k string, o int, value string"
    )


def test_key_value_views(spark, rows):
    df = kv(spark)
    assert rows(keyvalue.last_value(df, "k", ["o"])) == [("a", "x"), ("b", "y")]
    lists = keyvalue.pushed_list(df, "k", ["o"], chunk=2)
    assert rows(lists) == [("a", 0, ["x", "z"]), ("a", 1, ["x"]), ("b", 0, ["y"])]
    assert rows(keyvalue.members(df, "value")) == [("x",), ("y",), ("z",)]
    ranked = keyvalue.ranked_members(df, "value", "o", ["o"])
    assert rows(ranked.orderBy("place")) == [("x", 4, 2), ("y", 2, 0), ("z", 3, 1)]
