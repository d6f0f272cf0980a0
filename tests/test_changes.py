from pyspark.sql import functions as F

from millrace.operators import changes, dims, facts
from millrace.schemas import CHANGE
from millrace.sources.changelog import read_changes, read_rule_changes


def log(spark, *records):
    rows = [("shop", t, k, str(i), d, o) for i, (t, k, d, o) in enumerate(records)]
    return spark.createDataFrame(rows, CHANGE)


def test_cart_counts_growth_only(spark, rows):
    base = {"id": "1", "user_id": "u", "sku_id": "s", "source_type": "1"}
    df = log(
        spark,
        ("cart_info", "insert", {**base, "sku_num": "2"}, None),
        ("cart_info", "update", {**base, "sku_num": "6"}, {"sku_num": "2"}),
        ("cart_info", "update", {**base, "sku_num": "3"}, {"sku_num": "6"}),
        ("cart_info", "update", {**base, "sku_num": "9"}, {"cart_price": "1"}),
        ("cart_info", "delete", {**base, "sku_num": "9"}, None),
        ("other", "insert", {**base, "sku_num": "7"}, None),
    )
    assert rows(changes.cart_additions(df), "ts", "sku_num") == [("0", 2), ("1", 4)]
    assert changes.cart_additions(df, "elsewhere").count() == 0


def test_clean_keeps_usable_records(spark, rows):
    df = log(
        spark,
        ("t", "bootstrap-insert", {"id": "1"}, None),
        ("t", "update", {"id": "bootstrap-2"}, {"id": "x"}),
        ("t", "delete", {"id": "3"}, None),
        ("t", "bootstrap-start", {"id": "4"}, None),
        ("t", "insert", {}, None),
        ("t", "insert", None, None),
        (None, "insert", {"id": "7"}, None),
    )
    cleaned = changes.clean_changes(df, "shop")
    assert rows(cleaned, "type", F.col("data")["id"]) == [("insert", "1"), ("update", "bootstrap-2")]


def test_text_records_parse_and_bad_ones_give_nulls(spark):
    text = '{"database":"shop","table":"t","type":"insert","ts":5,"data":{"id":7,"name":null},"old":null}'
    df = spark.createDataFrame([(text,), ("{broken",)], "value string")
    got = read_changes(df).collect()
    assert got[0].data == {"id": "7", "name": None} and got[0].ts == "5"
    assert got[1].table is None


def test_capture_takes_before_for_deletes(spark, rows):
    rule = '{"source_table":"%s","sink_table":"x"}'
    df = spark.createDataFrame(
        [
            ('{"op":"d","before":%s,"after":null}' % (rule % "old"),),
            ('{"op":"u","before":%s,"after":%s}' % (rule % "old", rule % "new"),),
        ],
        "value string",
    )
    assert rows(read_rule_changes(df), "source_table", "op") == [("new", "u"), ("old", "d")]


def test_status_transition_needs_the_status_to_change(spark, rows):
    df = log(
        spark,
        ("order_info", "update", {"id": "1", "order_status": "1003"}, {"order_status": "1001"}),
        ("order_info", "update", {"id": "2", "order_status": "1003"}, {"note": "x"}),
        ("order_info", "insert", {"id": "3", "order_status": "1003"}, None),
    )
    assert rows(changes.status_changes(df, ["id"], changes.CANCELLED)) == [("1", "0")]


def test_flat_and_record_logs_select_alike(spark, rows, tables):
    from millrace.plans import adapters as a

    flat = a.order_changes(spark, tables)
    packed = a.as_records(flat)
    for to in (changes.CANCELLED, changes.REFUNDED):
        pick = ["id", "user_id", "operate_time"]
        assert rows(changes.status_changes(flat, pick, to)) == rows(changes.status_changes(packed, pick, to))


def test_flat_log_is_pruned_and_filtered_in_the_scan(spark, tables):
    from millrace.plans import adapters as a

    df = changes.status_changes(a.order_changes(spark, tables), ["id"], changes.CANCELLED)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan
    assert plan.count("FileScan") == 1
    assert "o_custkey" not in plan and "o_totalprice" not in plan


def rules(spark, *items):
    names = ["source_table", "source_type", "sink_table", "sink_type", "sink_columns", "sink_pk", "sink_extend"]
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([tuple(i) for i in items], schema)


def test_coupon_route_follows_the_transition(spark, rows):
    set_of = rules(
        spark,
        ("coupon_use", "insert", "got", "dwd", "id", None, None),
        ("coupon_use", "update", "ordered", "dwd", "id,coupon_status", None, dims.COUPON_USED),
        ("coupon_use", "update", "paid", "dwd", "id", None, dims.COUPON_PAID),
    )
    moved = [("1401", "1402"), ("1402", "1403"), ("1401", "1403")]
    df = log(
        spark,
        ("coupon_use", "insert", {"id": "0", "x": "y"}, None),
        *[("coupon_use", "update", {"id": n, "coupon_status": n}, {"coupon_status": o}) for o, n in moved],
    )
    got = rows(dims.route_facts(df, set_of).select("sink_table", F.to_json("data")))
    assert got == [
        ("got", '{"id":"0","op_type":"insert"}'),
        ("ordered", '{"id":"1402","coupon_status":"1402","op_type":"update"}'),
        ("paid", '{"id":"1403","op_type":"update"}'),
    ]


def test_unrouted_records_are_dropped_and_columns_pruned(spark, rows):
    set_of = rules(spark, ("a", "ALL", "dim_a", "dim", "id,name", "id", None))
    df = log(spark, ("a", "update", {"id": "1", "name": "n", "secret": "s"}, {}), ("b", "insert", {"id": "2"}, None))
    got = dims.route_dims(df, set_of).collect()
    assert [(r.sink_table, r.data) for r in got] == [("dim_a", {"id": "1", "name": "n", "op_type": "update"})]


def test_rules_follow_their_changes(spark, rows):
    names = "source_table string, source_type string, sink_table string, sink_extend string, op string, seq int"
    df = spark.createDataFrame(
        [
            ("a", "ALL", "one", None, "r", 1), ("a", "ALL", "two", None, "u", 2),
            ("b", "ALL", "three", None, "c", 3), ("b", "ALL", "three", None, "d", 4),
            ("c", "update", "four", "x", "c", 5), ("c", "update", "five", None, "c", 6),
        ],
        names,
    )
    assert rows(dims.current_rules(df, ["seq"]), "source_table", "sink_table", "sink_extend") == [
        ("a", "two", None), ("c", "five", None), ("c", "four", "x")
    ]


def test_decode_drops_unknown_codes(spark, rows):
    names = spark.createDataFrame([("1", "one")], "dic_code string, dic_name string")
    df = spark.createDataFrame([("1", "1"), ("1", "9"), ("9", "1")], "a string, b string")
    once = facts.decode(df, names, "a", "a_name")
    assert rows(once) == [("1", "1", "one"), ("1", "9", "one")]
    assert rows(facts.decode(once, names, "b", "b_name")) == [("1", "1", "one", "one")]


def test_original_amount_has_four_decimals(spark):
    df = spark.createDataFrame([("3", "19.99")], "n string, p string")
    assert df.select(facts.original_amount(F.col("n"), F.col("p"))).first()[0] == "59.9700"


def test_cancel_time_by_default_and_legacy(spark):
    detail = {c: "x" for c in ("id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
                               "coupon_id", "source_id", "source_type", "source_type_name", "sku_num",
                               "split_original_amount", "split_activity_amount", "split_coupon_amount",
                               "split_total_amount", "ts")}
    detail |= {"order_id": "o", "date_id": "2024-01-01", "create_time": "2024-01-01 10:00:00"}
    details = spark.createDataFrame([detail])
    cancelled = spark.createDataFrame([("o", "u", "2024-01-03 09:00:00")], "id string, user_id string, operate_time string")
    new = facts.order_cancel(cancelled, details).first()
    old = facts.order_cancel(cancelled, details, legacy=True).first()
    assert (new.cancel_time, new.date_id, new.user_id) == ("2024-01-03 09:00:00", "2024-01-03", "u")
    assert (old.cancel_time, old.date_id) == ("2024-01-01 10:00:00", "2024-01-01")


def test_strict_refunds_are_completed_ones(spark, rows):
    df = log(
        spark,
        ("refund_payment", "insert", {"id": "1", "refund_status": "0701"}, None),
        ("refund_payment", "update", {"id": "2", "refund_status": "0705"}, {"refund_status": "0701"}),
        ("refund_payment", "update", {"id": "3", "refund_status": "0705"}, {"note": "x"}),
    )
    assert rows(changes.refund_records(df, "refund_payment", ["id"]), "id") == [("1",), ("2",), ("3",)]
    assert rows(changes.refund_records(df, "refund_payment", ["id"], strict=True), "id") == [("2",)]


def test_a_dictionary_goes_to_the_rows_unless_it_is_large(spark, rows, monkeypatch):
    df = spark.createDataFrame([("1", 1), ("1", 2), ("2", 3), ("9", 4), (None, 5)], "a string, i int")
    names = spark.createDataFrame([("1", "one"), ("1", "uno"), ("2", "two"), (None, "none")], "dic_code string, dic_name string")
    want = [("1", 1, "one"), ("1", 1, "uno"), ("1", 2, "one"), ("1", 2, "uno"), ("2", 3, "two")]
    name, usual = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    spark.conf.set(name, "-1")
    try:
        for most in (10_000, 4, 3, 0):
            monkeypatch.setattr(facts, "BOOK_ROWS", most)
            found = facts.decode(df, names, "a", "a_name")
            # However small the planner takes it for, rows are not first dealt out by a handful of codes.
            assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
            assert rows(found) == want
    finally:
        spark.conf.unset(name) if usual is None else spark.conf.set(name, usual)
