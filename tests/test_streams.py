"""Streams fed in several micro-batches, against the batch forms."""

import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import facts, summaries, versions
from millrace.operators.changes import select_changes, status_changes
from millrace.operators.dims import Hop
from millrace.operators.logs import parse_logs, repair_visitors, split_logs
from millrace.sources.changelog import with_change_time
from millrace.streaming import jobs, sinks, stateful
from millrace.streaming.stored import repair_visitors_to, revision_changes_to


@pytest.fixture
def feed(spark, tmp_path):
    """Write each part as its own file, read one file per micro-batch."""

    def make(name, schema, *parts):
        folder = str(tmp_path / name)
        for n, part in enumerate(parts):
            spark.createDataFrame(list(part), schema).coalesce(1).write.mode("append").parquet(folder)
            for file in os.listdir(folder):
                path = os.path.join(folder, file)
                if os.stat(path).st_mtime > 1_000_000:
                    os.utime(path, (1000 * (n + 1), 1000 * (n + 1)))
        spread = spark.read.parquet(folder)
        stream = spark.readStream.schema(spread.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        return stream, spread

    return make


@pytest.fixture
def finish(spark, tmp_path):
    def run(job, name="out", **options):
        jobs.run(job, str(tmp_path / f"{name}-state"), path=str(tmp_path / name), **options)
        return spark.read.parquet(str(tmp_path / name)).drop(sinks.BATCH)

    return run


def at(df, col="ts"):
    return df.withColumn(col, F.to_timestamp(col))


DAY1 = [("u", "2024-01-01 00:00:01"), ("u", "2024-01-01 00:00:02"), ("w", "2024-01-01 00:00:08")]
DAY1_MORE = [("u", "2024-01-01 00:00:09"), ("v", "2024-01-01 00:00:07")]
DAY2 = [("u", "2024-01-02 00:00:00"), ("w", "2024-01-10 00:00:00")]
END = [("z", "2024-02-01 00:00:00")]


def test_user_counts_over_batches(feed, finish, rows):
    stream, stored = feed("in", "user_id string, ts string", DAY1, DAY1_MORE, DAY2, END)
    got = finish(jobs.order_window(at(stream)))
    want = summaries.order_window(at(stored)).filter("stt < '2024-02-01'")
    assert rows(got, *want.columns) == rows(want)


def test_returning_users_over_batches(feed, finish, rows):
    schema = "uid string, ts string"
    stream, stored = feed("in", schema, DAY1, DAY1_MORE, DAY2, END)
    pages = [at(df).withColumn("last_page_id", F.lit("login")) for df in (stream, stored)]
    got = finish(jobs.login_window(pages[0]))
    want = summaries.login_window(pages[1]).filter("stt < '2024-02-01'")
    assert rows(got, *want.columns) == rows(want)
    assert sum(r.back_ct for r in got.collect()) == 1


def test_forgotten_keys_still_count_each_day(feed, finish, rows):
    stream, stored = feed("in", "user_id string, ts string", DAY1, DAY2, [("u", "2024-01-15 00:00:00")], END)
    got = finish(jobs.cart_uu_window(at(stream)))
    want = summaries.cart_uu_window(at(stored)).filter("stt < '2024-02-01'")
    assert rows(got, *want.columns) == rows(want)


def test_day_visits_follow_event_time_when_late(feed, finish, rows):
    """A row of day one comes after day two has begun, inside the watermark."""
    stream, _ = feed(
        "in", "k string, ts string", [("a", "2024-01-02 00:00:00")], [("a", "2024-01-01 23:59:59")],
        [("a", "2024-01-03 00:00:00")], END, END,
    )
    got = finish(stateful.day_visits(jobs.timed(at(stream)), ["k"], "5 seconds"))
    assert rows(got.filter("k = 'a'").select(F.dayofmonth("ts"), "first_ever")) == [(1, 1), (2, 0), (3, 0)]


def test_a_busy_key_reaches_the_state_once_per_window(feed, finish, rows):
    part = [("hot", f"2024-01-01 00:00:{s:02d}") for s in range(20)] * 50
    stream, _ = feed("in", "user_id string, ts string", part, END, END)
    job = jobs.order_window(at(stream))
    got = finish(job)
    assert rows(got, "stt", "order_unique_user_count", "order_new_user_count") == [("2024-01-01 00:00:00", 1, 1)]
    plan = job._jdf.queryExecution().analyzed().toString()
    assert plan.index("TransformWithState") < plan.rindex("Aggregate")


def test_page_views_over_batches(feed, finish, rows):
    schema = "mid string, vc string, ch string, ar string, is_new string, last_page_id string, during_time bigint, ts string"
    dims = ("v", "c", "a", "1")
    parts = (
        [("m", *dims, None, 5, "2024-01-01 00:00:01"), ("m", *dims, "home", None, "2024-01-01 00:00:02")],
        [("m", *dims, "home", 2, "2024-01-01 00:00:06"), ("n", "v2", *dims[1:], "", 1, "2024-01-01 00:00:04")],
        [("z", *dims, "home", 1, "2024-02-01 00:00:00")],
    )
    stream, stored = feed("in", schema, *parts)
    got = finish(jobs.page_view_window(at(stream)))
    want = summaries.page_view_window(at(stored)).filter("stt < '2024-02-01'")
    assert rows(got, *want.columns) == rows(want)


def test_visitor_repair_over_batches(spark, feed, tmp_path, rows):
    stream, _ = feed(
        "in", "mid string, is_new string, ts string", [("m", "1", "2024-01-06 10:00:00"), ("o", "0", "2024-01-06 10:00:00")],
        [("m", "1", "2024-01-07 10:00:00"), ("o", "1", "2024-01-07 10:00:00")],
    )
    write = repair_visitors_to(str(tmp_path / "days"), sinks.append_to(str(tmp_path / "out")))
    jobs.run(at(stream), str(tmp_path / "state"), write=write)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got.select("mid", F.dayofmonth("ts"), "is_new")) == [
        ("m", 6, "1"), ("m", 7, "0"), ("o", 6, "0"), ("o", 7, "0")
    ]


def test_revisions_over_batches(feed, finish, rows):
    stream, stored = feed(
        "in", "id string, v int, amount bigint, ts string", [("1", 1, 100, "2024-01-01 00:00:01"), ("2", 1, 7, "2024-01-01 00:00:01")],
        [("1", 2, 101, "2024-01-01 00:00:02")], [("1", 3, 102, "2024-01-01 00:00:03"), ("1", 4, 103, "2024-01-01 00:00:03")],
    )
    got = finish(stateful.revision_changes(jobs.timed(at(stream)), "id", ["v"], ["amount"]))
    want = versions.revision_changes(at(stored), ["id"], ["v"], ["amount"])
    assert rows(got, "id", "v", "amount", "sign") == rows(want, "id", "v", "amount", "sign")
    assert rows(got.groupBy("id").agg(F.sum("amount"))) == [("1", 103), ("2", 7)]


def falling(spark, n):
    """One key with n versions, the newest first."""
    return spark.range(n).select(
        F.lit("k").alias("id"), F.lit("1").alias("is_new"), (F.lit(n) - F.col("id")).alias("v"), (F.lit(n) - F.col("id")).alias("amount"),
        F.timestamp_seconds(F.lit(1704067200) + (F.lit(n) - F.col("id")) * 60).alias("ts"),
    )


def test_a_busy_key_in_falling_order(spark, finish, tmp_path, rows):
    """30,001 rows of one key in a single micro-batch, against the batch forms."""
    source = str(tmp_path / "in")
    falling(spark, 30_001).coalesce(1).write.parquet(source)
    stored = spark.read.parquet(source)
    stream = spark.readStream.schema(stored.schema).parquet(source)
    got = finish(stateful.revision_changes(jobs.timed(stream), "id", ["v"], ["amount"]))
    want = versions.revision_changes(stored, ["id"], ["v"], ["amount"])
    totals = [F.count("*"), F.sum("amount"), F.sum("sign"), F.sum(F.col("v") * F.col("sign"))]
    assert rows(got.agg(*totals)) == rows(want.agg(*totals)) == [(60_001, 30_001, 1, 30_001)]
    write = repair_visitors_to(str(tmp_path / "days"), sinks.append_to(str(tmp_path / "fixed")), "id")
    jobs.run(stream, str(tmp_path / "state"), write=write)
    fixed = spark.read.parquet(str(tmp_path / "fixed"))
    assert rows(fixed.groupBy("is_new").count()) == rows(repair_visitors(stored, "id").groupBy("is_new").count())


def test_stored_state_is_folded(spark, tmp_path, rows, monkeypatch):
    """Late batches read no more files than early ones, and see all that came before."""
    from millrace.streaming import stored

    monkeypatch.setattr(stored, "FOLD", 4)
    read = {}
    real = stored._stored

    def counted(session, path, schema, before, fold):
        df = real(session, path, schema, before, fold)
        read[before] = len(df.inputFiles())
        return df

    monkeypatch.setattr(stored, "_stored", counted)
    write = stored.repair_visitors_to(str(tmp_path / "days"), sinks.append_to(str(tmp_path / "out")))
    for n in range(19):
        if n not in (8, 13):
            day = f"2024-01-{n % 28 + 1:02d} 10:00:00"
            write(at(spark.createDataFrame([("m", "1", day), (f"d{n}", "1", day)], "mid string, is_new string, ts string")), n)
    assert read[18] <= read[6] + 4 and max(read.values()) <= 6 * stored.FOLD
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.filter("mid <> 'm' and is_new <> '1'").count() == 0
    assert {r[0] for r in out.filter("mid = 'm' and is_new = '1'").select(F.dayofmonth("ts")).collect()} == {1}


def test_late_rows_correct_a_reported_window(spark, feed, tmp_path, rows):
    stream, _ = feed(
        "in", "ts string", [("1970-01-01 00:00:01",)], [("1970-01-01 00:00:09",)], [("1970-01-01 00:00:02",)],
        [("1970-01-01 00:00:30",)], [("1970-01-01 00:00:31",)], [("1970-01-01 00:00:03",)],
    )
    out = str(tmp_path / "out")
    keys = ["stt", "edt"]
    jobs.run(
        jobs.refire_counts(at(stream)), str(tmp_path / "state"), write=sinks.upsert_to(out, keys, ["n"]), mode="update"
    )
    got = sinks.read_upserts(spark, out, keys)
    assert rows(got, "stt", "n")[0] == ("1970-01-01 00:00:00", 2)
    assert spark.read.parquet(out).filter("stt = '1970-01-01 00:00:00'").count() == 2


def test_order_facts_join_on_streams(spark, feed, finish, rows):
    details, _ = feed(
        "d", "id string, order_id string, sku_id string, sku_name string, create_time string, source_id string, "
        "source_type string, sku_num string, order_price string, split_total_amount string, "
        "split_activity_amount string, split_coupon_amount string, ts string",
        [("1", "o1", "s", "n", "2024-01-01 00:00:00", "x", "1", "2", "5.00", "10", "0", "0", "1704067200"),
         ("2", "o1", "s", "n", "2024-01-01 00:00:00", "x", "1", "1", "5.00", "5", "0", "0", "1704067200"),
         ("3", "o9", "s", "n", "2024-01-01 00:00:00", "x", "1", "1", "5.00", "5", "0", "0", "1704067200")],
        [("4", "o4", "s", "n", "2024-01-01 12:00:00", "x", "1", "1", "5.00", "5", "0", "0", "1704110400")],
        [("5", "o5", "s", "n", "2024-01-02 12:00:00", "x", "1", "1", "5.00", "5", "0", "0", "1704196800")],
    )
    later = [("0", "0", "1704110400")], [("0", "0", "1704196800")]
    orders, _ = feed(
        "o", "id string, user_id string, province_id string, ts string", [("o1", "u", "p", "1704067210")],
        [("x", "u", "p", "1704110400")], [("x", "u", "p", "1704196800")],
    )
    activity, _ = feed(
        "a", "order_detail_id string, activity_id string, activity_rule_id string, ts string",
        [("1", "act", "rule", "1704067201")], [("0", "0", "0", "1704110400")], [("0", "0", "0", "1704196800")],
    )
    coupon, _ = feed("c", "order_detail_id string, coupon_id string, ts string", [("2", "cou", "1704067202")], *later)
    names = spark.createDataFrame([("1", "web")], "dic_code string, dic_name string")
    streams = [with_change_time(df) for df in (details, orders, activity, coupon)]
    fact = facts.order_detail(*streams, names, within=facts.JOIN_STATE_SECONDS, salts=3)
    got = finish(fact)
    assert rows(got, "id", "user_id", "activity_id", "coupon_id", "split_original_amount") == [
        ("1", "u", "act", None, "10.0000"), ("2", "u", None, "cou", "5.0000")
    ]


def test_payment_joins_on_streams(spark, feed, finish, rows):
    columns = [c for c in facts.DETAIL_COLUMNS if c != "order_price"]
    extra = ["user_id", "province_id", "activity_id", "activity_rule_id", "coupon_id", "date_id", "source_type_name",
             "split_original_amount", "ts"]
    names = [*columns, *extra]
    def row(order, ts):
        return tuple({"order_id": order, "id": "d", "ts": ts}.get(n, "x") for n in names)

    details, _ = feed("d", ", ".join(f"{n} string" for n in names), [row("o1", "1704067200"), row("o2", "1704067200")])
    pays, _ = feed(
        "p", "user_id string, order_id string, payment_type string, callback_time string, ts string",
        [("u", "o1", "1", "t", "1704068000"), ("u", "o2", "1", "t", "1704070000"), ("u", "o1", "7", "t", "1704067300")],
    )
    names = spark.createDataFrame([("1", "card")], "dic_code string, dic_name string")
    fact = facts.payment(with_change_time(pays), with_change_time(details), names, within=facts.JOIN_STATE_SECONDS)
    got = finish(fact)
    assert rows(got, "order_id", "payment_type_name", "ts") == [("o1", "card", "1704068000")]


def test_logs_split_on_a_stream(feed, finish):
    record = '{"common":{"mid":"m"},"displays":[{"item":"1"},{"item":"2"}],"ts":1}'
    stream, _ = feed("in", "value string", [(record,)], [("{bad",), (record,)])
    shown = split_logs(parse_logs(stream))["display"]
    assert finish(shown).count() == 4


def test_keyword_counts_over_batches(feed, finish, rows):
    schema = "item string, item_type string, last_page_id string, ts string"
    stream, stored = feed(
        "in", schema, [("red shoe", "keyword", "home", "2024-01-01 00:00:01")],
        [("shoe", "keyword", "search", "2024-01-01 00:00:02")], [("x", "keyword", "home", "2024-02-01 00:00:00")],
    )
    got = finish(jobs.keyword_window(at(stream)))
    assert rows(got, "keyword", "keyword_count") == [("red", 1), ("shoe", 2)]


def test_stored_visitor_state_agrees(spark, feed, tmp_path, rows):
    stream, stored = feed(
        "in", "mid string, is_new string, ts string", [("m", "1", "2024-01-06 10:00:00"), ("o", "0", "2024-01-06 10:00:00")],
        [("m", "1", "2024-01-07 10:00:00"), ("o", "1", "2024-01-07 10:00:00"), (None, "1", "2024-01-07 10:00:00")],
    )
    out = str(tmp_path / "out")
    write = repair_visitors_to(str(tmp_path / "days"), sinks.append_to(out))
    jobs.run(at(stream), str(tmp_path / "state"), write=write)
    want = repair_visitors(at(stored))
    assert rows(spark.read.parquet(out), "mid", "ts", "is_new") == rows(want, "mid", "ts", "is_new")
    again = at(stored).filter("ts > '2024-01-07'")
    write(again, 1)
    assert rows(spark.read.parquet(out), "mid", "ts", "is_new") == rows(want, "mid", "ts", "is_new")


def test_stored_revision_state_agrees(spark, feed, tmp_path, rows):
    stream, stored = feed(
        "in", "id string, v int, amount bigint", [("1", 1, 100), ("2", 1, 7)], [("1", 2, 101)], [("1", 3, 102), ("1", 4, 103)],
    )
    out = str(tmp_path / "out")
    write = revision_changes_to(str(tmp_path / "last"), sinks.append_to(out), ["id"], ["v"], ["amount"])
    jobs.run(stream, str(tmp_path / "state"), write=write)
    want = versions.revision_changes(stored, ["id"], ["v"], ["amount"])
    got = spark.read.parquet(out)
    assert rows(got, "id", "v", "amount", "sign") == rows(want, "id", "v", "amount", "sign")


@pytest.mark.parametrize("salts", [2, 5])
def test_salted_joins_give_the_same_facts(spark, tables, rows, salts):
    from millrace.plans import adapters as a
    from millrace.plans import catalogue as c

    details = c.detail_fact(spark, tables).persist()
    cancelled = status_changes(a.order_changes(spark, tables), ["id", "user_id", "operate_time"], "1003")
    plain, salted = facts.order_cancel(cancelled, details), facts.order_cancel(cancelled, details, salts=salts)
    assert rows(plain) == rows(salted)
    paid = select_changes(
        a.payment_changes(spark, tables), "payment_info", ["user_id", "order_id", "payment_type", "callback_time"]
    )
    names = a.dictionary(spark, tables)
    assert rows(facts.payment(paid, details, names)) == rows(facts.payment(paid, details, names, salts=salts))


DETAIL = ("order_detail_id string, order_id string, province_id string, sku_id string, order_amount bigint, "
          "original_amount bigint, activity_amount bigint, coupon_amount bigint, v int, ts string")


def detail(line, order, amount, v, second):
    return (line, order, "p", "s", amount, amount, 0, 0, v, f"2024-01-01 00:00:{second:02d}")


def test_netted_sums_over_batches(spark, feed, finish, rows):
    stream, stored = feed(
        "in", DETAIL, [detail("1", "o1", 10, 1, 1), detail("2", "o1", 20, 1, 2)], [detail("1", "o1", 11, 2, 3)],
        [detail("3", "o2", 5, 1, 12)], [detail("9", "o9", 1, 1, 40)], [detail("9", "o8", 1, 1, 59)],
    )
    hops = [Hop("province_id", spark.createDataFrame([("p", "North")], "id string, name string"), {"name": "name"})]
    early = "stt < '2024-01-01 00:00:30'"
    got = finish(jobs.province_order_window(at(stream), ["v"], hops), "a").filter(early)
    want = summaries.province_order_window(at(stored), ["v"], hops).filter(early)
    assert rows(got, *want.columns) == rows(want)
    got = finish(jobs.sku_order_window(at(stream), ["v"]), "b").filter(early)
    want = summaries.sku_order_window(at(stored), ["v"]).filter(early)
    assert rows(got, *want.columns) == rows(want)


def test_a_version_after_its_window_leaves_the_old_sum(feed, finish, rows):
    stream, _ = feed(
        "in", DETAIL, [detail("1", "o1", 10, 1, 1)], [detail("9", "o9", 1, 1, 20)], [detail("9", "o9", 2, 2, 25)],
        [detail("1", "o1", 11, 2, 30)], [detail("8", "o8", 1, 1, 59)],
    )
    got = finish(jobs.province_order_window(at(stream), ["v"])).filter("stt in ('2024-01-01 00:00:00', '2024-01-01 00:00:30')")
    assert rows(got, "order_amount") == [(10,), (11,)]


def test_all_lines_of_cancelled_orders_join(spark, tables, rows):
    """Lines lie years before or after their order; the batch fact joins them all."""
    import __spark_entry__ as entry

    want = entry.queries()["order_cancel_fact"](spark, tables)
    got = entry.queries()["stream_cancel_fact"](spark, tables)
    assert rows(got, *want.columns) == rows(want)
    assert want.count() > 0


def test_keys_of_a_bucket_share_calls_and_state(feed, tmp_path, spark, rows, monkeypatch):
    """More micro-batches than a bucket holds pieces, and far more keys than buckets."""
    monkeypatch.setattr(stateful, "BUCKETS", 4)
    parts = [[(f"u{i}" if i else None, f"2024-01-{day:02d} 00:00:0{i % 5}") for i in range(60) if i % day % 3 == 0] for day in range(1, 12)]
    stream, stored = feed("in", "uid string, ts string", *parts, END)
    pages = [at(df).select("*", F.col("uid").alias("user_id")) for df in (stream, stored)]
    query = jobs.start(jobs.order_window(pages[0]), str(tmp_path / "state"), path=str(tmp_path / "out"))
    query.awaitTermination()
    want = summaries.order_window(pages[1]).filter("stt < '2024-02-01'")
    assert rows(spark.read.parquet(str(tmp_path / "out")).drop(sinks.BATCH), *want.columns) == rows(want)
    held = [o.numRowsTotal for p in query.recentProgress for o in p.stateOperators if "transformWithState" in o.operatorName]
    # Without buckets a row of state stands for each of the 60 users.
    assert 0 < max(held) <= 4 * (stateful.PIECES + 1)


def test_revisions_of_a_bucket_over_many_batches(feed, finish, rows, monkeypatch):
    monkeypatch.setattr(stateful, "BUCKETS", 2)
    parts = [[(str(i) if i else None, v, 10 * i + v, f"2024-01-01 00:00:{v:02d}") for i in range(20) if i % v % 4 == 0] for v in range(1, 12)]
    stream, stored = feed("in", "id string, v int, amount bigint, ts string", *parts)
    got = finish(stateful.revision_changes(jobs.timed(at(stream)), "id", ["v"], ["amount"]))
    want = versions.revision_changes(at(stored).filter("id is not null"), ["id"], ["v"], ["amount"])
    assert rows(got.filter("id is not null"), "id", "v", "amount", "sign") == rows(want, "id", "v", "amount", "sign")
    assert got.filter("id is null").agg(F.sum("amount")).first()[0] == 11


def test_rows_without_a_numeric_key_are_one_user(feed, finish, rows):
    schema = "user_id bigint, ts string"
    stream, stored = feed("in", schema, [(None, "2024-01-01 00:00:01"), (0, "2024-01-01 00:00:01"), (None, "2024-01-01 00:00:02")], [(None, "2024-01-02 00:00:01"), (2**62 + 1, "2024-01-02 00:00:01")], [(9, "2024-02-01 00:00:00")])
    got = finish(jobs.order_window(at(stream)))
    want = summaries.order_window(at(stored)).filter("stt < '2024-02-01'")
    assert rows(got, *want.columns) == rows(want)


def test_a_replay_makes_its_rows_once(spark, tmp_path):
    import glob

    from millrace.plans.streams import replay
    from millrace.session import checkpoint_root

    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    table = spark.range(1000).select(F.col("id"), F.timestamp_seconds("id").alias("ts"))
    source = table.mapInArrow(counted, table.schema)
    before = set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/millrace/repl*"))
    stream = replay(spark, source, 3, {"id": -1})
    assert made.value == 1000
    # What was written on the way is gone; the replay itself is there.
    left = set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/millrace/repl*")) - before
    assert len(left) == 1
    jobs.run(stream, str(tmp_path / "state"), path=str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 1001 and got.agg(F.sum("id")).first()[0] == 499500 - 1
    assert got.select(sinks.BATCH).distinct().count() == 5
