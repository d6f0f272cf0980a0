"""State kept in tables: held rows, versions in force, corrected windows and joins. Batches are given by hand."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import facts, summaries, windows
from millrace.operators.asof import as_of_join
from millrace.operators.dims import route_as_of, ruled, rule_versions
from millrace.streaming import sinks
from millrace.streaming.arrivals import split_late_to, watermark_trace_to
from millrace.streaming.holding import closed_windows_to, hold_to
from millrace.streaming.in_force import in_force_to
from millrace.streaming.loads import dim_levels, dims_to_levels, read_dim_levels, read_dim_row
from millrace.streaming.netting import NettedWindows, netted_windows_to
from millrace.streaming.updating import changes, net_rows, newest_rows, updating_to


def at(df, *columns):
    for c in columns or ("ts",):
        df = df.withColumn(c, F.to_timestamp(c))
    return df


def clock(second):
    return f"2024-01-01 00:{second // 60:02d}:{second % 60:02d}"


@pytest.fixture
def stored(spark, tmp_path):
    """A writer that keeps what it is given, and a reader of it."""
    path = str(tmp_path / "out")
    return sinks.append_to(path), lambda: spark.read.parquet(path).drop(sinks.BATCH)


# --- as-of joins -------------------------------------------------------------------------


def test_as_of_join_against_a_loop(spark, rows):
    r = random.Random(1)
    versions = [(r.choice("abc"), r.randrange(50), n, f"v{n}") for n in range(60)] + [(None, 1, 99, "null key")]
    asked = [(i, r.choice("abcd"), r.randrange(-5, 60)) for i in range(200)] + [(900, "a", None), (901, None, 5)]
    left = spark.createDataFrame(asked, "id int, k string, at int").repartition(3)
    right = spark.createDataFrame(versions, "k string, since int, seq int, name string").repartition(3)
    got = as_of_join(left, right, ["k"], "at", "since", ["name"], ["seq"])

    def name(k, t):
        known = [(s, q, n) for kk, s, q, n in versions if kk == k and t is not None and s <= t]
        return max(known)[2] if known else None

    assert rows(got, "id", "k", "at", "name") == sorted([(i, k, t, name(k, t)) for i, k, t in asked], key=repr)
    inner = as_of_join(left, right, ["k"], "at", "since", ["name"], ["seq"], "inner")
    assert inner.count() == sum(name(k, t) is not None for _, k, t in asked)


def test_a_code_renamed_between_two_rows_gives_both_names(spark, rows):
    names = spark.createDataFrame([("1", "old", 0), ("1", "new", 10), ("2", "two", 5)], "dic_code string, dic_name string, since int")
    asked = spark.createDataFrame([(1, "1", 9), (2, "1", 10), (3, "2", 4), (4, "2", 5), (5, "9", 50)], "id int, code string, t int")
    assert rows(facts.decode_as_of(asked, names, "code", "name", "t"), "id", "name") == [(1, "old"), (2, "new"), (4, "two")]


CAPTURES = "op string, at string, seq int, source_table string, source_type string, sink_table string, sink_type string, sink_columns string, sink_pk string, sink_extend string"
RECORDS = "table string, type string, id string, ts string, et string"


def captures(spark, *items):
    return at(spark.createDataFrame([(op, clock(s), q, "t", kind, sink, "dwd", "id", None, None) for op, s, q, kind, sink in items], CAPTURES), "at")


def records(spark, *items):
    made = spark.createDataFrame([("t", kind, i, str(s), clock(s)) for i, kind, s in items], RECORDS)
    return at(made, "et").withColumn("data", F.create_map(F.lit("id"), "id", F.lit("x"), F.lit("y"))).drop("id")


def test_records_meet_the_rule_of_their_time(spark, rows):
    history = captures(spark, ("c", 10, 1, "insert", "first"), ("u", 20, 2, "insert", "second"), ("d", 30, 3, "insert", "second"))
    routed = route_as_of(records(spark, *[(str(s), "insert", s) for s in (5, 10, 19, 20, 29, 30)], ("u", "update", 15)), history, "et", "at", ["seq"], F.col("type"))
    assert rows(routed.select("sink_table", F.col("data")["id"])) == [("first", "10"), ("first", "19"), ("second", "20"), ("second", "29")]
    assert routed.first().data.keys() == {"id", "op_type"}


def test_rules_and_records_in_one_batch_out_of_order(spark, rows, tmp_path, stored):
    write, read = stored

    def parts(batch):
        rule = F.col("sink_table").isNotNull()
        return (batch.filter(rule).select("table", "kind", "at", "seq", "op", "sink_table", "sink_type", "sink_pk", "sink_columns"),
                batch.filter(~rule).select("table", "kind", "type", "data", "ts", "et"))

    def routed(joined, number):
        write(ruled(joined), number)

    job = in_force_to(str(tmp_path / "kept"), parts, ["table", "kind"], "at", ("op", "sink_table", "sink_type", "sink_pk", "sink_columns"), routed, "et", ["seq"])

    def feed(number, rules, items):
        versions = rule_versions(captures(spark, *rules), "at", ["seq"])
        rows_ = records(spark, *items).withColumn("kind", F.col("type"))
        job(versions.unionByName(rows_, allowMissingColumns=True), number)

    feed(0, [("u", 12, 2, "insert", "b"), ("c", 2, 1, "insert", "a")], [("1", "insert", 13), ("2", "insert", 11), ("3", "insert", 1)])
    # 13 is not ripe yet, 11 neither: a rule of second 11 may still come, and does.
    assert rows(read().select("sink_table", F.col("data")["id"])) == []
    feed(1, [("u", 11, 5, "insert", "c")], [("4", "insert", 15)])
    assert rows(read().select("sink_table", F.col("data")["id"])) == [("c", "2")]
    feed(2, [("d", 40, 6, "insert", "c")], [("5", "insert", 41), ("6", "insert", 39), ("7", "insert", 100)])
    feed(2, [("d", 40, 6, "insert", "c")], [("5", "insert", 41), ("6", "insert", 39), ("7", "insert", 100)])
    assert rows(read().select("sink_table", F.col("data")["id"])) == [("b", "1"), ("b", "4"), ("b", "6"), ("c", "2")]


# --- held rows ---------------------------------------------------------------------------


def test_an_idle_source_holds_windows_until_its_timeout(spark, tmp_path, rows, stored):
    (write, read), now = stored, [1000.0]

    def counts(closed):
        return windows.stamp(closed.groupBy(windows.tumble("ts"), "source").agg(F.count("*").alias("n")))

    job = closed_windows_to(str(tmp_path / "kept"), counts, write, delay="0 seconds", source=["source"], idle="10 seconds", now=lambda: now[0])

    def feed(number, *items):
        job(at(spark.createDataFrame([(s, clock(t)) for s, t in items] or [], "source string, ts string")), number)

    feed(0, ("a", 1), ("b", 2), ("a", 7))
    assert rows(read()) == []
    now[0] += 9
    feed(1, ("a", 12))
    assert rows(read(), "edt", "source", "n") == [], "b is silent, but not for long enough"
    now[0] += 2
    feed(2, ("a", 13))
    assert rows(read(), "edt", "source", "n") == [(clock(5), "a", 1), (clock(5), "b", 1), (clock(10), "a", 1)]
    feed(3, ("b", 8), ("b", 14))
    assert rows(read(), "edt", "source", "n")[2:] == [(clock(10), "a", 1), (clock(10), "b", 1)], "b is late now, and counted on its own"
    feed(4, ("b", 20), ("a", 22))
    assert rows(read().filter(F.col("edt") > clock(10)), "edt", "source", "n") == [(clock(15), "a", 2), (clock(15), "b", 1)] + [(clock(20), None, None)][:0]


def test_late_rows_go_to_their_own_output(spark, tmp_path, rows, stored):
    write, read = stored
    late = sinks.append_to(str(tmp_path / "late"))
    job = hold_to(str(tmp_path / "kept"), write, ripe=windows.window_end, late=late)
    for number, seconds in enumerate([(1, 2), (9,), (3, 12), (4, None, 30)]):
        job(at(spark.createDataFrame([(s, clock(s) if s is not None else None) for s in seconds], "n int, ts string")), number)
    assert rows(read(), "n") == [(1,), (12,), (2,), (9,)]
    assert rows(spark.read.parquet(str(tmp_path / "late")), "n") == [(3,), (4,)]


def test_window_lists_over_batches(spark, tmp_path, rows, stored):
    write, read = stored
    everything = [(i, (i * 7) % 40) for i in range(40)]

    def lists(closed):
        return windows.window_rows(closed, ["i"], ["ts", "i"], chunk=2)

    job = closed_windows_to(str(tmp_path / "kept"), lists, write, delay="60 seconds")
    parts = [everything[:10], everything[10:25], everything[25:], [(99, 1000)]]
    for number, part in enumerate(parts):
        job(at(spark.createDataFrame([(i, clock(s)) for i, s in part], "i int, ts string")), number)
    whole = at(spark.createDataFrame([(i, clock(s)) for i, s in everything], "i int, ts string"))
    want = windows.window_rows(whole, ["i"], ["ts", "i"], chunk=2)
    assert rows(read()) == rows(want) and want.count() > 20


# --- arrival order ------------------------------------------------------------------------


@pytest.mark.parametrize("cuts", [1, 3])
def test_lateness_does_not_depend_on_where_batches_are_cut(spark, tmp_path, rows, cuts):
    r = random.Random(3)
    items = [(n, r.choice("ab"), n, n * 900 + r.randrange(-9000, 9000)) for n in range(60)]
    df = lambda part: spark.createDataFrame(part, "id int, source string, place int, ms bigint")
    late = split_late_to(str(tmp_path / "k1"), str(tmp_path / "rows"), ["source"], ["place"], "ms")
    trace = watermark_trace_to(str(tmp_path / "k2"), sinks.append_to(str(tmp_path / "trace")), ["source"], ["place"], "ms", 3000)
    for number in range(cuts):
        part = df(items[number * 60 // cuts : (number + 1) * 60 // cuts])
        for job in (late, trace):
            job(part, number)
    marked = windows.mark_late(df(items), ["source"], ["place"], "ms")
    got = spark.read.parquet(str(tmp_path / "rows"))
    assert rows(got.select("id", "window_end", "refire", F.col("late").cast("boolean"))) == rows(marked, "id", "window_end", "refire", "late")
    assert 0 < marked.filter("late").count() < 60
    assert rows(spark.read.parquet(str(tmp_path / "trace")), "id", "watermark") == rows(
        windows.watermark_trace(df(items), ["source"], ["place"], "ms", 3000), "id", "watermark")


# --- corrected windows ---------------------------------------------------------------------


LINES = "id string, ts string, v int, sku string, o string, amount bigint"


def line_versions(seed, n=80):
    """Versions of some lines: later ones may change the time, the item and the amount."""
    r = random.Random(seed)
    return [(f"l{r.randrange(20)}", clock(r.randrange(60)), v, r.choice("xy"), f"o{r.randrange(8)}", r.choice([None, *range(9)])) for v in range(n)]


@pytest.mark.parametrize("cuts", [1, 5])
def test_windows_end_as_in_batch_however_the_stream_is_cut(spark, tmp_path, rows, cuts):
    items = line_versions(7)
    random.Random(8).shuffle(items)
    whole = at(spark.createDataFrame(items, LINES)).withColumnRenamed("sku", "province_id").withColumnRenamed("amount", "order_amount")
    whole = whole.withColumnsRenamed({"o": "order_id", "id": "order_detail_id"})
    kept = NettedWindows(str(tmp_path / "kept"), whole.schema, ["order_detail_id"], ["v"], ["province_id"], ["order_amount"], member="order_id", count="order_count", fan=2)
    job = netted_windows_to(kept)
    for number in range(cuts):
        job(whole.filter(F.pmod(F.xxhash64("v"), F.lit(cuts)) == number), number)
    want = summaries.province_order_window(whole, ["v"])
    assert rows(kept.read(spark), *want.columns) == rows(want.na.fill(0, ["order_amount"]))


def test_a_reported_window_is_corrected(spark, tmp_path, rows):
    schema = at(spark.createDataFrame([], LINES)).schema
    kept = NettedWindows(str(tmp_path / "kept"), schema, ["id"], ["v"], ["sku"], ["amount"])
    reports = []
    job = netted_windows_to(kept, lambda df, number: reports.append(rows(df, "stt", "sku", "amount")))

    def feed(number, *items):
        job(at(spark.createDataFrame(items, LINES)), number)

    feed(0, ("l1", clock(1), 1, "x", "o", 100), ("l2", clock(2), 1, "x", "o", 7))
    feed(1, ("l1", clock(3001), 2, "x", "o", 60))
    feed(2, ("l1", clock(7), 1, "y", "o", 5), ("l2", clock(2), 1, "x", "o", 7))
    feed(2, ("l1", clock(7), 1, "y", "o", 5), ("l2", clock(2), 1, "x", "o", 7))
    early, later = clock(0), clock(3000)
    assert reports[0] == [(early, "x", 107)]
    assert reports[1] == [(early, "x", 7), (later, "x", 60)]
    assert reports[2] == reports[3] == [(early, "x", 7), (clock(5), "y", 0)], "an older version that comes late counts nothing"
    assert rows(kept.read(spark), "stt", "sku", "amount") == [(early, "x", 7), (clock(5), "y", 0), (later, "x", 60)]


# --- corrected joins -----------------------------------------------------------------------


def fact_parts(batch):
    kind = lambda name: F.col("kind") == name
    return {
        "left": batch.filter(kind("l")).select("o", F.col("a").alias("id"), F.col("b").alias("left_v")),
        "right": batch.filter(kind("r")).select("o", F.col("a").alias("line"), F.col("b").alias("right_v")),
    }


def fact(tables):
    right = tables["right"].select(F.col("line").alias("id"), "right_v")
    return tables["left"].join(right, "id", "left").select("id", "o", "left_v", "right_v")


def test_a_row_without_partner_is_corrected_when_it_comes(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    job = updating_to(str(tmp_path / "kept"), fact_parts, ["o"], {"left": ["id"], "right": ["line"]}, fact, ["id"], sinks.append_to(path), fan=2)

    def feed(number, *items):
        job(spark.createDataFrame(items, "kind string, o string, a string, b string"), number)

    def told(number):
        return rows(spark.read.parquet(f"{path}/{sinks.BATCH}={number}"), "op", "id", "left_v", "right_v")

    feed(0, ("l", "1", "x", "lx"), ("l", "1", "y", "ly"), ("r", "2", "z", "rz"))
    assert told(0) == [("+I", "x", "lx", None), ("+I", "y", "ly", None)]
    feed(1, ("r", "1", "x", "rx"))
    assert told(1) == [("+U", "x", "lx", "rx"), ("-U", "x", "lx", None)]
    feed(2, ("l", "2", "z", "lz"), ("l", "1", "y", "ly2"), ("r", "9", "none", "r"))
    assert told(2) == [("+I", "z", "lz", "rz"), ("+U", "y", "ly2", None), ("-U", "y", "ly", None)]
    feed(2, ("l", "2", "z", "lz"), ("l", "1", "y", "ly2"), ("r", "9", "none", "r"))
    assert told(2) == [("+I", "z", "lz", "rz"), ("+U", "y", "ly2", None), ("-U", "y", "ly", None)]
    newest = rows(newest_rows(spark.read.parquet(path), ["id"]), "id", "left_v", "right_v")
    assert newest == [("x", "lx", "rx"), ("y", "ly2", None), ("z", "lz", "rz")]
    assert rows(net_rows(spark.read.parquet(path)), "id", "left_v", "right_v") == newest


@pytest.mark.parametrize("cuts", [2, 6])
def test_corrected_join_ends_as_in_batch(spark, tmp_path, rows, cuts):
    """A third of the rows is of one order; no salts, no time bound."""
    r = random.Random(cuts)
    items = [(r.choice("lr"), "hot" if r.random() < 0.4 else f"o{r.randrange(9)}", f"id{i // 2}", f"v{i}") for i in range(120)]
    items = list({(k, a): (k, o, a, b) for k, o, a, b in items}.values())
    orders = {a: o for _, o, a, _ in items}
    whole = spark.createDataFrame([(k, orders[a], a, b) for k, _, a, b in items], "kind string, o string, a string, b string")
    path = str(tmp_path / "out")
    job = updating_to(str(tmp_path / "kept"), fact_parts, ["o"], {"left": ["id"], "right": ["line"]}, fact, ["id"], sinks.append_to(path), fan=3)
    for number in range(cuts):
        job(whole.filter(F.pmod(F.xxhash64("b"), F.lit(cuts)) == number), number)
    want = fact(fact_parts(whole))
    assert rows(newest_rows(spark.read.parquet(path), ["id"]), *want.columns) == rows(want)


def test_changes_keep_repeated_rows(spark, rows):
    before = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("d", 4)], "k string, v int")
    after = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("c", None), ("d", 4)], "k string, v int")
    assert rows(changes(before, after, ["k"])) == [("+I", "c", None), ("+I", "c", None), ("+U", "b", 3), ("-D", "a", 1), ("-U", "b", 2)]


# --- dimension tables ------------------------------------------------------------------------


def test_dimension_tables_in_one_levelled_table(spark, tmp_path, rows):
    table = dim_levels(str(tmp_path / "dims"), fan=2)
    write = dims_to_levels(table)

    def feed(number, *items):
        df = spark.createDataFrame(items, "sink_table string, sink_pk string, id string, name string, ts string")
        write(df.select("sink_table", "sink_pk", F.create_map(F.lit("id"), "id", F.lit("name"), "name").alias("data"), "ts"), number)

    feed(0, ("city", None, "1", "Rome", "1"), ("shop", "name", "7", "key", "1"))
    feed(1, ("city", None, "1", "Roma", "2"), ("city", None, "2", "Bonn", "1"))
    feed(2, ("city", None, "1", "old", "0"))
    assert rows(read_dim_levels(spark, table, "city", ["id", "name"])) == [("1", "Roma"), ("2", "Bonn")]
    assert read_dim_row(spark, table, "city", "1").data["name"] == "Roma" and read_dim_row(spark, table, "shop", "key").data["id"] == "7"
    assert len(table.files_of(spark, ("city", "2"))) == 1
    assert read_dim_row(spark, table, "city", "9", "null") is None
    with pytest.raises(LookupError):
        read_dim_row(spark, table, "city", "9")
