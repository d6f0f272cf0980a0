import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import dims
from millrace.streaming import jobs, loads, sinks


def versions(spark, *items):
    return spark.createDataFrame(list(items), "id string, v int, name string")


def test_upserts_keep_the_newest(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.upsert_to(path, ["id"], ["v"])
    write(versions(spark, ("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z")), 0)
    write(versions(spark, ("a", 3, "w"), ("b", 4, "old")), 1)
    assert rows(sinks.read_upserts(spark, path, ["id"], ["v"])) == [("a", 3, "w"), ("b", 5, "z")]
    assert rows(sinks.read_upserts(spark, path, ["id"])) == [("a", 3, "w"), ("b", 4, "old")]


def test_a_repeated_batch_replaces_itself(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.append_to(path)
    for _ in range(2):
        write(versions(spark, ("a", 1, "x")), 7)
    assert spark.read.parquet(path).count() == 1


def test_compaction_keeps_the_current_rows(spark, rows, tmp_path):
    path, target = str(tmp_path / "t"), str(tmp_path / "c")
    write = sinks.upsert_to(path, ["id"], ["v"])
    write(versions(spark, ("a", 1, "x")), 0)
    write(versions(spark, ("a", 2, "y")), 1)
    sinks.compact_upserts(spark, path, target, ["id"], ["v"])
    assert spark.read.parquet(target).count() == 1
    # A new run starts again at batch 0 and leaves the compacted rows.
    sinks.upsert_to(target, ["id"], ["v"])(versions(spark, ("b", 1, "n")), 0)
    assert rows(sinks.read_upserts(spark, target, ["id"], ["v"])) == [("a", 2, "y"), ("b", 1, "n")]
    again = str(tmp_path / "d")
    sinks.compact_upserts(spark, target, again, ["id"], ["v"])
    schema = versions(spark, ("a", 1, "x")).schema
    assert rows(sinks.read_upserts(spark, again, ["id"], ["v"], schema=schema)) == [("a", 2, "y"), ("b", 1, "n")]


def test_summary_columns(spark):
    df = spark.createDataFrame([(1, "x", 2)], "keywordCount int, helperSet string, ts int")
    assert sinks.summary_columns(df, ["helperSet"]).columns == ["keyword_count", "ts"]


def test_routed_rows_land_by_destination(spark, rows, tmp_path):
    df = spark.createDataFrame([("one", {"id": "1"}), ("two", {"id": "2"})], "sink_table string, data map<string,string>")
    path = str(tmp_path / "r")
    sinks.route_to(path)(df, 3)
    assert rows(spark.read.text(f"{path}/batch_id=3"), "sink_table", "value") == [("one", '{"id":"1"}'), ("two", '{"id":"2"}')]


def test_text_stream_writes_json_once(spark, tmp_path):
    source = str(tmp_path / "in")
    versions(spark, ("a", 1, "x")).write.parquet(source)
    stream = spark.readStream.schema("id string, v int, name string").parquet(source)
    for _ in range(2):
        sinks.text_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert lines == [{"id": "a", "v": 1, "name": "x"}]


def rule(spark, *items):
    names = "op string, sink_table string, sink_type string, sink_columns string, sink_pk string, source_table string"
    return spark.createDataFrame(list(items), names)


@pytest.fixture
def dim_table(spark):
    made = rule(spark, ("r", "dim_shop", "dim", "id,name", "id", "shop"), ("c", "fact_x", "dwd", "id", None, "x"))
    assert sinks.apply_rules(spark, made.collect()) == ["dim_shop"]
    yield "dim_shop"
    spark.sql("drop table if exists dim_shop")


def routed(spark, *items):
    df = spark.createDataFrame(list(items), "id string, name string, ts string")
    return df.select(F.lit("dim_shop").alias("sink_table"), F.create_map(F.lit("id"), "id", F.lit("name"), "name").alias("data"), "ts")


def test_dimension_tables_follow_their_records(spark, rows, dim_table):
    rules = rule(spark, ("r", "dim_shop", "dim", "id,name", "id", "shop"))
    write = sinks.dims_to(rules)
    write(routed(spark, ("1", "a", "1"), ("1", "b", "2"), ("2", "c", "1")), 0)
    write(routed(spark, ("1", "d", "9")), 1)
    write(routed(spark, ("1", "e", "9")), 1)
    assert rows(sinks.read_dim(spark, dim_table)) == [("1", "e"), ("2", "c")]
    assert spark.table(dim_table).count() == 3


def test_rules_recreate_and_drop_tables(spark, dim_table):
    sinks.apply_rules(spark, rule(spark, ("u", "dim_shop", "dim", "id,name,city", "id", "shop")).collect())
    assert spark.table(dim_table).columns == ["id", "name", "city", "batch_id"]
    sinks.apply_rules(spark, rule(spark, ("d", "dim_shop", "dim", "id", "id", "shop")).collect())
    assert not spark.catalog.tableExists(dim_table)
    with pytest.raises(ValueError):
        sinks.apply_rules(spark, rule(spark, ("c", "a; drop", "dim", "id", "id", "x")).collect())


def test_a_repeated_rule_batch_keeps_loaded_rows(spark, rows, tmp_path, dim_table):
    store = loads.store_rules_to(str(tmp_path / "rules"), ["source_table"])
    change = rule(spark, ("u", "dim_shop", "dim", "id,name", "id", "shop")).withColumn("sink_extend", F.lit(None).cast("string"))
    store(change, 5)
    write = sinks.dims_to(rule(spark, ("u", "dim_shop", "dim", "id,name", "id", "shop")))
    write(routed(spark, ("1", "a", "1")), 0)
    store(change, 5)
    assert rows(sinks.read_dim(spark, dim_table)) == [("1", "a")]
    store(change, 6)
    assert rows(sinks.read_dim(spark, dim_table)) == []


def test_whole_dimension_load(spark, rows, tables, dim_table):
    """Records through cleaning, routing and the table sink."""
    from millrace.operators.changes import clean_changes
    from millrace.plans import adapters as a

    rules = a.rules(spark).filter("sink_table = 'dim_user_info'")
    spark.sql("drop table if exists dim_user_info")
    sinks.apply_rules(spark, rules.withColumn("op", F.lit("c")).collect())
    records = clean_changes(a.dim_changes(spark, tables), a.DATABASE)
    sinks.dims_to(rules)(dims.route_dims(records, rules), 0)
    assert sinks.read_dim(spark, "dim_user_info").count() == 150
    spark.sql("drop table dim_user_info")


def test_start_runs_on_with_a_trigger(spark, tmp_path):
    source = str(tmp_path / "in")
    versions(spark, ("a", 1, "x")).write.parquet(source)
    stream = spark.readStream.schema("id string, v int, name string").parquet(source)
    running = jobs.start(stream, str(tmp_path / "s"), path=str(tmp_path / "o"), every="1 second")
    try:
        running.processAllAvailable()
        assert running.isActive and spark.read.parquet(str(tmp_path / "o")).count() == 1
    finally:
        running.stop()


def test_log_split_load(spark, rows, tmp_path):
    lines = [
        '{"common":{"mid":"m"},"page":{"page_id":"home"},"displays":[{"item":"1"},{"item":"2"}],"ts":1}',
        '{"common":{"mid":"m"},"start":{"entry":"icon"},"ts":2}', "{bad",
    ]
    write = loads.split_logs_to(str(tmp_path / "logs"))
    write(spark.createDataFrame([(x,) for x in lines], "value string"), 4)
    got = spark.read.text(str(tmp_path / "logs"))
    assert rows(got.groupBy("output").count()) == [("display", 2), ("page", 1), ("reject", 1), ("start", 1)]


def test_rules_then_records_then_a_rule_change(spark, rows, tmp_path):
    """The dimension load end to end, with the rules changing between batches."""
    rule_path = str(tmp_path / "rules")
    names = ("op string, seq int, source_table string, source_type string, sink_table string, sink_type string, "
             "sink_columns string, sink_pk string, sink_extend string")

    def change(number, *items):
        loads.store_rules_to(rule_path, ["seq"])(spark.createDataFrame(list(items), names), number)

    def records(*items):
        text = '{"database":"shop","table":"%s","type":"%s","ts":"%d","data":{"id":"%s","name":"%s","x":"y"}}'
        return spark.createDataFrame([(text % i,) for i in items], "value string")

    spark.sql("drop table if exists dim_city")
    change(0, ("r", 1, "city", "ALL", "dim_city", "dim", "id,name", "id", None),
           ("r", 2, "visit", "insert", "dwd_visit", "dwd", "id", None, None))
    rules = loads.stored_rules(rule_path, ["seq"])
    load = loads.load_dims(rules, "shop")
    route = loads.route_facts_to(str(tmp_path / "facts"), rules, "shop")
    batch = records(("city", "bootstrap-insert", 1, "1", "Rome"), ("city", "update", 2, "1", "Roma"), ("visit", "insert", 3, "7", "v"))
    load(batch, 0)
    route(batch, 0)
    assert rows(sinks.read_dim(spark, "dim_city")) == [("1", "Roma")]
    assert rows(spark.read.text(str(tmp_path / "facts")), "sink_table", "value") == [("dwd_visit", '{"id":"7","op_type":"insert"}')]
    change(1, ("d", 3, "city", "ALL", "dim_city", "dim", "id,name", "id", None))
    assert not spark.catalog.tableExists("dim_city")
    load(records(("city", "insert", 4, "2", "Bonn")), 1)
    assert rows(rules(spark), "sink_table") == [("dwd_visit",)]


def test_point_read(spark):
    dim = spark.createDataFrame([("1", "a")], "id string, name string")
    assert dims.read_row(dim, "1").name == "a"
    with pytest.raises(LookupError):
        dims.read_row(dim, "2")


def test_parameterised_query(spark):
    from millrace.sources.tables import query

    spark.createDataFrame([("1", "a"), ("2", "b")], "user_id string, full_name string").createOrReplaceTempView("people")
    df = query(spark, "select * from people where user_id = ?", ["2"], style="camel")
    assert [tuple(r) for r in df.collect()] == [("2", "b")] and df.columns == ["userId", "fullName"]


def test_a_stored_fact_is_compressed(spark, tables, tmp_path, monkeypatch, rows):
    import glob

    from millrace.plans import catalogue

    folders = []
    monkeypatch.setattr(catalogue, "scratch_path", lambda spark, label: folders.append(str(tmp_path / label)) or folders[-1])
    before = sorted(spark.conf.getAll.items())
    stored = catalogue.stored_detail(spark, tables)
    assert sorted(spark.conf.getAll.items()) == before
    files = glob.glob(f"{folders[0]}/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    fact = catalogue.detail_fact(spark, tables)
    assert rows(stored, *fact.columns) == rows(fact)
