import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace import session
from millrace.functions import columns, text
from millrace.schemas import SENSOR
from millrace.sources import changelog, tables
from millrace.sources import text as source


def test_sensor_lines_and_rejects(spark, rows):
    lines = ["s1,1000,10", "s2,x,10", "s3", "s4,5,6,extra", "", "s5,99999999999999999999,1"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good, bad = source.sensor_lines(df)
    assert rows(good) == [("s1", 1000, 10), ("s4", 5, 6)] and good.schema == SENSOR
    assert rows(bad) == [("",), ("s2,x,10",), ("s3",), ("s5,99999999999999999999,1",)]


def test_text_files_and_formats(spark, rows, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text('{"id":"a","ts":1,"vc":2}\n')
    lines = source.text_files(spark, str(path))
    assert rows(source.typed(lines, SENSOR, "json")) == [("a", 1, 2)]
    csv = spark.createDataFrame([("a,1,2",)], "value string")
    assert rows(source.typed(csv, SENSOR, "csv")) == [("a", 1, 2)]
    with pytest.raises(ValueError):
        source.typed(lines, SENSOR, "xml")
    assert source.text_files(spark, str(tmp_path), stream=True).isStreaming


def test_event_time_has_a_watermark(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    df = source.text_files(spark, str(tmp_path), stream=True).select(F.lit(1).cast("bigint").alias("ts"))
    plan = source.with_event_time(df)._jdf.queryExecution().analyzed().toString()
    assert "EventTimeWatermark" in plan and "3 seconds" in plan


def test_topic_options():
    assert source.topic_options("t", "h:1") == {
        "subscribe": "t", "kafka.bootstrap.servers": "h:1", "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
    }


def test_jdbc_options():
    assert tables.jdbc_options("u", "t") == {"url": "u", "dbtable": "t"}
    split = tables.jdbc_options("u", "t", split_on="id", bounds=(0, 9), parts=3)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "9", "3")
    with pytest.raises(ValueError):
        tables.jdbc_options("u", "t", split_on="id")


def test_keyed_topic_null_deletes(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, o int, value string")
    assert rows(changelog.keyed_topic(df, ["k"], ["o"])) == [("b", 1, "y")]


def test_times(spark):
    df = spark.createDataFrame([(1704067205123, "1704067205", "2024-01-01", "2024-01-01 00:00:05")], "ms bigint, s string, d string, t string")
    row = df.select(
        columns.millis_to_date("ms"), columns.millis_to_datetime("ms"), columns.date_to_millis("d"),
        F.unix_millis(columns.seconds_to_time("s")), columns.date_id("t"),
        F.unix_millis(columns.flexible_time("ms")), F.unix_millis(columns.flexible_time("t")),
    ).first()
    assert tuple(row) == (
        "2024-01-01", "2024-01-01 00:00:05", 1704067200000, 1704067205000, "2024-01-01", 1704067205123, 1704067205000
    )


@given(st.lists(st.sampled_from(["user", "id", "x", "name2"]), min_size=1, max_size=4).map("_".join))
@settings(max_examples=50, deadline=None)
def test_names_survive_both_styles(name):
    assert columns.to_snake(columns.to_camel(name)) == name


def test_word_count_splits_on_commas(spark, rows):
    df = spark.createDataFrame([("a,b,a",), ("b",)], "value string")
    assert rows(text.word_count(df)) == [("a", 2), ("b", 2)]


def test_checkpoint_folder_is_named_or_local(spark):
    root = session.checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir", root)
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
