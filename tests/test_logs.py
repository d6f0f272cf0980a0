import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.columns import overlay
from millrace.operators import logs

COMMON = {"mid": "m1", "vc": "v1", "is_new": "1"}


def raw(spark, *records):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "value string")


def test_validity(spark):
    df = raw(spark, '{"a":1}', "{}", "[1]", "5", '"x"', '{"a":', "", "null")
    assert [r.valid for r in logs.valid_json(df, "permissive").collect()] == [True, True] + [False] * 6
    assert logs.valid_json(df).count() == 2
    assert logs.valid_json(df, "reject").count() == 6
    with pytest.raises(ValueError):
        logs.valid_json(df, "other")


def test_parse_drops_what_is_not_a_record(spark):
    df = raw(spark, {"common": COMMON, "ts": 5}, '[{"ts":1}]', "{broken", "null", '{"ts":7}')
    assert sorted(r.ts for r in logs.parse_logs(df).collect()) == [5, 7]


def test_a_record_is_parsed_once(spark):
    df = logs.parse_logs(raw(spark, {"ts": 1})).filter("ts > 0 and page is null")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def values(df):
    """Records of an output as plain values."""
    return [json.loads(r[0]) for r in df.select(F.to_json("record")).collect()]


def test_types_unknown_and_repeated_keys_survive(spark):
    """Time as text, numbers, a key no section knows, and of a repeated key the last value."""
    texts = [
        '{"common":{"mid":"m","mid":"n","v":1.50},"page":{"page_id":"p","during_time":100},"ts":"1704067200000","extra":{"a":[1]},"displays":[{"item":5}]}',
        '{"common":{"mid":"o"},"page":{"page_id":"p","during_time":"7"},"ts":1704067200001}', '{"common":{"mid":"q"},"page":{"page_id":"r"},"ts":3,"big":12345678901234567890}',
    ]
    df = raw(spark, *texts)
    assert logs.valid_json(df).count() == logs.parse_logs(df).count() == 3
    tagged = {}
    for r in logs.tag_records(df).collect():
        tagged.setdefault(r.output, []).append(json.loads(r.value))
    assert {k: len(v) for k, v in tagged.items()} == {"page": 3, "display": 1}
    first = next(p for p in tagged["page"] if "extra" in p)
    assert first["common"] == {"mid": "n", "v": 1.5} and first["ts"] == "1704067200000" and first["extra"] == {"a": [1]}
    assert first["page"]["during_time"] == 100 and "displays" not in first
    assert tagged["display"] == [{"item": 5, "mid": "n", "v": 1.5, "ts": 1704067200000, "page_id": "p", "during_time": 100}]
    pages = spark.createDataFrame([(json.dumps(p),) for p in tagged["page"]], "value string")
    got = {r.mid: r for r in logs.parse_page_views(pages).collect()}
    assert {m: r.during_time for m, r in got.items()} == {"n": 100, "o": 7, "q": None}
    assert next(p for p in tagged["page"] if "big" in p)["big"] == 12345678901234567890


def test_misfits_are_rejected_with_a_reason(spark):
    df = raw(spark, "{bad", '{"common":"text","ts":1}', '{"displays":{"a":1},"ts":2}', '{"ts":"soon"}', '{"ts":5,"page":null}', "[1]")
    got = sorted((r.reason, r.value) for r in logs.rejected_logs(df).collect())
    assert [r for r, _ in got] == ["common", "displays", "not an object", "not an object", "ts"]
    outputs = [r.output for r in logs.tag_records(df).collect()]
    assert outputs == ["reject"] * 5 and logs.parse_logs(df).count() == 1


def test_later_maps_win(spark):
    df = spark.createDataFrame([({"a": "1", "b": "1"}, {"b": "2"}, None)], "x map<string,string>, y map<string,string>, z map<string,string>")
    assert df.select(overlay(F.col("x"), F.col("y"), F.col("z")).alias("m")).first().m == {"a": "1", "b": "2"}


def full():
    return {
        "common": COMMON, "page": {"page_id": "home", "item": "page item", "ts": "7"}, "ts": 100,
        "displays": [{"item": "d1", "mid": "no", "order": "1"}, {"order": "2", "ts": "1"}],
        "actions": [{"action_id": "a", "ts": "55", "vc": "no"}],
        "error": {"error_code": "9"},
    }


def test_split_overlays_in_order(spark):
    parts = logs.split_logs(logs.parse_logs(raw(spark, full())))
    shown = sorted(values(parts["display"]), key=lambda r: r["order"])
    assert shown[0] == {**COMMON, "item": "page item", "page_id": "home", "ts": "7", "order": "1"}
    acted = values(parts["action"])[0]
    # The page section is applied last, also over the time of the action.
    assert acted["vc"] == "v1" and acted["ts"] == "7" and acted["action_id"] == "a"
    assert parts["error"].columns == ["common", "page", "error", "ts", "record"]
    assert parts["page"].columns == ["common", "page", "ts", "record"]
    assert set(values(parts["error"])[0]) == set(full()) - {"displays", "actions"}
    assert set(values(parts["page"])[0]) == set(full()) - {"displays", "actions", "error"}


def test_whole_records_keep_unknown_keys(spark):
    record = {**full(), "later": {"a": [1, "x"]}}
    parts = logs.split_logs(logs.parse_logs(raw(spark, record)))
    assert values(parts["error"])[0]["later"] == {"a": [1, "x"]} == values(parts["page"])[0]["later"]
    assert values(parts["page"])[0]["common"] == COMMON


def test_output_counts_are_those_of_the_outputs(spark):
    df = logs.parse_logs(raw(spark, full(), {**full(), "start": {"entry": "icon"}}, {"common": COMMON, "ts": 1, "displays": [], "actions": None}))
    counts = {r.output: r.n for r in logs.output_counts(df).collect()}
    assert counts == {k: v.count() for k, v in logs.split_logs(df).items() if v.count()}


def test_action_keeps_its_time_without_page(spark):
    record = {"common": COMMON, "ts": 100, "actions": [{"ts": "55"}], "displays": [{"item": "i"}]}
    parts = logs.split_logs(logs.parse_logs(raw(spark, record)))
    assert values(parts["action"])[0]["ts"] == "55"
    assert values(parts["display"])[0]["ts"] == 100
    assert parts["page"].count() == 0


def test_start_is_exclusive_and_others_are_not(spark):
    df = logs.parse_logs(raw(spark, full(), {**full(), "start": {"entry": "icon"}}, {"common": COMMON, "ts": 1}))
    parts = {k: v.count() for k, v in logs.split_logs(df).items()}
    assert parts == {"start": 1, "display": 2, "action": 1, "error": 1, "page": 1}


def test_single_pass_split_agrees(spark):
    df = logs.parse_logs(raw(spark, full(), {**full(), "start": {"entry": "icon"}}, {"common": COMMON, "ts": 1}))
    tagged = logs.tag_outputs(df).collect()
    counts = {}
    for r in tagged:
        counts[r.output] = counts.get(r.output, 0) + 1
    assert counts == {k: v.count() for k, v in logs.split_logs(df).items()}
    wanted = sorted(json.dumps(r, sort_keys=True) for r in values(logs.split_logs(df)["display"]))
    got = sorted(json.dumps(json.loads(r.value), sort_keys=True) for r in tagged if r.output == "display")
    assert got == wanted
    error = json.loads(next(r.value for r in tagged if r.output == "error"))
    assert error["error"] == {"error_code": "9"} and error["ts"] == 100


def visits(spark, *items):
    return spark.createDataFrame([(m, f, t) for m, f, t in items], "mid string, is_new string, ts string").withColumn(
        "ts", F.to_timestamp("ts")
    )


@pytest.mark.parametrize(
    "given, expected",
    [
        ([("1", "2024-01-06 01:00:00"), ("1", "2024-01-07 01:00:00")], ["1", "0"]),
        ([("0", "2024-01-07 01:00:00"), ("1", "2024-01-08 01:00:00")], ["0", "0"]),
        ([("0", "2024-01-07 01:00:00"), ("1", "2024-01-07 02:00:00")], ["0", "0"]),
        ([("1", "2024-01-06 01:00:00"), ("1", "2024-01-06 23:00:00")], ["1", "1"]),
        ([(None, "2024-01-06 01:00:00"), ("1", "2024-01-07 01:00:00")], [None, "0"]),
    ],
)
def test_new_visitor_repair(spark, given, expected):
    df = visits(spark, *[("m", f, t) for f, t in given])
    assert [r.is_new for r in logs.repair_visitors(df).orderBy("ts").collect()] == expected


def test_repair_keeps_rows_without_a_device(spark):
    df = visits(spark, (None, "1", "2024-01-06 01:00:00"), ("m", "1", "2024-01-06 01:00:00"))
    assert logs.repair_visitors(df).count() == 2
