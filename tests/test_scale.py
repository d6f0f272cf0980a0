"""Hot keys: results stay whole, and no task gets a key to itself."""

import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from millrace.operators import scale, versions


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark, n=6000):
    """A third of all rows share key 0."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 400)
    return spark.range(n).select(key.alias("k"), F.col("id").alias("o"), (F.col("id") * 7919 % 1009).alias("v"))


@pytest.mark.parametrize("keys", [["k"], []])
def test_position_matches_counting(spark, keys):
    df = hot_rows(spark)
    got = {r.o: r.p for r in scale.with_position(df, keys, ["v", "o"], "p").collect()}
    groups = {}
    for r in sorted(df.collect(), key=lambda r: (r.v, r.o)):
        group = groups.setdefault(r.k if keys else None, [])
        assert got.pop(r.o) == len(group)
        group.append(r.o)
    assert not got


def test_position_spreads_a_hot_key(spark):
    cut = scale._ordered_slices(hot_rows(spark), ["k"], ["v", "o"], 8)
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)
    assert cut.filter("k = 0").select("_slice").distinct().count() >= 2


def test_running_max_matches_scanning(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "a", "b", None]), i, rng.randrange(1000) if i % 11 else None) for i in range(500)]
    df = spark.createDataFrame(data, "k string, o int, v int")
    got = {r.o: r.m for r in scale.with_running_max(df, ["k"], ["o"], "v", "m", slices=5).collect()}
    best = {}
    for k, o, v in data:
        assert got[o] == best.get(k), o
        if v is not None:
            best[k] = max(v, best.get(k, v))


def test_hot_partition_of_a_join_is_split(spark):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold="0",
    ):
        big = spark.range(0, 400_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("k"),
            F.col("id").alias("o"), F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        )
        marked = versions.mark_latest(big, ["k"], ["o"]).filter(F.length("pad") > 1)
        counted = marked.groupBy("is_latest").count()
        counts = {r.is_latest: r["count"] for r in counted.collect()}
        assert counts[True] == big.select("k").distinct().count() and sum(counts.values()) == 400_000
        plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_mark_latest_counts(spark):
    df = hot_rows(spark)
    newest = {}
    for r in df.collect():
        newest[r.k] = max(newest.get(r.k, -1), r.o)
    got = {r.o for r in versions.mark_latest(df, ["k"], ["o"]).filter("is_latest").collect()}
    assert got == set(newest.values())


def test_latest_by_key_reduces_before_the_shuffle(spark):
    plan = versions.latest_by_key(hot_rows(spark), ["k"], ["v", "o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan and "Window" not in plan


def test_no_query_uses_a_cross_join_or_one_task_window(spark, tables):
    from millrace.plans.catalogue import QUERIES

    for name, query in QUERIES.items():
        if name.startswith("stream_") or name in ("route_write", "cancel_from_stored_fact", "payment_from_stored_fact"):
            continue
        plan = query(spark, tables)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
        # Least and greatest values are looked up in subqueries, from a row per task. The
        # one global window left runs over slice totals, a row per slice.
        if "SinglePartition" in plan.partition("===== Subqueries")[0].partition("Subquery subquery")[0]:
            assert name == "kv_ranked", name


def test_no_query_runs_a_job_while_it_is_built(spark, tables):
    from millrace.plans.catalogue import QUERIES

    tracker = spark.sparkContext.statusTracker()
    for name, query in QUERIES.items():
        if name.startswith("stream_") or name in ("route_write", "cancel_from_stored_fact", "payment_from_stored_fact"):
            continue
        spark.sparkContext.setJobGroup(f"build {name}", name)
        query(spark, tables)
        jobs = tracker.getJobIdsForGroup(f"build {name}")
        stages = [tracker.getStageInfo(s) for j in jobs for s in tracker.getJobInfo(j).stageIds]
        # Reading a table's schema is a job of one task over file footers.
        assert all(s is None or s.numTasks == 1 and s.name.startswith("parquet at") for s in stages), (name, stages)
    spark.sparkContext.setJobGroup("", "")


def test_sums_of_newest_match_netting(spark, rows):
    from pyspark.sql import functions as F

    df = hot_rows(spark, 900).withColumn("g", F.col("o") % 7).withColumn("v", F.when(F.col("o") % 5 > 0, F.col("v")).cast("decimal(16,2)"))
    want = versions.net_amounts(df, ["k"], ["o"], ["v"]).groupBy("g").agg(F.sum("v").alias("v"))
    assert rows(versions.sums_of_newest(df, ["k"], ["o"], ["v"], ["g"])) == rows(want)


def test_revisions_net_to_the_newest(spark, rows):
    data = [("1", 1, 100, 0), ("1", 2, 100, 5), ("1", 3, 100, 7), ("2", 1, 40, 0)]
    df = spark.createDataFrame(data, "id string, v int, amount int, coupon int")
    signed = versions.revision_changes(df, ["id"], ["v"], ["amount", "coupon"])
    assert rows(signed.filter("id = '1'"), "v", "amount", "sign") == [
        (1, -100, -1), (1, 100, 1), (2, -100, -1), (2, 100, 1), (3, 100, 1)
    ]
    sums = signed.groupBy("id").agg(F.sum("amount").alias("a"), F.sum("coupon").alias("c"))
    assert rows(sums) == [("1", 100, 7), ("2", 40, 0)]
    net = versions.net_amounts(df, ["id"], ["v"], ["amount", "coupon"])
    assert net.count() == 4 and net.schema["amount"].dataType == df.schema["amount"].dataType
    assert rows(net.groupBy("id").agg(F.sum("amount"), F.sum("coupon"))) == rows(sums)


def test_deleted_keys_are_left_out(spark, rows):
    data = [("a", 1, "x"), ("a", 2, None), ("b", 1, None), ("b", 2, "y"), ("c", 1, "z")]
    df = spark.createDataFrame(data, "k string, o int, value string")
    newest = versions.latest_by_key(df, ["k"], ["o"], deleted=F.col("value").isNull())
    assert rows(newest) == [("b", 2, "y"), ("c", 1, "z")]
    assert newest.columns == df.columns


def test_sums_of_newest_shuffle_a_row_once_per_key_and_group(spark):
    df = spark.createDataFrame([(i % 50, i, i % 7, 1) for i in range(400)], "k int, o int, g int, v bigint")
    sums = versions.sums_of_newest(df, ["k"], ["o"], ["v"], ["g"])
    plan = sums._jdf.queryExecution().executedPlan().toString()
    # By key, and by group: no exchange for the distinct groups before that.
    assert plan.count("Exchange hashpartitioning") == 2
    newest = {k: max(i for i in range(400) if i % 50 == k) % 7 for k in range(50)}
    assert {r.g: r.v for r in sums.collect()} == {g: list(newest.values()).count(g) for g in range(7)}
