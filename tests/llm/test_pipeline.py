"""Each stage against a plain version on its own input, and the whole run."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from millrace.llm import decontaminate, mixing, near_dedup, toxicity
from millrace.llm.common import settle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = settle(stage(spark, docs, SF), name)
        found.append((name, docs, after))
        docs = after
    return found


def ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def test_stages_keep_the_columns(steps):
    for _, before, after in steps[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes
    assert steps[-1][2].columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_toxic_documents_go(spark, steps):
    _, before, after = steps[0]
    toxic = {r.doc_id for r in toxicity.classify(before, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.toxic}
    assert sorted(ids(after)) == sorted(set(ids(before)) - toxic)


def test_one_document_of_each_group_stays(steps):
    _, before, after = steps[1]
    kept = [r.doc_id for r in near_dedup.near_duplicates(before, 80).collect() if r.kept]
    assert sorted(ids(after)) == sorted(kept) and len(kept) < before.count()


def test_leaked_documents_go(spark, steps):
    _, before, after = steps[2]
    bench = [decontaminate.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {r.doc_id for r in before.collect() if any(b in decontaminate.normalise(r.text) for b in bench)}
    assert sorted(ids(after)) == sorted(set(ids(before)) - leaked)


def test_the_mix_is_taken(steps):
    _, before, after = steps[3]
    want = {r.doc_id: r.taken for r in mixing.mix(before).collect() if r.taken}
    got = Counter()
    for row in after.collect():
        got[row.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", row.text))
    assert got == Counter(want)


def test_tokens_of_what_is_left(steps):
    _, before, after = steps[4]
    rows = sorted(map(tuple, after.collect()), key=lambda r: r[1])
    assert sorted(r[0] for r in rows) == sorted(ids(before)) and [r[0] for r in rows] == sorted(r[0] for r in rows)
    assert [r[1] for r in rows] == [sum(x[2] for x in rows[:i]) for i in range(len(rows))]


def test_odd_documents_pass_through(spark, odd, none):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF), name)
    assert docs.count() > 0
    docs = none
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF), name)
    assert docs.count() == 0
