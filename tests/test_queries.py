"""Every registered query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from millrace.plans.catalogue import QUERIES
from millrace.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def canonical(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(str(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, database, name):
    df = entry.queries()[name](spark, SF)
    want = database.sql(entry.oracle_sql()[name])
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == canonical(want.columns, want.fetchall())
    assert got[1], "a query that returns nothing proves nothing"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_column_types_compare_across_engines(spark, database):
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}
    for name, query in QUERIES.items():
        if name.startswith("stream_") or name in ("route_write", "cancel_from_stored_fact", "payment_from_stored_fact"):
            continue
        want = database.sql(entry.oracle_sql()[name])
        types = dict(zip(want.columns, map(str, want.types)))
        assert {c: kinds[t] for c, t in query(spark, SF).dtypes} == types, name


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
