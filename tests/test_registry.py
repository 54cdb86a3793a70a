"""Registered queries agree with their SQL on the smallest supplied tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry
from shelfmark.bindings import TABLES

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
# whole runs have their own tests
SLOW = {"pipeline_summary", "pipeline_report", "incremental_ingest", "reverse_geocode"}

duckdb = pytest.importorskip("duckdb")
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="no supplied tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else float(f"{v:.9g}") if isinstance(v, float) else v

    return sorted((tuple(value(r[i]) for i in order) for r in data), key=repr)


@needs_data
@pytest.mark.parametrize("name", sorted(set(ORACLE) - SLOW))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert plain(df.columns, [tuple(r) for r in df.collect()]) == plain(names, result.fetchall())


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() > 0
