from __future__ import annotations

import math

import duckdb
import pytest

from shelfwise.plans.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_spark_equals_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    found = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(found.columns)
    order = sorted(df.columns)
    at = [found.columns.index(c) for c in order]
    got = sorted((tuple(map(cell, r)) for r in df.select(*order).collect()), key=repr)
    want = sorted((tuple(cell(r[i]) for i in at) for r in found.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_other_queries_run(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_results_do_not_depend_on_partitions(spark, sf_dir):
    got = []
    for n in ("2", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append(sorted(map(tuple, QUERIES["band_blocked_match"](spark, sf_dir).collect()), key=repr))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1]


def test_entry_points(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
