"""Every query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from rillflow import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, FOLDER)
    want = duck.sql(queries.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    order = sorted(df.columns)
    mine = sorted((tuple(str(r[c]) for c in order) for r in df.collect()))
    assert mine == sorted(tuple(str(r[want.columns.index(c)]) for c in order) for r in want.fetchall())


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_scans_are_pruned(spark):
    assert "GreaterThanOrEqual(o_orderkey,900)" in plan(queries.topic_offset_filter(spark, FOLDER))
    read = plan(queries.anti_join_seqno(spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint>" in read and "ReadSchema: struct<l_orderkey:bigint>" in read
    assert "Python" not in plan(queries.etl_full(spark, FOLDER)) and "CartesianProduct" not in plan(queries.etl_full(spark, FOLDER))
