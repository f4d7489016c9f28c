"""Every registered query against its SQL twin."""

import os

import duckdb
import pytest

import __spark_entry__

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def canonical(frame):
    frame = frame[sorted(frame.columns)]
    rows = (tuple((v == v, v if v == v else None) for v in row) for row in frame.itertuples(index=False))
    return sorted(rows, key=repr)


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(got)
    if name in ORACLES:
        expected = duck.sql(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(expected.columns)
        assert canonical(got) == canonical(expected)


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["doc_id", "word", "tficf"]
