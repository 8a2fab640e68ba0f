"""Every registered query against its oracle on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from ledgerline.plans.oracles import ORACLES
from ledgerline.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    result = oracle.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, result.fetchall())


def test_entry_returns_rows(spark):
    assert entry_points.entry(spark).count() > 0
