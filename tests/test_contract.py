import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, normalized

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 30


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normalized(got) == normalized(want)
