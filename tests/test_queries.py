"""Every registered query against its SQL in DuckDB."""

import os

import duckdb
import pytest

from corpusloom.oracle import ORACLE
from corpusloom.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sql, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    got = sorted(repr(tuple(r)) for r in frame.select(*columns).collect())
    result = sql.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})")
    assert got == sorted(map(repr, result.fetchall()))
