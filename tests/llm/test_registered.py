"""Registered queries against their SQL over the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from labelloom.llm import oracle, queries


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "conversations", "pages", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{name}.parquet')")
    return connection


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry_point.queries())
    assert set(oracle.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_its_sql(spark, sf_dir, tables, name):
    got = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    rows = sorted(map(str, map(tuple, got.select(*columns).collect())))
    sql = tables.execute(f"SELECT {', '.join(columns)} FROM ({oracle.SQL[name]})").fetchall()
    assert len(rows) > 0 and rows == sorted(map(str, sql))
