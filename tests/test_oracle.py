"""Every registered query against its SQL in DuckDB."""

import math
from pathlib import Path

import __spark_entry__ as entry_point
import duckdb
import pytest

from labelloom.plans import oracle
from labelloom.plans import queries as registered

SF = "/root/testdata/sf0.001"
SQL = oracle.build()
QUERIES = {**registered.BATCH, **registered.STREAM}


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield con
    con.close()


def in_order(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    df = QUERIES[name](spark, SF)
    result = tables.execute(SQL[name])
    names = [d[0] for d in result.description]
    columns = sorted(names)
    assert sorted(df.columns) == columns
    want = in_order([tuple(row[names.index(c)] for c in columns) for row in result.fetchall()])
    got = in_order([tuple(row[c] for c in columns) for row in df.collect()])
    assert got == want and got
    assert not any(isinstance(v, float) and math.isnan(v) for row in got for v in row)


def test_results_do_not_depend_on_the_session_zone(spark):
    def run():
        return {
            name: in_order(map(tuple, QUERIES[name](spark, SF).collect()))
            for name in ("last_biz", "biz_score_latest", "expose_last12_trace", "lenient_ts_cast", "stream_daily_counts")
        }

    want = run()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert run() == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[0] == "row_key" and df.count() > 0
