"""Every registered query with SQL equals DuckDB on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from changetide.plans import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
ROWS_ONLY = {"stream_progress", "table_detail", "file_listing"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def ordered(columns, rows):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(row[i]) for i in places) for row in rows), key=repr)


def test_each_query_has_sql_or_a_reason():
    # The corpus operators have tests of their own and may be absent.
    assert set(catalog.QUERIES) - set(ORACLE) == ROWS_ONLY
    assert not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(got.columns) == sorted(columns)
    rows = [tuple(r) for r in got.collect()]
    assert expected, "an empty result checks nothing"
    assert ordered(got.columns, rows) == ordered(columns, expected)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_query_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 12


@pytest.mark.parametrize("name", ["current_state", "history", "hour_share", "csv_snapshot_load"])
def test_results_do_not_depend_on_the_session_time_zone(spark, name):
    def rows():
        frame = QUERIES[name](spark, SF_DIR)
        return ordered(frame.columns, [tuple(r) for r in frame.collect()])

    expected = rows()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows() == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
