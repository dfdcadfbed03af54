"""Every query against its SQL in DuckDB over the same tables."""

import duckdb
import pytest
from conftest import TESTDATA

from __spark_entry__ import entry, oracle_sql, queries
from logstats.checks.oracles import ORACLES
from logstats.checks.queries import QUERIES

SF_DIR = TESTDATA / "sf0.01"
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="sample tables not there")

SQL_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS FROM '{path}'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def _assert_equal(spark, database, name):
    frame = QUERIES[name](spark, str(SF_DIR))
    names = sorted(frame.columns)
    result = database.execute(ORACLES[name])
    places = [[column[0] for column in result.description].index(n) for n in names]
    expected = [tuple(row[p] for p in places) for row in result.fetchall()]
    assert len(places) == len(result.description)
    actual = [tuple(row) for row in frame.select(*names).collect()]
    assert len(actual) > 0
    assert len(actual) == len(expected)
    assert _sorted(actual) == _sorted(expected)
    kinds = {column[0]: str(column[1]) for column in result.description}
    assert kinds == {name: SQL_TYPES[kind] for name, kind in frame.dtypes}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    _assert_equal(spark, database, name)


@pytest.mark.parametrize("name", ["exam_records", "exam_duration", "filter_dates", "event_day"])
def test_session_zone_does_not_matter(spark, database, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        _assert_equal(spark, database, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0
