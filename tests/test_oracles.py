"""Every registered query against its SQL, at the smallest scale."""

import datetime as dt
import os

import pytest

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")

import __spark_entry__ as entry_point  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


@pytest.mark.parametrize("name", list(entry_point.queries()))
def test_query(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    sql = entry_point.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = duck.execute(sql)
    found = [c[0] for c in cursor.description]
    assert sorted(found) == columns
    place = [found.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in place) for r in cursor.fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["bucket", "topic", "series", "value"]


def test_oracles_belong_to_queries():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
