"""Every query against its SQL on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

BASE = os.environ.get("WORDSIEVE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(BASE).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(BASE).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(rows):
    key = lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)
    return sorted((tuple(row) for row in rows), key=key)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, BASE)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
        return
    cursor = duck.execute(sql)
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain(df.select(*columns).collect()) == plain(cursor.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "is_sensitive"] and df.where("is_sensitive").count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
