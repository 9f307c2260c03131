"""Every registered query against its DuckDB oracle on sf0.001, plus the smoke entry."""

import decimal
import hashlib
import json

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from verlog.sources.testdata import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    return None if v is None else str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted(json.dumps([_norm(r[i]) for i in order]) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_id", "status_old", "status_new", "total_old", "total_new", "change_type"]


def test_every_query_has_a_callable():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(df.columns) > 0
        return
    rel = duck.execute(sql)
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)
