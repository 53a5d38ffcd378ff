"""Every named query against its SQL in DuckDB, on the smallest tables."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from conftest import SF_SMALL
from stratal.sources.tables import TEST_TABLES
from stratal.suite.oracle import ORACLE, ORACLE_FILES_DIR
from stratal.suite.queries import QUERIES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.6g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    res = duck.execute(ORACLE[name].replace(ORACLE_FILES_DIR, SF_SMALL))
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    srows = [tuple(r) for r in sdf.collect()]
    drows = res.fetchall()
    assert len(srows) == len(drows)
    assert _rows(sdf.columns, srows) == _rows(dcols, drows)
