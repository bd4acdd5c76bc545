"""Every registered query with an oracle matches DuckDB on sf0.01; the
others run and return rows with a stable schema."""
import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_CHECK

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _sorted(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple(map(str, t)))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_CHECK}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_query(spark, con, key):
    df = entry.queries()[key](spark, SF_CHECK)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(key)
    if sql is None:
        assert len(rows) > 0
        return
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _sorted(df.columns, rows) == _sorted(dcols, res.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["year", "hundred_block", "total_crime", "district"]
