"""Every registered query against its DuckDB oracle (small scale)."""

import datetime as dt
import decimal
import json
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from ordermill.plans import catalog
from ordermill.plans.shopviews import TABLES

from given_tables import SMOKE


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMOKE)
    rows = df.collect()
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL oracle")
    rel = con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    orows = rel.fetchall()
    assert len(rows) == len(orows)
    assert _rows(df.columns, rows) == _rows(rel.columns, orows)


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["material_piece", "material_color", "total_material_needed",
                          "product_name", "product_color", "total_products_ordered"]
