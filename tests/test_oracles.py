"""Every registered query with an oracle, against DuckDB on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from quarry.sources.tables import TABLES

from small_tables import SF_SMALL

ORACLE = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, srows) == _canon(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert set(df.columns) >= {"split", "tp", "fp", "fn", "tn", "f1"}
