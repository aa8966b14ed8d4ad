"""Every query with an SQL twin equals DuckDB on the sf0.001 tables, exactly
(floats compared bit for bit)."""
import math

import duckdb
import pytest

from plumbline.plans.catalog import load_all
from plumbline.plans.standins import TABLES
from tests.conftest import SF0001
from tests.plan_guard import check_plan

REG = load_all()
WITH_SQL = sorted(n for n, (_f, s) in REG.items() if s is not None)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0  # exact: no rounding
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_duckdb(spark, con, name):
    fn, sql = REG[name]
    df = fn(spark, SF0001)
    check_plan(name, df)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, res.fetchall())


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert "entity_table" in s
