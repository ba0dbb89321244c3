"""Every engine query runs on the smallest driver folder, plans without Python
nodes of any kind, and agrees with its DuckDB oracle.  The training-data
queries have their own run in tests/llm."""

import datetime as dt
import decimal
import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from mktlens.plans.registry import QUERIES
from mktlens.sources.tables import DRIVER_TABLES
from tests.conftest import SF_SMALL

KEYS = sorted(QUERIES)
PYTHON_NODE = re.compile(r"EvalPython|InPandas|InArrow|PythonUDTF")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not PYTHON_NODE.search(plan)
    got = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        return
    cur = duck.execute(sql)
    dcols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in dcols)
    assert _canon(df.columns, got) == _canon(dcols, want)
