"""Every training-data query runs on the smallest driver folder and agrees with
its DuckDB statement where it has one; the native ones plan no Python node."""

import duckdb
import pytest

import __spark_entry__ as E
from mktlens.llm import queries
from mktlens.sources.tables import DRIVER_TABLES
from tests.conftest import SF_SMALL
from tests.test_registry import PYTHON_NODE, _canon

NATIVE = ("op7_mixing", "op8_line_dedup")


@pytest.mark.parametrize("key", sorted(queries.QUERIES))
def test_query(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    if key in NATIVE:
        assert not PYTHON_NODE.search(df._jdf.queryExecution().executedPlan().toString())
    got = [tuple(r) for r in df.collect()]
    table = "embeddings" if key in ("op9_embedding_dedup", "op13_vector_codes") else "pages" if key in ("op1_html_extraction", "op10_warc_derivatives") else "documents"
    assert len(got) >= spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()
    if sql := queries.SQL.get(key):
        con = duckdb.connect()
        for t in DRIVER_TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
        cur = con.execute(sql)
        cols = [d[0] for d in cur.description]
        assert sorted(df.columns) == sorted(cols)
        assert _canon(df.columns, got) == _canon(cols, cur.fetchall())
